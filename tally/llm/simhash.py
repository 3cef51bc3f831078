"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint has a bit set where more than half of the hashes of a text's shingles have it. Two
fingerprints link if they differ in at most ``radius`` bits. Each bit position gets one of the nonzero
vectors of ``radius + 1`` bits, by turns; each such vector v gives a mask of the positions whose vector has an
odd inner product with v. Any ``radius`` positions span less than the whole space, so some v is orthogonal to
all of them: its mask avoids every differing bit, and the pair meets in that table. No pair is missed.

Copies share a fingerprint and are joined first, so the tables hold distinct fingerprints only. Two that
meet in a bucket differ only in positions outside the mask. Instead of comparing all pairs of a bucket, each
member names itself and what it becomes by up to half the radius (rounded up) flips of such positions: two
members within the radius have a name in common, and what shares a name is then compared by its bits. A
bucket of any size so costs a fixed number of rows per member, and a name has a bounded number of owners.

Null texts count as empty; texts without a word have fingerprint zero and link like any other; rows repeat as
given; a null doc_id is never a component's id unless all its ids are null; texts of any length are read whole, their
bits summed in slices; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.llm.common import as_texts
from tally.llm.components import components
from tally.session import cut_lineage

BITS = 64
SEED = 42


def fingerprint(text: str, words_per_shingle: int) -> int:
    """Unsigned 64-bit fingerprint of a whole text: A-Z in lower case, words between ASCII white space,
    shingles with repeats (fewer words: all of them as one), XXH64 of each."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    k = min(words_per_shingle, len(words))
    starts = np.concatenate(([0], ends[:-1]))[: len(words) - k + 1]
    h = xxhash.xxh64_intdigest
    got = np.array([h(flat[a:b], SEED) for a, b in zip(starts.tolist(), (ends[k - 1 :] - 1).tolist(), strict=True)], dtype="<u8")
    # very long texts are summed in slices, so the bits of one slice at a time are spread out
    ones = sum(np.unpackbits(got[i : i + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64) for i in range(0, len(got), 65536))
    return int.from_bytes(np.packbits(2 * ones > len(got), bitorder="little").tobytes(), "little")


def with_fingerprint(df: DataFrame, words_per_shingle: int, id_col: str, text_col: str = "text") -> DataFrame:
    """(row, fp) of every row; fp is the fingerprint's bits as a long."""

    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t, words_per_shingle) for t in as_texts(b["text"])], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*(b[c] for c in b.schema.names if c != "text"), pa.array(fps.view(np.int64))], names=[*(c for c in b.schema.names if c != "text"), "fp"])

    cols = dict.fromkeys([id_col, "doc_id"])
    src = df.select(*(F.col(c).cast("long").alias(c) for c in cols), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, ", ".join(f"`{c}` long" for c in cols) + ", fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def covering_masks(radius: int) -> list[int]:
    """2^(radius+1) - 1 masks; every set of ``radius`` positions lies outside at least one of them."""
    n = (1 << (radius + 1)) - 1
    return [sum(1 << i for i in range(BITS) if bin((1 + i % n) & v).count("1") % 2) for v in range(1, n + 1)]


def links(fps: DataFrame, radius: int) -> DataFrame:
    """(a, b) links between the distinct fingerprints of ``fps`` (column fp) that connect all pairs within
    ``radius`` bits: each is one of the pairs, and their components are those of all the pairs."""
    masks, flips = covering_masks(radius), (radius + 1) // 2
    table = F.array(*(F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("k")) for i, m in enumerate(masks)))
    placed = fps.select("fp", F.explode(table).alias("p")).select("fp", "p.t", "p.k")
    shared = placed.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("t", "k")
    met = placed.join(shared, ["t", "k"])
    free = [[i for i in range(BITS) if not m >> i & 1] for m in masks]
    turned = F.lit(None)
    for i, f in enumerate(free):
        near = [0, *(sum(1 << j for j in c) for n in range(1, flips + 1) for c in combinations(f, n))]
        turned = F.when(F.col("t") == i, F.array(*(F.lit(_signed(x)) for x in near))).otherwise(turned)
    named = met.select("fp", F.explode(F.transform(turned, lambda x: F.col("fp").bitwiseXOR(x))).alias("name"))
    # at most the fingerprints within ``flips`` bits of a name, a number fixed by the radius
    groups = named.groupBy("name").agg(F.sort_array(F.collect_set("fp")).alias("fps")).where(F.size("fps") > 1)
    if radius == 2 * flips:
        pairs = groups.select(F.col("fps")[0].alias("a"), F.explode("fps").alias("b"))
    else:
        pairs = groups.select(F.explode("fps").alias("a"), "fps").select("a", F.explode("fps").alias("b"))
    return pairs.where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)).distinct()


def near_duplicates(df: DataFrame, words_per_shingle: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's id column (``id_col``, and doc_id), fp, component_id (least doc_id of its component) and
    keep_row (least ``id_col`` among the component's rows with that doc_id)."""
    known = cut_lineage(with_fingerprint(df, words_per_shingle, id_col, text_col))
    each = cut_lineage(known.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc"), F.col(id_col).alias("row"))).alias("first")))
    joined = components(links(each, radius)).withColumnRenamed("node", "fp")
    of_fp = each.join(joined, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "first")
    of_root = of_fp.groupBy("root").agg(F.min("first").alias("first"))
    found = of_fp.select("fp", "root").join(of_root, "root").select("fp", F.col("first.doc").alias("component_id"), F.col("first.row").alias("keep_row"))
    return known.join(found, "fp")
