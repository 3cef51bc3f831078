"""Exact dedup by deterministic block naming.

A normalised text is cut into blocks of ``block_bytes`` bytes (the last one may be shorter). Blocks are sorted
and equal ones get one integer name; then adjacent names are paired, distinct pairs sorted and named in the
same way, until each document has one name. Names stand for byte strings without any collision, so two
documents get the same final name exactly if their texts are equal. A pair is named after its level, and a
document without a partner for its last name carries it on unpaired as a pair with nothing.

Sorting is split by hash: a name is (bucket of the value's hash, dense rank inside the bucket), which depends
on the values alone and survives recomputation. Blocks are named apart from the places they stand at. For the names,
each Arrow batch sends an equal block once, so a block that a third of all documents share costs its bucket a row per
batch. The places carry the block's SHA-256 and are joined to the names by it, with a skewed digest split by Spark;
that no two different blocks have the same digest is checked (an error says so), so names stay free of collisions.
Higher levels name distinct pairs only and join them back.

Null text counts as empty. Equal means the same bytes after lower-casing A-Z only. The row with the largest
doc_id stays, of repeated rows with that id the one with the largest row number; a null doc_id is the
smallest. A text of any length is read whole, in blocks; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tally.llm.common import as_texts, fresh, with_row_id
from tally.session import cut_lineage, drop_scratch, write_scratch

BUCKET_BITS = 20
RANK_BITS = 63 - BUCKET_BITS


def normalise(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass").lower()  # bytes.lower() changes A-Z only


def _source(df: DataFrame, row: str) -> DataFrame:
    return df.select(F.col(row).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _cut(raw: bytes, block_bytes: int) -> list[bytes]:
    return [raw[a : a + block_bytes] for a in range(0, max(1, len(raw)), block_bytes)]


def blocks(df: DataFrame, row: str, block_bytes: int) -> DataFrame:
    """(block, digest): the distinct blocks of each batch."""

    def run(batches):
        for b in batches:
            found = list({block for t in as_texts(b["text"]) for block in _cut(normalise(t), block_bytes)})
            step = max(1, (16 << 20) // block_bytes)
            for a in range(0, len(found), step):
                part = found[a : a + step]
                digests = [hashlib.sha256(x).digest() for x in part]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()), pa.array(digests, pa.binary())], names=["block", "digest"])

    return _source(df, row).select("text").mapInArrow(run, "block binary, digest binary")


def places(df: DataFrame, row: str, block_bytes: int) -> DataFrame:
    """(row, doc_id, i, digest, sha256): every block of every text by its digest; block 0 also carries the digest of the
    whole text."""
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
    names = ["row", "doc_id", "i", "digest", "sha256"]

    def run(batches):
        for b in batches:
            out = []
            for row_id, doc, text in zip(b["row"].to_pylist(), b["doc_id"].to_pylist(), as_texts(b["text"]), strict=True):
                raw = normalise(text)
                whole = hashlib.sha256(raw).digest()
                if len(raw) <= block_bytes:
                    out.append((row_id, doc, 0, whole, whole))
                else:
                    out += [(row_id, doc, i, hashlib.sha256(x).digest(), None if i else whole) for i, x in enumerate(_cut(raw, block_bytes))]
            cols = list(zip(*out)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    return _source(df, row).mapInArrow(run, "row long, doc_id long, i int, digest binary, sha256 binary")


def block_names(df: DataFrame, row: str, block_bytes: int) -> DataFrame:
    """(digest, name) of every distinct block, written."""
    each = blocks(df, row, block_bytes).withColumn("bucket", _bucket("block"))
    before = F.lag("block").over(Window.partitionBy("bucket").orderBy("block"))
    named = each.select("digest", _name(F.col("bucket"), "block").alias("name"), (before.isNull() | (before != F.col("block"))).alias("first"))
    one = named.where("first").groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("name").alias("name"))
    clash = F.raise_error(F.lit("two different blocks have the same SHA-256")).cast("long")
    return cut_lineage(one.select("digest", F.when(F.col("n") == 1, F.col("name")).otherwise(clash).alias("name")))


def _name(bucket: Column, *order: str) -> Column:
    """Integer name of a value: its hash bucket, then its rank among the bucket's sorted values."""
    rank = F.dense_rank().over(Window.partitionBy("bucket").orderBy(*order))
    return F.shiftleft(bucket.cast("long"), RANK_BITS).bitwiseOR(rank.cast("long"))


def _bucket(*values: str) -> Column:
    return F.pmod(F.xxhash64(*values), F.lit(1 << BUCKET_BITS)).cast("int").alias("bucket")


def identities(df: DataFrame, row: str, block_bytes: int = 4096) -> DataFrame:
    """(row, doc_id, sha256, name) of every row: equal names exactly for equal texts."""
    spark = df.sparkSession
    placed = places(df, row, block_bytes).join(block_names(df, row, block_bytes), "digest")
    gathered = placed.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("sha256").alias("sha256"), F.sort_array(F.collect_list(F.struct("i", "name"))).alias("s"))
    base = cut_lineage(gathered.select("row", "doc_id", "sha256", F.col("s.name").alias("names")))
    longest = base.agg(F.max(F.size("names"))).first()[0] or 1
    level, path = base.select("row", "names"), None
    while longest > 1:
        # every document goes through every level, so equal texts have gone through the same number of pairings
        half = F.sequence(F.lit(0), F.floor((F.size("names") - 1) / 2).cast("int"))
        pair = F.transform(half, lambda k: F.struct(k.alias("i"), F.get("names", k * 2).alias("a"), F.coalesce(F.get("names", k * 2 + 1), F.lit(0)).alias("b")))
        pairs = level.select("row", F.explode(pair).alias("p")).select("row", "p.*")
        distinct = pairs.select("a", "b").distinct().withColumn("bucket", _bucket("a", "b"))
        names = distinct.select("a", "b", _name(F.col("bucket"), "a", "b").alias("name"))
        up = pairs.join(names, ["a", "b"]).groupBy("row").agg(F.sort_array(F.collect_list(F.struct("i", "name"))).alias("s"))
        after = write_scratch(up.select("row", F.col("s.name").alias("names")))
        if path:
            drop_scratch(spark, path)
        path, longest = after, (longest + 1) // 2
        level = spark.read.schema("row long, names array<long>").parquet(path)
    return base.select("row", "doc_id", "sha256").join(level.select("row", F.col("names")[0].alias("name")), "row")


def exact_dedup(df: DataFrame, row: str | None = None, block_bytes: int = 4096) -> DataFrame:
    """One row per row of (doc_id, text): row, doc_id, keep_id, group_size, kept, text_sha256.

    ``row`` names a column that numbers the rows; without one they are numbered here."""
    if row is None:
        row = fresh(df, "row")
        df = with_row_id(df, row)
    ids = cut_lineage(identities(df, row, block_bytes))
    groups = ids.groupBy("name").agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "row")).alias("keep"))
    return ids.join(groups, "name").select(
        "row",
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"),
        F.lower(F.hex("sha256")).alias("text_sha256"),
    )
