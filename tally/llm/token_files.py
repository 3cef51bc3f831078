"""Token ids in ORC files, sorted by document id.

A table of token ids is a folder of ORC files with one row per document: ``part`` (number of the file), ``doc_id``,
``start`` (ids of the documents before it in the file), ``n_tokens`` and ``ids``. The texts are dealt out by ranges of
doc_id and sorted before they are encoded, so the shuffle carries compressed text and each text is encoded once. Files
follow each other in the order of doc_id, and so do the rows of a file. A start is a running sum inside a file and does
not wait for the files before it; a reader adds the totals of the files before, one number per file, which come from the
columns ``part`` and ``n_tokens`` alone.

ORC holds the integers in run-length encodings: ids in runs of their common bit width (16 for a vocabulary of 50,257),
``part`` as one run a stripe. Rows are in stripes of ``stripe_bytes``, which are read independently, so a large file
is read by many tasks; a row index every ``index_rows`` rows holds the least and largest doc_id, and a Bloom filter
on doc_id tells which of the groups whose range covers an id can hold it. A condition on doc_id goes down to the
reader (``find``), which skips stripes and groups by these.

Null texts count as empty and hold the end id only; null ids come first; rows with an equal id follow in the order of
their text's hash, equal rows are documents of their own, and an id that very many rows share is dealt out over files;
a text's ids are one row (some 500 million ids at most); an empty table gives an empty folder; other columns are
ignored.
"""

from __future__ import annotations

import zlib
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.llm.common import as_texts, flat_list
from tally.llm.tokens import encode

SCHEMA = "part int, doc_id long, start long, n_tokens long, ids array<int>"
SLICE_IDS = 1 << 21


def token_rows(texts: DataFrame, tokenizer: str, end_id: int | None) -> DataFrame:
    """Rows of ``SCHEMA`` from (doc_id, text), in the order given; starts count from the first row of each task."""
    names = ["part", "doc_id", "start", "n_tokens", "ids"]
    tail = [] if end_id is None else [end_id]

    def run(batches):
        from pyspark import TaskContext

        part, start = TaskContext.get().partitionId(), 0

        def rows(docs, of):
            nonlocal start
            n = np.array([len(x) for x in of], dtype=np.int64)
            starts = start + np.cumsum(n) - n
            start += int(n.sum())
            cols = [pa.array(np.full(len(n), part, np.int32)), docs, pa.array(starts), pa.array(n), flat_list(np.concatenate(of), n, pa.int32())]
            return pa.RecordBatch.from_arrays(cols, names=names)

        for b in batches:
            of, size, first = [], 0, 0
            for i, text in enumerate(as_texts(b["text"])):
                of.append(np.array([*encode(tokenizer, text), *tail], dtype=np.int32))
                size += len(of[-1])
                if size >= SLICE_IDS or i == b.num_rows - 1:
                    yield rows(b["doc_id"][first : i + 1], of)
                    of, size, first = [], 0, i + 1

    return texts.select("doc_id", "text").mapInArrow(run, SCHEMA)


def write_tokens(df: DataFrame, path: str, tokenizer: str, end_id: int | None = 2, stripe_bytes: int = 16 << 20, index_rows: int = 1000, false_positives: float = 0.01) -> None:
    """Write the ids of (doc_id, text) rows to the folder ``path``."""
    src = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # the last key spreads rows that are equal in both others; they may take any order
    keyed = src.withColumn("tie", F.xxhash64("text")).withColumn("spread", F.monotonically_increasing_id())
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie").asc()]
    ordered = keyed.repartitionByRange(*order, F.col("spread").asc()).sortWithinPartitions(*order)
    options = {
        "orc.stripe.size": str(stripe_bytes),
        "orc.rows.between.memory.checks": "1000",  # rows of long texts fill a stripe soon
        "orc.create.index": "true",
        "orc.row.index.stride": str(index_rows),
        "orc.bloom.filter.columns": "doc_id",
        "orc.bloom.filter.fpp": str(false_positives),
        "compression": "zstd",
    }
    token_rows(ordered, tokenizer, end_id).write.mode("overwrite").options(**options).orc(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """The rows as they lie in the files; starts count inside a file."""
    return spark.read.schema(SCHEMA).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) with starts over all files."""
    files = read_files(spark, path)
    totals = sorted((r["part"], r["n"]) for r in files.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())  # one row per file
    before = [0, *accumulate(n for _, n in totals)]
    offsets = spark.createDataFrame([(p, b) for (p, _), b in zip(totals, before)], "part int, before long")
    # as many rows as files
    placed = files.join(F.broadcast(offsets), "part")
    return placed.select("doc_id", (F.col("before") + F.col("start")).alias("start"), "n_tokens", "ids")


def find(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The rows of some documents; stripes and row groups that cannot hold them are not read."""
    return read_files(spark, path).where(F.col("doc_id").isin(*doc_ids)).select("doc_id", "n_tokens", "ids")


def checksums(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): the unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers,
    and their number, both counted from the ids."""

    def run(batches):
        for b in batches:
            lists = b["ids"]
            at = 4 * lists.offsets.to_numpy().astype(np.int64)
            raw = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), dtype="<i4")).cast("B")
            crc = [zlib.crc32(raw[a:z]) for a, z in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["start"], pa.array(np.diff(at) // 4), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokens.select("doc_id", "start", "ids").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
