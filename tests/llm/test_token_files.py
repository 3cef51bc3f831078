"""Token files against ids encoded one by one, and what a reader skips."""

import zlib

import numpy as np
import pytest
from pyarrow import orc
from pyspark.sql import functions as F

from tally.llm import queries, token_files, tokens
from tally.sources.io import Tables

PATH = queries.tokenizer_path()


def _ids(text):
    return [*tokens.slow_encoder(PATH).encode(text or "", add_special_tokens=False).ids, 2]


def _crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_query_by_brute_force(shipped, sf):
    t = Tables(shipped, sf)
    want, start = [], 0
    for d in sorted(t.documents.collect(), key=lambda d: d["doc_id"]):
        ids = _ids(d["text"])
        want.append((d["doc_id"], start, len(ids), _crc(ids)))
        start += len(ids)
    assert sorted(tuple(r) for r in queries.op13_token_files(t).collect()) == want


def test_awkward_rows(shipped, edge_docs, no_docs, tmp_path):
    many = shipped.createDataFrame([(7 if i % 3 else i, f"text {i % 50}", "p", 0) for i in range(3000)], "doc_id long, text string, part string, ids int")
    for name, df in (("edge", edge_docs), ("none", no_docs), ("hot", many.repartition(4))):
        token_files.write_tokens(df, f"{tmp_path}/{name}", PATH)
        back = token_files.read_tokens(shipped, f"{tmp_path}/{name}")
        rows = sorted(back.collect(), key=lambda r: r["start"])
        ends = np.cumsum([0, *(r["n_tokens"] for r in rows)]).tolist()
        assert [r["start"] for r in rows] == ends[:-1] and all(len(r["ids"]) == r["n_tokens"] for r in rows)
        order = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in rows]
        assert order == sorted(order)
        assert sorted(str((r["doc_id"], r["ids"])) for r in rows) == sorted(str((d["doc_id"], _ids(d["text"]))) for d in df.collect())
        sums = sorted(tuple(r) for r in token_files.checksums(back).select("start", "n_tokens", "ids_crc32").collect())
        assert sums == [(r["start"], r["n_tokens"], _crc(r["ids"])) for r in rows]


def test_one_hot_id_lies_in_several_files(shipped, tmp_path):
    rows = [(7 if i % 3 else i, f"text {i % 5}") for i in range(3000)]
    shipped.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        token_files.write_tokens(shipped.createDataFrame(rows, "doc_id long, text string").repartition(4), str(tmp_path / "t"), PATH)
    finally:
        shipped.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    hot = token_files.read_files(shipped, str(tmp_path / "t")).where("doc_id = 7").groupBy("part").count().collect()
    assert len(hot) > 2 and sum(r["count"] for r in hot) == 2000
    back = sorted(token_files.read_tokens(shipped, str(tmp_path / "t")).collect(), key=lambda r: r["start"])
    assert [r["start"] for r in back] == np.cumsum([0, *(r["n_tokens"] for r in back[:-1])]).tolist()


def test_starts_do_not_depend_on_the_split(shipped, sf, tmp_path):
    docs = Tables(shipped, sf).documents.withColumn("doc_id", F.col("doc_id") % 20)
    found = []
    for n in (1, 7):
        token_files.write_tokens(docs.repartition(n), f"{tmp_path}/{n}", PATH)
        found.append(sorted(tuple(r) for r in token_files.checksums(token_files.read_tokens(shipped, f"{tmp_path}/{n}")).collect()))
    assert found[0] == found[1]


def _rows_read(df):
    """Rows that left the scan, as the executed plan counts them."""
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


@pytest.fixture(scope="module")
def long_table(shipped, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tokens") / "t")
    docs = shipped.range(0, 60000, 2, 1).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("words of"), F.sha2(F.col("id").cast("string"), 512)).alias("text"))
    token_files.write_tokens(docs.coalesce(1), path, PATH, stripe_bytes=1 << 18)
    return path


def test_files_have_stripes_indexes_and_run_lengths(shipped, long_table):
    import glob
    import os

    files = sorted(glob.glob(f"{long_table}/*.orc"))
    assert all(orc.ORCFile(f).nstripes > 2 for f in files)
    rows = token_files.read_files(shipped, long_table).agg(F.sum("n_tokens"), F.sum("doc_id")).first()
    assert rows[1] == sum(range(0, 60000, 2))
    assert sum(map(os.path.getsize, files)) < 2.3 * rows[0]  # below the four bytes of a plain integer


def test_a_reader_skips_groups_that_cannot_hold_an_id(shipped, long_table):
    found = token_files.find(shipped, long_table, [20000])
    rows = found.collect()
    assert len(rows) == 1 and rows[0]["n_tokens"] == len(rows[0]["ids"])
    assert 0 < _rows_read(found) <= 2000  # of 30,000
    absent = token_files.find(shipped, long_table, list(range(20001, 20401, 100)))  # inside the ranges, in no Bloom filter
    assert absent.collect() == [] and _rows_read(absent) <= 1000
