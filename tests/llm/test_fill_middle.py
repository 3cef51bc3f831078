"""Fill-in-the-middle against a version over Python strings."""

import hashlib
import random

import numpy as np

from tally.llm import fill_middle, queries
from tally.sources.io import Tables


def _naive(doc_id, text, cut=90, spm=20):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= cut:
        return n, "plain", None, None, text
    if h4 % 100 < spm:
        return n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


def test_rank_and_select_over_unit_ends():
    rng = random.Random(3)
    texts = ["".join(rng.choice("aéß語😀 ́") for _ in range(rng.choice([0, 1, 2, 7, 8, 9, 40]))) for _ in range(400)]
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([3, *map(len, raw)])  # the buffer may start before the first text
    units = fill_middle.Units(np.frombuffer(b"xyz" + b"".join(raw), np.uint8), offsets)
    start = offsets[:-1] - offsets[0]
    first, n = units.rank(start), units.rank(offsets[1:] - offsets[0]) - units.rank(start)
    assert n.tolist() == [len(t) for t in texts]
    for t, s, f in zip(texts, start.tolist(), first.tolist()):
        k = np.arange(1, len(t) + 1)
        assert (units.select(f + k) - s).tolist() == [len(t[:i].encode()) for i in k]


def test_bytes_that_are_no_utf8_are_kept():
    raw = b"\x80\xbfa\xc3" + b"\x80b"  # the second text starts with a byte that continues
    units = fill_middle.Units(np.frombuffer(raw, np.uint8), np.array([0, 4, 6]))
    assert units.rank(np.array([0, 4, 6])).tolist() == [0, 3, 5]
    assert units.select(np.arange(1, 6)).tolist() == [2, 3, 4, 5, 6]


def test_query_against_python_strings(shipped, sf):
    t = Tables(shipped, sf)
    want = {d["doc_id"]: _naive(d["doc_id"], d["text"]) for d in t.documents.collect()}
    rows = queries.op11_fill_in_middle(t).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = {r["doc_id"]: (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output_sha256"]) for r in rows}
    assert len(rows) == len(want) and got == {i: (*w[:4], sha(w[4])) for i, w in want.items()}
    texts = {d["doc_id"]: d["text"] or "" for d in t.documents.collect()}
    assert all(r["restored_sha256"] == sha(texts[r["doc_id"]]) for r in rows)


def test_awkward_rows_and_restored_texts(shipped, edge_docs, no_docs):
    rng = random.Random(8)
    texts = ["".join(rng.choice("a<PSM>é語 ") for _ in range(rng.randint(0, 12))) for _ in range(600)] + ["語" * 3_000_000, "<P", "S>", "<P>", "a<M>b", "x\x00y"]
    many = shipped.createDataFrame([(i % 590, t, "h", 1) for i, t in enumerate(texts)], "doc_id long, text string, form string, h1 int")
    for df in (edge_docs, many):
        made = fill_middle.fill_in_middle(df, cut_percent=97, spm_percent=50)
        rows = made.select("*", fill_middle.restored(made["output"], made["form"]).alias("text")).collect()
        source = [(r["doc_id"], r["text"]) for r in df.collect()]
        assert sorted(map(str, ((r["doc_id"], r["text"]) for r in rows))) == sorted(map(str, ((i, t or "") for i, t in source)))
        want = [(i, *_naive(i, t, 97, 50)) for i, t in source]
        got = [(r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in rows]
        assert sorted(map(str, got)) == sorted(map(str, want))
        assert df is edge_docs or {w[2] for w in want} == {"plain", "psm", "spm"}
    assert fill_middle.fill_in_middle(no_docs).count() == 0
