"""Vector codes against a search over all entries in Python integers."""

import numpy as np
import pytest

from tally.llm import vector_codes
from tally.sources.io import Tables


@pytest.mark.parametrize("degree", [2, 4, 7])
def test_tree_finds_the_nearest_entry_and_the_lower_of_ties(degree):
    rng = np.random.default_rng(degree)
    for n, w, spread in ((1, 3, 5), (2, 1, 1), (16, 2, 2), (16, 8, 400), (60, 3, 50), (200, 2, 10**8)):
        entries = rng.integers(-spread, spread + 1, (n, w))  # small spreads: equal entries and ties
        x = np.concatenate((rng.integers(-spread, spread + 1, (500, w)), entries))
        got = vector_codes.Search(vector_codes.build_tree(entries, degree=degree), x)
        d = np.square(x[:, None] - entries).sum(axis=2)
        assert (got.best == d.min(axis=1)).all() and (got.at == d.argmin(axis=1)).all()


def test_tree_leaves_out_entries_that_are_too_far():
    rng = np.random.default_rng(1)
    centres = rng.integers(-(10**6), 10**6, (16, 4))
    x = (centres[rng.integers(0, 16, 4000)] + rng.integers(-50, 50, (4000, 4))).astype(np.int64)
    got = vector_codes.Search(vector_codes.build_tree(centres), x)
    assert got.met < 0.6 * 16 * len(x)


def _naive(rows, parts=8, entries=16, rounds=6, factor=4096):
    import math

    kept = [(i, [math.floor(factor * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max(len(v) for _, v, _ in kept) // parts) * parts
    w = width // parts
    kept = [(i, v + [0] * (width - len(v)), label) for i, v, label in sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))]
    cut = [[tuple(v[p * w : p * w + w]) for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            of = {}
            for c in cut:
                of.setdefault(nearest(p, c[p])[1], []).append(c[p])
            books[p] = [tuple(sum(x) // len(of[k]) for x in zip(*of[k])) if k in of else e for k, e in enumerate(books[p])]
    found = [[nearest(p, c[p]) for p in range(parts)] for c in cut]
    return sorted(map(str, ((i, "".join(f"{k:02x}" for _, k in f), sum(d for d, _ in f), label) for (i, _, label), f in zip(kept, found)))), books


def test_codes_by_brute_force(shipped):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=16).round(2).tolist(), i % 3) for i in range(300)]
    rows += [(i % 7, rows[5][1], None) for i in range(200)]  # a hot vector, repeated ids
    rows += [(900, None, 1), (901, [1.0, None], 1), (902, [float("nan")] * 16, 1), (903, [float("inf")] * 16, 1), (904, [0.5, 0.25], None), (905, [], 2), (None, [1.0] * 16, 1), (906, [-0.00001] * 16, 1)]
    for few in (rows, rows[:5], rows[-2:-1]):
        df = shipped.createDataFrame([(i, v, label, "x", 0) for i, v, label in few], "vec_id long, embedding array<double>, label int, v string, error int").repartition(5)
        vectors, width = vector_codes.whole_vectors(df, keep=("label",))
        books = vector_codes.fit(vectors, width)
        got = vector_codes.encode(vectors, books, keep=("label",)).collect()
        want, naive_books = _naive(few)
        assert sorted(str((r["vec_id"], r["code"], r["error"], r["label"])) for r in got) == want
        assert [[tuple(e) for e in b] for b in books.entries.tolist()] == naive_books
        r = got[0]
        v = next(x["v"] for x in vectors.collect() if x["vec_id"] == r["vec_id"]) if r["vec_id"] == 906 else None
        assert v is None or sum((a - b) ** 2 for a, b in zip(vector_codes.decode(r["code"], books), v)) == r["error"]


def test_query_on_nothing_and_on_very_large_components(shipped, tmp_path):
    from tally.llm import queries

    schema = "vec_id long, embedding array<float>, label int"
    for name, rows in (("none", []), ("nulls", [(1, None, 0), (2, [float("nan")], 0)]), ("large", [(1, [3e38] * 64, 0), (2, [-3e38] * 64, 0), (3, [0.0] * 64, None)])):
        shipped.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}/embeddings.parquet")
        out = queries.op12_vector_codes(Tables(shipped, f"{tmp_path}/{name}")).collect()
        assert len(out) == (3 if name == "large" else 0) and all(r["error"] == 0 for r in out)
