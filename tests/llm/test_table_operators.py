"""Packing, mixing, top-k, dedup and the pipeline against brute force on small tables."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tally.llm import components, exact_dedup, mixing, packing, queries, simhash, substring_dedup, tokens, topk
from tally.sources.io import Tables

PATH = queries.tokenizer_path()


# packing


def _check_packing(rows, capacity=1024):
    in_sequence = defaultdict(list)
    for r in rows:
        in_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in in_sequence.values():
        end = 0
        for offset, n in sorted(places):
            assert offset == end
            end += n
        assert end <= capacity
    return len(in_sequence)


def test_pieces_and_sequences(shipped, sf):
    docs = Tables(shipped, sf).documents
    rows = queries.op3_best_fit_packing(Tables(shipped, sf)).collect()
    want = set()
    for d in docs.collect():
        ids = [*tokens.slow_encoder(PATH).encode(d["text"] or "", add_special_tokens=False).ids, 2]
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)] if len(ids) > 1024 else [0, len(ids)]
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            want.add((d["doc_id"], k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows} == want and len(rows) == len(want)
    used, least = _check_packing(rows), -(-sum(r["length"] for r in rows) // 1024)
    assert used <= least * 1.04 + 2


@pytest.mark.parametrize("seed", range(4))
def test_plans_hold_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    lengths = [rng.integers(1, 1024, 3000), np.full(500, 600), rng.choice([342, 341, 5, 700], 2000), rng.integers(1, 1024, 3)][seed]
    counts = Counter(int(n) for n in lengths)
    plan = packing.plan_packing(counts)
    ranks, rows = defaultdict(set), []
    for n, rank, many, sequence, offset in plan.parts:
        for k in range(many):
            assert rank + k not in ranks[n]
            ranks[n].add(rank + k)
            rows.append({"sequence_id": sequence + k, "offset": offset, "length": n})
    assert {n: len(r) for n, r in ranks.items()} == counts and all(r == set(range(len(r))) for r in ranks.values())
    assert _check_packing(rows) == plan.sequences
    # no worse than best fit by decreasing length
    bins = []
    for n in sorted(lengths.tolist(), reverse=True):
        fit = [i for i, b in enumerate(bins) if b >= n]
        if fit:
            bins[min(fit, key=lambda i: bins[i])] -= n
        else:
            bins.append(1024 - n)
    assert plan.sequences <= len(bins) * 1.005 + 1


# mixing


def test_sainte_lague_by_highest_quotients():
    rng = random.Random(5)
    for _ in range(60):
        votes = [rng.choice([0.0, rng.random() * 100, 50.0]) for _ in range(rng.randint(1, 9))]
        seats, most = rng.randint(0, 60), [rng.randint(0, 30) for _ in votes]
        want = [0] * len(votes)
        for _ in range(seats):
            open_ = [i for i, v in enumerate(votes) if v > 0 and want[i] < most[i]]
            if not open_:
                break
            want[max(open_, key=lambda i: (votes[i] / (2 * want[i] + 1), -i))] += 1
        got = mixing.sainte_lague(votes, seats, most)
        assert sum(got) == sum(want) and all(g <= m for g, m in zip(got, most))
        assert sorted(v / (2 * g + 1) for v, g in zip(votes, got)) == pytest.approx(sorted(v / (2 * g + 1) for v, g in zip(votes, want)))


def test_mix_meets_targets_and_repeats(shipped):
    t = Tables(shipped, "/root/testdata/sf0.01")
    rows = queries.op4_mix_sources(t).collect()
    docs = {d["doc_id"]: d for d in t.documents.collect()}
    assert len(rows) == len(docs)
    size = {i: len((d["text"] or "").encode().split()) for i, d in docs.items()}
    total = defaultdict(int)
    for i, d in docs.items():
        total[d["source"]] += size[i]
    names = sorted(total)
    want = mixing.targets([total[s] for s in names], [(3, 1, 2)[i % 3] for i in range(len(names))], 1.5 * sum(total.values()))
    assert sum(want) == pytest.approx(1.5 * sum(total.values()))
    taken = defaultdict(int)
    for r in rows:
        s = docs[r["doc_id"]]["source"]
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == total[s] and r["taken"] <= 2 * r["size"]
        assert r["target"] == pytest.approx(want[names.index(s)])
        taken[s] += r["taken"]
    assert all(abs(taken[s] - w) <= 64 + 1 for s, w in zip(names, want))
    again = {r["doc_id"]: r["taken"] for r in queries.op4_mix_sources(Tables(shipped, "/root/testdata/sf0.01")).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in rows}


def test_mix_in_many_shards(shipped):
    docs = shipped.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"), F.repeat(F.lit("w "), (F.col("id") % 50).cast("int")).alias("text"))
    rows = mixing.mix(docs, shard_words=2000).collect()
    by = defaultdict(lambda: [0, 0.0])
    for r in rows:
        by[r["source"]][0] += r["taken"]
        by[r["source"]][1] = r["target"]
        assert r["taken"] <= 2 * r["size"]
    assert all(abs(a - b) <= 0.02 * b + 64 for a, b in by.values())


# top-k


def _top(rows, k):
    """(query_id, candidates) of every query row, as a multiset."""
    out = Counter()
    for a, (q, v) in enumerate(rows):
        if q % 50 == 0:
            scores = sorted((-sum(x * y for x, y in zip(v, w)), i) for b, (i, w) in enumerate(rows) if a != b)[:k]
            out.update((q, n + 1, i, -s) for n, (s, i) in enumerate(scores))
    return out


def test_topk_is_exact(shipped):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(700, 8)).round(2)
    rows = [(i, base[i % 40 if i % 3 else i].tolist()) for i in range(700)]  # many equal vectors: ties
    rows += [(1000, None), (1001, [1.0, None]), (1002, [float("nan")] * 8), (1003, [float("inf")] * 8), (1004, [0.5, 0.25]), (1005, []), (None, [1.0] * 8)]
    rows += [(3, rows[3][1]), (50, rows[50][1]), (50, rows[51][1]), (100, rows[100][1])]  # repeated ids and rows
    df = shipped.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, g int, v string").repartition(5)
    whole = [(i, tuple(int(np.floor(256 * x)) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    vectors = topk.scaled(df)
    assert vectors.count() == len(whole)
    for sizes in ({"block_rows": 16, "group_rows": 128, "chunk_values": 32, "pilot_blocks": 2, "wave": 2}, {"pilot_blocks": 1}, {}):
        got = topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), **sizes).collect()
        assert Counter((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == _top(whole, 5)
    assert topk.top_k(vectors.limit(0), vectors.limit(0)).count() == 0
    few = topk.scaled(df.where("vec_id in (50, 1)"))
    got = topk.top_k(few, few.where("vec_id % 50 = 0")).collect()  # three rows of id 50 and one other
    assert Counter((r["query_id"], r["rank"]) for r in got) == {(50, 1): 3, (50, 2): 3, (50, 3): 3}


def test_blocks_below_the_bound_are_not_scored(shipped):
    rng = np.random.default_rng(9)
    centres = rng.integers(-400, 400, (40, 16))
    x = centres[rng.integers(0, 40, 6000)] + rng.integers(-9, 9, (6000, 16))
    df = shipped.createDataFrame([(i, i, v) for i, v in enumerate(x.tolist())], "row long, vec_id long, v array<long>")
    blocks = topk.index(df, 1, 64).toArrow().combine_chunks().to_batches()[0]
    q = x[:50]
    full = topk.Search(np.arange(50), q, np.full(50, -(1 << 62)), 5)
    full.add(blocks)
    assert full.met < 0.5 * full.seen
    started = topk.Search(np.arange(50), q, full.best[:, -1], 5)
    started.add(blocks)
    assert (started.best == full.best).all() and started.met <= full.met


# exact dedup


def test_names_are_equal_exactly_for_equal_texts(shipped):
    rng = random.Random(1)
    texts = ["".join(rng.choice("abA") for _ in range(rng.choice([0, 1, 3, 4, 5, 8, 9, 17, 40]))) for _ in range(600)] + ["abab" * 50] * 200 + ["é" * 9, "É" * 9, None]
    df = shipped.createDataFrame([(i % 790, t, 0, "b") for i, t in enumerate(texts)], "doc_id long, text string, row int, block string")
    got = exact_dedup.exact_dedup(df, block_bytes=4).collect()
    assert len(got) == len(texts)
    groups = defaultdict(list)
    for i, t in enumerate(texts):
        groups[(t or "").encode().lower()].append(i % 790)
    want = Counter((i, max(g), len(g), hashlib.sha256(k).hexdigest()) for k, g in groups.items() for i in g)
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == want
    assert sum(r["kept"] for r in got) == len(groups)


# simhash


def _bits(text, k=3):
    words = text.encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _classes(n, linked):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_masks_cover_every_pair_of_positions():
    for radius in (1, 2, 3):
        masks = simhash.covering_masks(radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        rng = random.Random(radius)
        for _ in range(3000):
            x = sum(1 << b for b in rng.sample(range(64), radius))
            assert any(not x & m for m in masks)


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_links_connect_all_pairs_within_the_radius(shipped, radius):
    rng = random.Random(9)
    fps = {rng.getrandbits(64) for _ in range(40)}
    for f in list(fps)[:12]:
        for _ in range(25):  # chains and dense clusters of near fingerprints
            f ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3)))
            fps.add(f)
    fps = sorted(simhash._signed(f) for f in fps)
    got = simhash.links(shipped.createDataFrame([(f,) for f in fps], "fp long"), radius).collect()
    dist = lambda a, b: bin((a ^ b) & (2**64 - 1)).count("1")
    assert all(0 < dist(r["a"], r["b"]) <= radius for r in got)
    at = {f: i for i, f in enumerate(fps)}
    want = _classes(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if dist(fps[i], fps[j]) <= radius])
    assert _classes(len(fps), [(at[r["a"]], at[r["b"]]) for r in got]) == want


def test_components_of_long_chains_and_hubs(shipped):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, 1000 + i) for i in range(300)] + [(7, 7), (9, 8)]
    got = {r["node"]: r["root"] for r in components.components(shipped.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 161)} | {5: 5, 8: 8, 9: 8} | {1000 + i: 5 for i in range(300)}
    assert got == want


def test_simhash_query_by_brute_force(shipped, sf):
    t = Tables(shipped, sf)
    docs = [(d["doc_id"], _bits(d["text"] or "")) for d in t.documents.orderBy("doc_id").collect()]
    root = _classes(len(docs), [(i, j) for i in range(len(docs)) for j in range(i) if bin(docs[i][1] ^ docs[j][1]).count("1") <= 2])
    want = {d: (f"{f:016x}", docs[root[i]][0]) for i, (d, f) in enumerate(docs)}
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op9_simhash_covering(t).collect()} == want


# substring dedup


def _words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(n))


def _cut(raw):
    ends = substring_dedup.chunk_ends(raw).tolist()
    return [raw[a:b] for a, b in zip([0, *ends], ends)]


def test_chunks_do_not_move_with_insertions():
    rng = random.Random(4)
    text = _words(rng, 3000).encode()
    assert b"".join(_cut(text)) == text
    changed = text[:5000] + b"some new words " + text[5000:]
    assert len(set(_cut(text)) - set(_cut(changed))) <= 4
    naive = [sum(int(substring_dedup.gear()[text[i - j]]) << 2 * j for j in range(16)) % 2**32 for i in range(15, 60)]
    assert substring_dedup.rolling_hash(np.frombuffer(text[:60], np.uint8))[15:].tolist() == naive
    for raw in (b"a" * 5000, "é".encode() * 900, b"x", b""):
        ends = substring_dedup.chunk_ends(raw).tolist()
        assert ends == sorted(set(ends)) and (ends[-1:] == [len(raw)] or not raw) and all(b - a <= 260 for a, b in zip([0, *ends], ends))
        assert all(c.decode() for c in _cut(raw))


def test_planted_passages_are_found_and_clean_documents_left_alone(shipped):
    rng = random.Random(11)
    docs = {i: _words(rng, rng.randint(150, 400)) for i in range(300)}
    planted = {}
    for p in range(60):
        passage = _words(rng, 55)
        for i in (2 * p, 2 * p + 1):
            a, b = docs[i][: 200 + 3 * p], docs[i][200 + 3 * p :]
            docs[i] = f"{a} {passage} {b}"
            planted[i] = passage
    df = shipped.createDataFrame(list(docs.items()), "doc_id long, text string")
    found = substring_dedup.repeated_spans(df, min_words=40).collect()
    assert {r["doc_id"] for r in found} == set(planted) and len(found) == len(planted)
    for r in found:
        span = docs[r["doc_id"]].encode()[r["span_start"] : r["span_start"] + r["span_bytes"]].decode()
        assert span == planted[r["doc_id"]] and r["span_words"] == 55 and r["first_doc_id"] == r["doc_id"] & ~1
        assert sum(e - a for a, e in r["removed"]) == (r["span_bytes"] if r["doc_id"] % 2 else 0)
    after = {r["doc_id"]: r["text"] for r in substring_dedup.remove_repeats(df, min_words=40).collect()}
    assert all(after[i] == docs[i] for i in docs if i not in planted or i % 2 == 0)
    assert all(after[i] == docs[i].replace(planted[i], "", 1) for i in planted if i % 2)


def _equal_words(own, other, side):
    """``common_words`` by trying every number of bytes."""
    n = 0
    while n < min(len(own), len(other)) and (own[n] == other[n] if side else own[-1 - n] == other[-1 - n]):
        n += 1
    return n


def test_ends_are_extended_by_whole_words():
    cases = [(b"ab cd ef", b"xx cd ef", 0, False, 5, 2), (b"ab cd ef", b"ab cd ef", 0, True, 8, 3), (b"ab cd ef", b"ab cd ef", 0, False, 5, 2), (b"zcd ef", b"cd ef", 0, False, 2, 1), (b" j ab", b"xj ab", 0, True, 2, 1)]
    # after a run, the first byte is the run's last one
    cases += [(b"x ab cd", b"x ab xx", 1, True, 3, 1), (b"x ab cd", b"x ab cd", 1, True, 6, 2), (b"x ab cd", b"x ab cd", 1, False, 3, 1), (b"ab cd", b"ab c", 1, True, 1, 0)]
    cases += [(b" ab cd", b" ab xd", 1, True, 2, 1), (b"x", b"x", 1, True, 0, 0), (b"", b"x", 0, True, 0, 0)]
    for own, other, side, edge, n, words in cases:
        assert substring_dedup.common_words(own, other, side, edge, True) == (n, words), (own, other, side, edge)
    rng = random.Random(2)
    for _ in range(500):
        own, other = (bytes(rng.choice(b"ab \n") for _ in range(rng.randint(1, 9))) for _ in "xy")
        side = rng.randint(0, 1)
        n, words = substring_dedup.common_words(own, other, side, True, True)
        most = _equal_words(own[side:], other[side:], side)
        assert n <= most
        part = own[1 : n + 1] if side else own[len(own) - n :]
        assert words in (len(part.split()), len(part.split()) - side) and not (part[-1:] if side else part[:1]).isspace()


def test_spans_by_brute_force(shipped):
    """Every stretch of 40 words that two documents share is reported, and no word that stands in no shared stretch of two
    words (a span may go on where shorter shared stretches adjoin)."""
    rng = random.Random(21)
    docs = [_words(rng, rng.randint(60, 150)).split() for _ in range(40)]
    for _ in range(25):
        a, b = rng.sample(range(40), 2)
        i, n = rng.randint(0, len(docs[a]) - 50), rng.randint(42, 50)
        at = rng.randint(0, len(docs[b]))
        docs[b][at:at] = docs[a][i : i + n]
    docs += [docs[3], docs[3]]

    def covered(n):
        holders, out = defaultdict(set), [set() for _ in docs]
        for d, words in enumerate(docs):
            for i in range(len(words) - n + 1):
                holders[tuple(words[i : i + n])].add(d)
        for d, words in enumerate(docs):
            for i in range(len(words) - n + 1):
                if len(holders[tuple(words[i : i + n])]) > 1:
                    out[d].update(range(i, i + n))
        return out

    df = shipped.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], "doc_id long, text string")
    got = [set() for _ in docs]
    for r in substring_dedup.repeated_spans(df, min_words=40).collect():
        raw = " ".join(docs[r["doc_id"]]).encode()
        before = len(raw[: r["span_start"]].split())
        inside = raw[r["span_start"] : r["span_start"] + r["span_bytes"]].split()
        assert len(inside) == r["span_words"] or len(inside) == r["span_words"] + 1  # it may begin inside a word
        got[r["doc_id"]].update(range(before, before + r["span_words"]))
    for want, have, allowed in zip(covered(40), got, covered(2)):
        assert want <= have and len(have - allowed) <= 1


# all of them, and the pipeline


def test_awkward_rows(edge_docs, no_docs):
    for docs, n in ((edge_docs, 10), (no_docs, 0)):
        packed = packing.pack(docs, PATH).collect()
        assert sum(r["piece"] == 0 for r in packed) == n
        _check_packing(packed)
        mixed = mixing.mix(docs).collect()
        assert len(mixed) == n and all(r["taken"] <= 2 * r["size"] for r in mixed)
        copies = exact_dedup.exact_dedup(docs).collect()
        assert len(copies) == n and sum(r["kept"] for r in copies) == (7 if n else 0)
        near = simhash.near_duplicates(docs.withColumn("at", F.monotonically_increasing_id()), id_col="at").collect()
        assert len(near) == n and {r["component_id"] for r in near if r["doc_id"] in (1, 2, 3)} <= {1}
        assert sum(r["at"] == r["keep_row"] for r in near) == len({r["component_id"] for r in near})
        assert len(substring_dedup.remove_repeats(docs).collect()) == n
        substring_dedup.repeated_spans(docs).collect()


def test_pipeline_stages(shipped, sf, edge_docs, no_docs):
    import corpus_pipeline

    stages = dict(corpus_pipeline.STAGES)
    docs = shipped.read.parquet(f"{sf}/documents.parquet")
    rows = {d["doc_id"]: d["text"] for d in docs.collect()}
    lettered = {i: t for i, t in rows.items() if any(c.isalpha() for c in t or "")}
    kept = stages["language_id"](shipped, docs, sf)
    assert kept.columns == docs.columns and {r["doc_id"]: r["text"] for r in kept.collect()} == lettered
    last = {t.encode().lower(): i for i, t in sorted(lettered.items())}
    distinct = stages["exact_copies"](shipped, kept, sf)
    assert {r["doc_id"] for r in distinct.collect()} == set(last.values())
    ids = sorted(last.values())
    fps = [_bits(rows[i]) for i in ids]
    root = _classes(len(ids), [(i, j) for i in range(len(ids)) for j in range(i) if bin(fps[i] ^ fps[j]).count("1") <= 2])
    near = stages["near_copies"](shipped, distinct, sf)
    assert {r["doc_id"] for r in near.collect()} == {ids[i] for i in root}
    taken = {r["doc_id"]: (r["taken"], r["size"]) for r in mixing.mix(near).collect()}
    mixed = stages["mix_sources"](shipped, near, sf)
    whole = Counter((r["doc_id"], r["text"]) for r in mixed.collect())
    assert mixed.columns == docs.columns
    assert whole == Counter({(i, rows[i]): (2 * t + n) // (2 * n) for i, (t, n) in taken.items() if 2 * t >= n > 0})
    packed = stages["pack_sequences"](shipped, mixed, sf).collect()
    assert sum(r["piece"] == 0 for r in packed) == mixed.count()
    _check_packing(packed)
    for table in (edge_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(shipped, table, sf)
            assert name == "pack_sequences" or out.columns == table.columns
            out.collect()


@pytest.mark.parametrize("stage", ["exact_copies", "near_copies", "mix_sources"])
def test_stages_do_not_depend_on_how_a_second_scan_is_split(shipped, tmp_path, stage):
    import corpus_pipeline

    rng = random.Random(6)
    texts = [_words(rng, 200) for _ in range(90)]
    rows = [(i, texts[i % 90] if i % 3 else texts[i // 3], "en", f"s{i % 2}", 0) for i in range(270)]
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    shipped.createDataFrame(rows, columns).repartition(6).write.parquet(f"{tmp_path}/documents.parquet")
    before = {k: shipped.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def scan(size):
        shipped.conf.set("spark.sql.files.maxPartitionBytes", size)
        shipped.conf.set("spark.sql.files.openCostInBytes", "1")
        return shipped.read.parquet(f"{tmp_path}/documents.parquet")

    try:
        want = sorted(tuple(r) for r in dict(corpus_pipeline.STAGES)[stage](shipped, scan("64m"), "").collect())
        lazy = dict(corpus_pipeline.STAGES)[stage](shipped, scan("64m"), "")
        shipped.conf.set("spark.sql.files.maxPartitionBytes", "8k")
        got = sorted(tuple(r) for r in lazy.collect())
    finally:
        for k, v in before.items():
            shipped.conf.unset(k) if v is None else shipped.conf.set(k, v)
    assert got == want and got


def test_a_learned_language_of_any_name_stays_and_fills_gaps(shipped):
    import corpus_pipeline

    texts = {"und": "der Hund und das Haus mit dem Baum " * 20, "en": "the house and the tree with the dog " * 20}
    rows = [(i, texts[k], k if i % 3 else None, "s") for i, k in enumerate(["und", "en"] * 30)] + [(70, "12 !?", "en", "s"), (71, None, None, "s")]
    kept = corpus_pipeline.language_id(shipped, shipped.createDataFrame(rows, "doc_id long, text string, lang string, source string"), "").collect()
    assert sorted((r["doc_id"], r["lang"]) for r in kept) == [(i, k) for i, k in enumerate(["und", "en"] * 30)]


def test_documents_stay_where_no_language_can_be_learned(shipped):
    import corpus_pipeline

    columns = "doc_id long, text string, lang string, source string"
    held_out = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5 == 0)
    for tables in ([(1, None), (2, None)], [(None, "en"), (None, "en")], [(held_out, "en"), (held_out, "en")]):
        rows = [(i, t, lang, "s") for i, lang in tables for t in ("plain words", "déjà", "12 !?", "", None)]
        kept = corpus_pipeline.language_id(shipped, shipped.createDataFrame(rows, columns), "").collect()
        assert sorted(r["text"] for r in kept) == ["déjà"] * 2 + ["plain words"] * 2


def test_sequences_hold_one_language_as_the_text_tells(shipped):
    import corpus_pipeline

    rng = random.Random(8)
    vocab = {"de": "der Hund und das Haus mit dem Baum ist nicht sehr".split(), "en": "the house and the tree with the dog is not very".split()}
    # every fifth states the wrong language
    rows = [(i, " ".join(rng.choices(vocab[k], k=60 + i % 90)), k if i % 5 else {"de": "en", "en": "de"}[k], "s") for i, k in enumerate(["de", "en"] * 60)]
    docs = shipped.createDataFrame([*rows, (500, "12 !?", "de", "s")], "doc_id long, text string, lang string, source string")
    truth = {i: ["de", "en"][i % 2] for i in range(120)}
    named = corpus_pipeline.language_id(shipped, docs, "")
    assert {r["doc_id"]: r["lang"] for r in named.collect()} == truth
    packed = corpus_pipeline.pack_sequences(shipped, named, "").collect()
    assert all(r["lang"] == truth[r["doc_id"]] for r in packed) and len(packed) >= 120
    _check_packing(packed)
    held = defaultdict(set)
    for r in packed:
        held[r["sequence_id"]].add(truth[r["doc_id"]])
    assert all(len(v) == 1 for v in held.values())


@pytest.mark.parametrize("ids", [(7, 7, 7), (None, None, None), (None, 9, 4), (4, None, 4)])
def test_one_row_keeps_a_repeated_passage(shipped, ids):
    passage = _words(random.Random(3), 120)
    df = shipped.createDataFrame([(i, passage, n) for n, i in enumerate(ids)], "doc_id long, text string, at int").coalesce(1)
    after = {r["at"]: r["text"] for r in substring_dedup.remove_repeats(df).collect()}
    keeper = min(range(3), key=lambda n: (ids[n] is None, ids[n] or 0, n))
    assert after == {n: passage if n == keeper else "" for n in range(3)}
    spans = substring_dedup.repeated_spans(df).collect()
    assert [r["first_doc_id"] for r in spans] == [ids[keeper]] * 3
    assert sorted(sum(e - s for s, e in r["removed"]) for r in spans) == [0, len(passage), len(passage)]


# the same result on any split of the input


def _split_scans(spark, path):
    """The same files read in few and in many splits; the settings are put back by the caller."""
    for size in ("64m", "8k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        yield spark.read.parquet(path)


@pytest.fixture
def scan_settings(shipped):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: shipped.conf.get(k, None) for k in keys}
    yield
    for k, v in before.items():
        shipped.conf.unset(k) if v is None else shipped.conf.set(k, v)


def test_mix_does_not_depend_on_the_split(shipped, tmp_path, scan_settings):
    rng = random.Random(2)
    rows = [(i % 170 if i % 3 else 5, _words(rng, rng.randint(1, 60)) if i % 4 else "one repeated row of words", f"s{i % 2}") for i in range(900)]
    shipped.createDataFrame(rows, "doc_id long, text string, source string").repartition(5).write.parquet(f"{tmp_path}/d")
    got = [sorted(map(str, mixing.mix(df, shard_words=700).drop("row").collect())) for df in _split_scans(shipped, f"{tmp_path}/d")]
    assert got[0] == got[1] and len(got[0]) == 900


def test_mix_by_brute_force(shipped):
    import struct

    rng = random.Random(12)
    rows = [(i, _words(rng, rng.randint(0, 30)), f"s{i % 3}") for i in range(400)] + [(7, "same words again", "s0")] * 30
    rows += [(i, t, None) for i in range(20) for t in (None, "", " \n")]
    got = mixing.mix(shipped.createDataFrame(rows, "doc_id long, text string, source string"), shard_words=300, block_words=16).collect()
    assert len(got) == len(rows)

    def h(seed, *values):
        x = xxhash.xxh64_intdigest(struct.pack("<i", seed), 42)
        for v in values:
            x = xxhash.xxh64_intdigest(struct.pack("<q", v), x)
        return x - (1 << 64) if x >> 63 else x

    copies, of_source = Counter(), defaultdict(list)
    for i, t, s in rows:
        size = len((t or "").encode().split())
        digest = xxhash.xxh64_intdigest((t or "").encode(), 42)
        digest -= (1 << 64) if digest >> 63 else 0
        copies[i, s, digest] += 1
        of_source[s].append((i, size, (i, digest, copies[i, s, digest] - 1)))
    names = sorted(of_source, key=lambda s: (s is None, s or ""))
    sizes = [sum(n for _, n, _ in of_source[s]) for s in names]
    aims = mixing.targets(sizes, [(3, 1, 2)[k % 3] for k in range(len(names))], 1.5 * sum(sizes))
    blocks = mixing.sainte_lague(aims, round(sum(aims) / 16), [2 * -(-n // 16) for n in sizes])
    want = Counter()
    for s, n, b in zip(names, sizes, blocks):
        shards = defaultdict(list)
        for doc in of_source[s]:
            if doc[1]:
                shards[h(8, *doc[2]) % max(1, n // 300)].append(doc)
            else:
                want[doc[0], s, 0, 0] += 1
        order = sorted(shards)
        totals = [sum(d[1] for d in shards[k]) for k in order]
        for k, total, seats in zip(order, totals, mixing.sainte_lague([float(x) for x in totals], b, [2 * -(-x // 16) for x in totals])):
            left = min(16 * seats, 2 * total)
            taken = dict.fromkeys((d[2] for d in shards[k]), 0)
            while left:
                for doc_id, size, key in sorted(shards[k], key=lambda d: (h(7, *d[2]), d[2])):
                    taken[key] += min(left, size)
                    left -= min(left, size)
            for doc_id, size, key in shards[k]:
                want[doc_id, s, size, taken[key]] += 1
    assert Counter((r["doc_id"], r["source"], r["size"], r["taken"]) for r in got) == want


def test_a_source_without_words_is_in_no_window(shipped):
    rows = shipped.range(0, 3000, 1, 6).select(F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("text"), F.lit("hot").alias("source"))
    some = shipped.createDataFrame([(9000, "a few words " * 100, "other")], "doc_id long, text string, source string")
    got = mixing.mix(rows.unionByName(some)).collect()
    assert len(got) == 3001 and all(r["taken"] == 0 and r["target"] == 0 for r in got if r["source"] == "hot")
    assert sum(r["taken"] for r in got) > 0


def test_row_numbers_hold_in_every_scan(shipped, tmp_path, scan_settings):
    from tally.llm.common import numbered_rows

    rng = random.Random(3)
    shipped.createDataFrame([(i % 40, _words(rng, 50), "x") for i in range(600)], "doc_id long, text string, place_ string").repartition(4).write.parquet(f"{tmp_path}/d e")
    got = []
    for df in _split_scans(shipped, f"{tmp_path}/d e"):
        rows = numbered_rows(df, "n")
        assert rows.columns == [*df.columns, "n"] and "tally-ckpt" not in rows._jdf.queryExecution().toString()  # no copy
        got.append(sorted(tuple(r) for r in rows.collect()))
    assert got[0] == got[1] and len({r[-1] for r in got[0]}) == 600
    df = shipped.read.parquet(f"{tmp_path}/d e")
    for other in (df.unionByName(df), df.select(F.explode(F.array("doc_id", "doc_id"))), df.limit(0), df.where("doc_id < 0")):
        numbers = [r["n"] for r in numbered_rows(other, "n").collect()]
        assert len(set(numbers)) == len(numbers) == other.count()
