"""Chat formatting, classifiers and language ID: round trips, brute force, held-out accuracy, awkward rows."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tally.llm import chat_format, langid, quality_gam, queries, tokens, toxicity
from tally.sources.io import Tables

PATH = queries.tokenizer_path()


def test_ids_equal_the_tokenizers_library():
    for text in ["", "plain words", "é日本 <|endoftext|> [INST]", "a\x00b", "  \n\n x's 12345", " " * 3000, "naïve—straße"]:
        assert tokens.encode(PATH, text) == tokens.slow_encoder(PATH).encode(text, add_special_tokens=False).ids
        assert tokens.decode(PATH, tokens.encode(PATH, text)) == text


def test_text_that_overflows_the_fast_encoder_is_encoded_too():
    text = "a" + " " * 1_500_000
    ids = tokens.encode(PATH, text)
    assert tokens.decode(PATH, ids) == text


@pytest.mark.parametrize("text", ["</s>[INST] ok [/INST]", r"<\s> <\\s> [\INST]", "<<s>s>", "[[INST]", "\\", "<s", r"[ANS\]", ""])
def test_escaping_is_reversible(text):
    written = chat_format.escape(text)
    assert chat_format.unescape(written) == text
    assert not any(c in written for c in chat_format.CONTROL)


def _by_hand(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        said = [t or "" for _, _, role, t in own if role == "assistant"]
        out[conv] = (len(own), hashlib.sha256("".join(f"{role or ''}\n{t or ''}\n" for _, _, role, t in own).encode()).hexdigest(), sum(map(len, said)), hashlib.sha256("".join(said).encode()).hexdigest())
    return out


def test_conversations_read_back(shipped):
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "</s>[INST]"), (1, 2, "user", None), (1, 3, "assistant", " Spaces  kept \n"),
        (2, None, "system", "a null turn comes first"), (2, 1, "assistant", ""), (3, 0, None, "no role"), (None, 0, "user", "no id"),
        (4, 0, "[INST]", "a role like a mark"), (5, 0, "assistant", "<"), (5, 1, "assistant", "s>"), (6, 0, "user", "w " * 100_000),
    ]
    df = shipped.createDataFrame([(*r, 9, [1]) for r in rows], "conv_id long, turn long, role string, text string, sort_key int, token_ids array<int>").repartition(5)
    turns = chat_format.format_turns(df, PATH)
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat_format.read_back(turns, PATH).collect()}
    assert got == _by_hand(rows)
    whole = {r["conv_id"]: r for r in chat_format.assemble(turns).collect()}
    assert all(len(r["token_ids"]) == len(r["loss_mask"]) for r in whole.values())
    assert chat_format.read_back(chat_format.format_turns(df.limit(0), PATH), PATH).count() == 0


def test_mask_by_prefix_sums():
    t, b, e, a, z = (50257 + i for i in range(5))
    ids = np.array([t, 1, b, 2, e, t, 1, a, 3, 4, z, t, 1, a, z])
    assert chat_format.loss_mask(ids, 50257).tolist() == [0, 0, 0, 0, 0, 0, 0, 0, 1, 1, 0, 0, 0, 0, 0]


@pytest.mark.parametrize(("op", "label", "fold"), [("op2_quality_gam", "quality", (3, 1)), ("op8_toxicity_mil", "toxic", (4, 2))])
def test_held_out_accuracy(shipped, op, label, fold):
    t = Tables(shipped, "/root/testdata/sf0.1")
    rows = getattr(queries, op)(t).join(t.labels, "doc_id").where("held_out").collect()
    assert len(rows) > 300
    right = sum(r["predicted"] == r[label] for r in rows) / len(rows)
    most = max(sum(r[label] == k for r in rows) for k in (0, 1)) / len(rows)
    assert right >= max(0.95, most + 0.02)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_tables_of_the_additive_model_are_its_score():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 3)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)  # an interaction that single figures cannot show
    m = quality_gam.fit(x, y, bins=8, rounds=30, pair_rounds=60, n_pairs=2)
    assert ((m.score(x) >= 0.5) == y).mean() > 0.95
    at = m.bins(x[:5])
    z = [m.base + sum(t[at[k, j]] for j, t in enumerate(m.tables)) + sum(t[at[k, i], at[k, j]] for i, j, t in m.pairs) for k in range(5)]
    assert np.allclose(m.score(x[:5]), [1 / (1 + math.exp(-v)) for v in z])
    assert quality_gam.Gam().score(np.zeros((2, 3))).tolist() == [0.5, 0.5]


def test_noisy_or_finds_the_sentence():
    m = toxicity.Bags(-4.0, {"awful": 6.0})
    score, (a, b, worst), over = m.scorer()("All fine. You awful thing. Bye")
    p0, p1 = 1 / (1 + math.exp(4)), 1 / (1 + math.exp(-2))
    assert score == pytest.approx(1 - (1 - p0) ** 2 * (1 - p1))
    assert "All fine. You awful thing. Bye"[a:b].strip() == "You awful thing" and worst == pytest.approx(p1) and over == 1
    assert m.scorer()("")[0] == pytest.approx(p0)


def test_mixture_of_languages(shipped):
    docs = shipped.createDataFrame([("the house and the tree with the dog " * 30, "en"), ("der Hund und das Haus mit dem Baum " * 30, "de"), ("le chien et la maison avec un arbre " * 30, "fr"), (None, "fr"), ("zzz", None)], "text string, lang string")
    m = langid.fit(docs)
    assert m.names == ["de", "en", "fr"]
    assert m.predict("the tree and the house with the dog")[0] == "en"
    lang, share, both = m.predict("der Hund und das Haus mit dem Baum " * 20 + "the house and the tree with the dog " * 8)
    assert lang == "de" and both == ["de", "en"] and 0.5 < share < 0.9
    assert m.predict(None) == m.predict("") == m.predict("12 !?") == ("und", 0.0, [])
    assert langid.fit(docs.limit(0)).predict("the")[0] == "und"


def test_language_held_out(shipped):
    t = Tables(shipped, "/root/testdata/sf0.1")
    rows = queries.op7_language_id(t).join(t.documents.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) / len(rows) > 0.97


def test_awkward_rows(shipped, edge_docs, no_docs):
    labels = shipped.createDataFrame([(4, 1, 0), (5, 0, 1), (6, None, None), (7, 1, 1), (99, 0, 0)], "doc_id long, quality int, toxic int")
    for docs, n in ((edge_docs, 10), (no_docs, 0)):
        for known_labels in (labels, labels.limit(0)):
            known = quality_gam.with_figures(docs)
            got = quality_gam.score(known, quality_gam.fit_labelled(known, known_labels, "quality")).collect()
            assert len(got) == n and all(0 <= r["score"] <= 1 for r in got)
            got = toxicity.score(docs, toxicity.fit_labelled(docs, known_labels, "toxic")).collect()
            assert len(got) == n and all(0 <= r["score"] <= 1 for r in got)
        got = langid.predict(docs, langid.fit(docs)).collect()
        assert len(got) == n and all((r["lang_pred"] == "und") == (r["doc_id"] in (1, 2, 3, 6)) for r in got)


def test_folds_are_crc32_of_the_id_as_text(shipped):
    import zlib

    got = shipped.range(50).select("id", quality_gam.remainder("id", 5).alias("r")).collect()
    assert all(r["r"] == zlib.crc32(str(r["id"]).encode()) % 5 for r in got)


def test_every_offending_sentence_is_located(shipped):
    text = "All fine. You awful thing. Bye é\nAwful, vile! Fine again. So vile"
    docs = shipped.createDataFrame([(1, text), (2, "All fine."), (3, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in toxicity.score(docs, toxicity.Bags(-4.0, {"awful": 6.0, "vile": 5.0})).collect()}
    p = lambda z: 1 / (1 + math.exp(-z))
    want = [(" You awful thing", p(2)), ("Awful, vile", p(7)), (" So vile", p(1))]
    found = got[1]["offending"]
    assert [text[s["start"] : s["end"]] for s in found] == [t for t, _ in want]
    assert [s["score"] for s in found] == pytest.approx([v for _, v in want])
    assert got[1]["n_offending"] == 3 and text[got[1]["worst_start"] : got[1]["worst_end"]] == "Awful, vile"
    assert got[2]["offending"] == got[3]["offending"] == []
    high = toxicity.score(docs.where("doc_id = 2"), toxicity.Bags(1.0)).first()
    assert high["n_offending"] == 1 and [(s["start"], s["end"]) for s in high["offending"]] == [(0, 8)]


def test_samples_are_bounded_in_rows_and_never_empty(shipped):
    labels = shipped.range(30_000).select((F.col("id") % 3).alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"), (F.col("id") % 2).cast("int").alias("toxic"))
    assert quality_gam.bounded_sample(labels, ["doc_id", "quality"], 100).count() == 6
    assert quality_gam.bounded_sample(shipped.range(50_000).withColumn("y", F.lit(1)), ["id", "y"], 500).count() == 500
    # one id holds most documents, each with another text
    docs = shipped.range(5000).select(F.when(F.col("id") < 4900, 1).otherwise(F.col("id")).cast("long").alias("doc_id"), F.concat_ws(" ", F.lit("text"), F.col("id"), F.when(F.col("id") % 2 == 0, "vile words")).alias("text"))
    marks = shipped.createDataFrame([(1, 1, 1), (1, 1, 1), (1, 0, 0)] + [(i, i % 2, i % 2) for i in range(4900, 5000)], "doc_id long, quality int, toxic int")
    chosen = quality_gam.bounded_sample(marks, ["doc_id", "toxic"], 200).select("doc_id", F.col("toxic").alias("y"))
    assert chosen.count() == 102
    assert quality_gam.bounded_sample(docs.join(chosen, "doc_id"), ["doc_id", "y", "text"], 200).count() == 200
    model = toxicity.fit_labelled(docs, marks, "toxic", max_rows=200)
    assert toxicity.score(docs, model).count() == 5000
    known = quality_gam.with_figures(docs)
    assert quality_gam.score(known, quality_gam.fit_labelled(known, marks, "quality", max_rows=200)).count() == 5000


def test_rows_of_one_turn_go_by_role_and_text(shipped):
    rows = [(1, 0, "z", "hello"), (1, 0, "z", "a"), (1, 0, "b", "zz"), (1, 1, "assistant", "yes"), (1, 1, "assistant", "Yes"), (1, None, "user", "é"), (2, 0, "user", None), (None, 3, None, "x")]
    df = shipped.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    got = {r["conv_id"]: r for r in chat_format.read_back(chat_format.format_turns(df, queries.tokenizer_path()), queries.tokenizer_path()).collect()}
    said = [("user", "é"), ("b", "zz"), ("z", "a"), ("z", "hello"), ("assistant", "Yes"), ("assistant", "yes")]
    assert got[1]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest()
    assert got[1]["loss_sha256"] == hashlib.sha256(b"Yesyes").hexdigest() and got[1]["n_turns"] == 6
    assert got[2]["n_turns"] == got[None]["n_turns"] == 1


def _mixture_naive(model, text, steps=12, penalty=3.0):
    """The same mixture with loops over languages and trigrams."""
    n = {}
    for s in langid.slots(text).tolist():
        n[s] = n.get(s, 0) + 1
    share = [{s: math.exp(model.log_share[k][s]) for s in n} for k in range(len(model.names))]

    def loglike(p):
        return sum(c * math.log(sum(w * share[k][s] for k, w in p.items())) for s, c in n.items())

    def em(languages):
        p = {k: 1 / len(languages) for k in languages}
        for _ in range(steps if len(languages) > 1 else 0):
            new = dict.fromkeys(languages, 0.0)
            for s, c in n.items():
                total = sum(p[k] * share[k][s] for k in languages)
                for k in languages:
                    new[k] += c * p[k] * share[k][s] / total
            p = {k: v / sum(n.values()) for k, v in new.items()}
        return p

    every = em(range(len(model.names)))
    one = max(range(len(model.names)), key=lambda k: (loglike({k: 1.0}), -k))
    chosen, p, best = [one], {one: 1.0}, loglike({one: 1.0})
    for k in sorted(every, key=lambda k: (-every[k], k)):
        if k not in chosen:
            q = em(sorted([*chosen, k]))
            if loglike(q) - best <= penalty * math.log1p(sum(n.values())):
                break
            chosen, p, best = [*chosen, k], q, loglike(q)
    top = max(sorted(p), key=lambda k: p[k])
    total = sum(n.values())
    return model.names[top], (p[top] * total + 0.5) / (total + 0.5 * len(model.names)), {model.names[k] for k in chosen}


def test_mixtures_by_brute_force(shipped, sf):
    t = Tables(shipped, sf)
    model = langid.fit(t.documents)
    texts = [d["text"] for d in t.documents.orderBy("doc_id").limit(60).collect() if langid.has_letter(d["text"])]
    texts += [a[:300] + " " + b[:200] for a, b in zip(texts[::2], texts[1::2])]  # mixtures
    for text in texts:
        got, want = model.predict(text[:1500]), _mixture_naive(model, text[:1500])
        assert got[0] == want[0] and got[1] == pytest.approx(min(1.0, want[1])) and set(got[2]) == want[2]


def test_noisy_or_gradient_and_fit():
    """One step of the training moves every weight against the numerical slope of the noisy-or loss; many lower it."""
    rng = np.random.default_rng(3)
    docs = [[sorted(set(rng.integers(0, 6, rng.integers(0, 4)).tolist())) for _ in range(rng.integers(1, 5))] for _ in range(80)]
    y = np.array([float(any(0 in s and 1 in s or 2 in s for s in d)) for d in docs])
    hits = [[s for s in d if s] for d in docs]
    sentences, plain = np.array([len(h) for h in hits]), np.array([len(d) - len(h) for d, h in zip(docs, hits)])
    sizes = np.array([len(s) for h in hits for s in h])
    feats = np.array([f for h in hits for s in h for f in s], dtype=np.int64)

    def loss(w, bias, ridge):
        out = 0.0
        for d, label in zip(docs, y):
            none = math.prod(1 - 1 / (1 + math.exp(-(bias + sum(w[f] for f in s)))) for s in d)
            q = min(max(1 - none, 1e-9), 1 - 1e-9)
            out -= label * math.log(q) + (1 - label) * math.log(1 - q)
        return out / len(docs) + ridge * sum(v * v for v in w) / 2

    w0, bias, ridge = np.zeros(6), -2.0, 1e-3
    w, b = toxicity._train(sentences, sizes, feats, y, plain, 6, bias, 1, 1e-3, ridge)
    for f in range(6):
        up, down = w0.copy(), w0.copy()
        up[f], down[f] = 1e-5, -1e-5
        slope = (loss(up, bias, ridge) - loss(down, bias, ridge)) / 2e-5
        assert abs(slope) < 1e-4 or np.sign(w[f]) == -np.sign(slope)
    slope = (loss(w0, bias + 1e-5, ridge) - loss(w0, bias - 1e-5, ridge)) / 2e-5
    assert np.sign(b - bias) == -np.sign(slope)
    w, b = toxicity._train(sentences, sizes, feats, y, plain, 6, bias, 600, 0.05, ridge)
    assert loss(w, b, ridge) < 0.6 * loss(w0, math.log(0.2 / 0.8), ridge) and w[2] == max(w)
    for f in range(6):  # at the end no weight can be moved to lower the loss much
        for step in (-0.02, 0.02):
            moved = w.copy()
            moved[f] += step
            assert loss(moved, b, ridge) > loss(w, b, ridge) - 1e-3


def test_tables_follow_planted_effects():
    """The additive fit beside a search: a step in one figure and a product of two others are found and scored."""
    rng = np.random.default_rng(5)
    x = rng.random((4000, len(quality_gam.FIGURES)))
    z = 2.0 * (x[:, 2] > 0.6) + 3.0 * ((x[:, 4] > 0.5) ^ (x[:, 7] > 0.5)) - 2.0
    y = (rng.random(4000) < 1 / (1 + np.exp(-z))).astype(float)
    model = quality_gam.fit(x, y)
    effect = [t.max() - t.min() for t in model.tables]
    assert int(np.argmax(effect)) == 2 and (7, 4) in [(i, j) for i, j, _ in model.pairs]
    p, truth = model.score(x), 1 / (1 + np.exp(-z))
    alone = quality_gam.Gam(model.base, model.edges, model.tables).score(x)
    assert np.mean((p - truth) ** 2) < 0.6 * np.var(truth) and np.mean((p - truth) ** 2) < 0.75 * np.mean((alone - truth) ** 2)
    naive = np.full(len(x), model.base)
    for r in range(len(x)):
        at = [int(sum(e <= x[r, j])) for j, e in enumerate(model.edges)]
        naive[r] += sum(t[a] for t, a in zip(model.tables, at)) + sum(t[at[i], at[j]] for i, j, t in model.pairs)
    assert np.allclose(p, 1 / (1 + np.exp(-np.clip(naive, -30, 30))))
