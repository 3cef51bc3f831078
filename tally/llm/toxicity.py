"""Toxicity by multiple-instance learning.

A document is a bag of sentences, a sentence a set of features (its words, and the first letters of each
word). A logistic score p of every sentence gives the document the noisy-or 1 - prod(1 - p): one toxic
sentence is enough. Weights are trained from document labels alone; the sentence scores then say where.

The model is fitted on at most ``max_rows`` distinct labelled documents (chosen by hash, see
``quality_gam.bounded_sample``): which features are kept is decided by counts over them in Spark, and the
weights are fitted on the driver from the kept features of each sentence.

Null and empty texts count as one sentence without features and get its score; rows repeat as given;
without labelled rows every sentence scores as the smoothed base rate says. Of labels and documents with repeated
ids every different pair is a row of the sample; texts of any length are read whole, sentence by sentence; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.llm.common import as_texts
from tally.llm.quality_gam import bounded_sample
from tally.session import cut_lineage

SENTENCE = re.compile(r"[^.!?\n]+")
_EDGE = re.compile(r"^\W+|\W+$")
PREFIXES = (3, 4, 5)
SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])


def word_features(token: str) -> list[str]:
    """A word in lower case without marks at its ends, and its beginnings."""
    w = _EDGE.sub("", token.lower())
    return [w, *(f"{w[:k]}~" for k in PREFIXES if len(w) >= k)] if w else []


class _Memo(dict):
    """What a token stands for, worked out once per distinct token; emptied when it gets large."""

    def __init__(self, of, most: int = 500_000):
        self.of, self.most = of, most

    def __missing__(self, token):
        if len(self) > self.most:
            self.clear()
        self[token] = v = self.of(token)
        return v


@dataclass
class Bags:
    """Sentence scores: weight of each kept feature, and the bias of a sentence."""

    bias: float
    weights: dict[str, float] = field(default_factory=dict)

    def scorer(self):
        memo = _Memo(lambda t: tuple(f for f in word_features(t) if f in self.weights))
        none = 1.0 / (1.0 + np.exp(-self.bias))

        def of(text: str, found: list | None = None):
            """Noisy-or of a text; (start, end, score) of its worst sentence; number of sentences of 0.5 or more, each
            of which is also added to ``found`` as (start, end, score)."""
            kept, worst, over, plain = 0.0, (0, 0, none), 0, 0
            for m in SENTENCE.finditer(text):
                hit = {f for t in set(m[0].split()) for f in memo[t]}
                if not hit:
                    plain += 1
                    if none >= 0.5:
                        over += 1
                        if found is not None:
                            found.append((m.start(), m.end(), float(none)))
                    continue
                p = 1.0 / (1.0 + np.exp(-min(30.0, max(-30.0, self.bias + sum(map(self.weights.__getitem__, sorted(hit)))))))
                kept += np.log1p(-min(p, 1 - 1e-12))
                if p >= 0.5:
                    over += 1
                    if found is not None:
                        found.append((m.start(), m.end(), float(p)))
                if p > worst[2]:
                    worst = (m.start(), m.end(), p)
            kept += max(plain, not kept) * np.log1p(-none)
            return 1.0 - float(np.exp(kept)), worst, over

        return of


def feature_counts(rows: DataFrame) -> DataFrame:
    """(feature, documents that have it with label 0, with label 1) over the (text, y) rows."""

    def run(batches):
        counts: Counter = Counter()

        def out():
            k = list(counts)
            return pa.RecordBatch.from_arrays([pa.array([f for f, _ in k], pa.string()), pa.array([y for _, y in k], pa.int32()), pa.array([counts[x] for x in k], pa.int64())], names=["feature", "y", "n"])

        memo = _Memo(word_features)
        for b in batches:
            for text, y in zip(as_texts(b["text"]), b["y"].to_pylist(), strict=True):
                counts.update((f, y) for f in {f for t in set(text.split()) for f in memo[t]})
            if len(counts) > 200_000:
                yield out()
                counts.clear()
        yield out()

    n = rows.select("text", "y").mapInArrow(run, "feature string, y int, n long")
    return n.groupBy("feature").agg(F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("n0"), F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("n1"))


def choose_features(rows: DataFrame, most: int) -> tuple[list[str], int, int]:
    """The ``most`` features whose presence says most about the label (likelihood ratio of a two by two table)."""
    total = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    t0, t1 = float(total.get(0, 0)), float(total.get(1, 0))
    n0, n1 = F.col("n0").cast("double"), F.col("n1").cast("double")

    def part(n, of, all_of):
        return F.when(n > 0, n * F.log(n * (t0 + t1) / (of * all_of))).otherwise(0.0)

    said = part(n0, n0 + n1, F.lit(t0)) + part(n1, n0 + n1, F.lit(t1)) + part(t0 - n0, t0 + t1 - n0 - n1, F.lit(t0)) + part(t1 - n1, t0 + t1 - n0 - n1, F.lit(t1))
    if not (t0 and t1):
        return [], int(t0), int(t1)
    best = feature_counts(rows).where(n0 + n1 >= 3).withColumn("said", said).orderBy(F.desc("said"), "feature").limit(most)
    return [r["feature"] for r in best.collect()], int(t0), int(t1)


def _train(sentences: np.ndarray, sizes: np.ndarray, feats: np.ndarray, y: np.ndarray, plain: np.ndarray, n_features: int, bias: float, steps: int, rate: float, ridge: float):
    """Gradient steps (Adam) on the log loss of the noisy-or. Document i has ``sentences[i]`` sentences with features and
    ``plain[i]`` without; sentence s has the next ``sizes[s]`` of ``feats``."""
    sent_doc = np.repeat(np.arange(len(y)), sentences)
    of_sent = np.repeat(np.arange(len(sizes)), sizes)
    w = np.zeros(n_features + 1)
    w[-1] = bias
    m, v = np.zeros_like(w), np.zeros_like(w)
    for k in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(w[-1] + np.bincount(of_sent, w[feats], len(sizes)), -30, 30)))
        p0 = 1 / (1 + np.exp(-w[-1]))
        none = np.bincount(sent_doc, np.log1p(-np.minimum(p, 1 - 1e-9)), len(y)) + plain * np.log1p(-p0)
        q = np.clip(1 - np.exp(none), 1e-9, 1 - 1e-9)
        pull = y * (1 - q) / q - (1 - y)  # d loss / d sentence logit is -pull * p
        gs = pull[sent_doc] * p
        g = np.bincount(feats, gs[of_sent], n_features + 1) if len(feats) else np.zeros(n_features + 1)
        g[-1] = gs.sum() + (pull * plain).sum() * p0
        g = g / len(y) - ridge * np.append(w[:-1], 0.0)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w + rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
    return w[:-1], float(w[-1])


def fit_labelled(docs: DataFrame, labels: DataFrame, label_col: str, max_rows: int = 16_000, features: int = 2000, steps: int = 300, rate: float = 0.05, ridge: float = 1e-5) -> Bags:
    """Fit from (doc_id, text) and (doc_id, 0/1 label) on ``max_rows`` distinct labelled documents at most. So many
    labels are chosen first (that list is bounded, so it is broadcast and texts are not shuffled), and of the
    documents with their ids so many again (an id may be repeated)."""
    marked = labels.select(F.col("doc_id").cast("long"), F.col(label_col).cast("int").alias("y")).where("y in (0, 1)")
    chosen = F.broadcast(bounded_sample(marked, ["doc_id", "y"], max_rows))
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = cut_lineage(bounded_sample(texts.join(chosen, "doc_id"), ["doc_id", "y", "text"], max_rows))
    kept, t0, t1 = choose_features(rows, features)
    if not kept:
        rate1 = (t1 + 0.5) / (t0 + t1 + 1.0)
        return Bags(float(np.log(rate1 / (1 - rate1))))
    number = {f: i for i, f in enumerate(kept)}

    def run(batches):
        memo = _Memo(lambda t: tuple(number[f] for f in word_features(t) if f in number))
        for b in batches:
            hits, plain = [], []
            for text in as_texts(b["text"]):
                of = [sorted({f for t in set(s.split()) for f in memo[t]}) for s in SENTENCE.findall(text)] or [[]]
                hits.append([s for s in of if s])
                plain.append(len(of) - len(hits[-1]))
            sizes = [[len(s) for s in h] for h in hits]
            feats = [[f for s in h for f in s] for h in hits]
            ints = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["y"], pa.array(plain, pa.int64()), pa.array(sizes, ints), pa.array(feats, ints)], names=["doc_id", "y", "plain", "sizes", "feats"])

    sparse = rows.select("doc_id", "y", "text").mapInArrow(run, "doc_id long, y int, plain long, sizes array<int>, feats array<int>")
    got = sparse.orderBy("doc_id", "y").toArrow().combine_chunks()

    def flat(name: str) -> tuple[np.ndarray, np.ndarray]:
        lists = got[name].combine_chunks()
        return np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy(zero_copy_only=False)

    sentences, sizes = flat("sizes")
    y, plain = got["y"].to_numpy().astype(np.float64), got["plain"].to_numpy().astype(np.float64)
    w, bias = _train(sentences, sizes, flat("feats")[1], y, plain, len(kept), -5.0, steps, rate, ridge)
    return Bags(bias, {f: float(w[i]) for f, i in number.items()})


def score(docs: DataFrame, model: Bags) -> DataFrame:
    """doc_id, score, and the worst sentence: worst_start, worst_end (code points), worst_score; n_offending
    counts the sentences of 0.5 or more, and offending has the start, end and score of each, in order of place."""

    def run(batches):
        of = model.scorer()
        for b in batches:
            found = [[] for _ in range(len(b))]
            got = [of(t, f) for t, f in zip(as_texts(b["text"]), found, strict=True)]
            cols = [[g[0] for g in got], [g[1][0] for g in got], [g[1][1] for g in got], [float(g[1][2]) for g in got], [g[2] for g in got]]
            kinds = [pa.float64(), pa.int64(), pa.int64(), pa.float64(), pa.int64()]
            spans = pa.array([[dict(zip(("start", "end", "score"), x, strict=True)) for x in f] for f in found], pa.list_(SPAN))
            yield pa.RecordBatch.from_arrays([b["doc_id"], *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True)), spans], names=["doc_id", "score", "worst_start", "worst_end", "worst_score", "n_offending", "offending"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, score double, worst_start long, worst_end long, worst_score double, n_offending long, offending array<struct<start: long, end: long, score: double>>")
