"""Quality classifier: a generalised additive model with pairwise interactions.

Each document is reduced to a few figures of its whole text. Shallow regression trees, boosted in turn
over the figures, are added up into one lookup table per figure; the pairs of figures that explain
most of what is left then get two-way tables the same way. A score is the sum of the table entries of a
document's bins, so scoring is a search into bin edges and additions, vectorised over a batch.

The tables are fitted on the driver from at most ``max_rows`` distinct labelled rows (``bounded_sample``), chosen by
their hash: the sample does not grow with the data, and only its figures (no texts) reach the driver.

Null and empty texts have the figures of an empty text and get a score like any other; rows repeat
as given; with no labelled row at all every score is 0.5, with one class only it is that class's rate
(smoothed). Null labels are left out; of labels and documents with repeated ids every different pair is a row of the
sample; texts of any length are read whole, one at a time; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.llm.common import as_texts, flat_list

FIGURES = (
    "log_words",
    "mean_word_length",
    "distinct_words",
    "repeated_words",
    "commonest_word",
    "distinct_lines",
    "words_per_line",
    "upper",
    "digits",
    "marks",
    "symbols",
    "bars",
    "exclamations",
    "beyond_ascii",
    "words_ending_in_marks",
)

_BYTES = np.arange(256)
_ASCII = "".join(map(chr, range(128)))
_OF_CLASS = {
    "upper": [c.isupper() for c in _ASCII],
    "digits": [c.isdigit() for c in _ASCII],
    "marks": [c in ".,;:'\"()-?" for c in _ASCII],
    "symbols": [c.isprintable() and not c.isalnum() and c not in " .,;:'\"()-?!|" for c in _ASCII],
    "bars": [c == "|" for c in _ASCII],
    "exclamations": [c == "!" for c in _ASCII],
}
_CLASSES = np.zeros((7, 256))
for _i, _k in enumerate(_OF_CLASS):
    _CLASSES[_i, :128] = _OF_CLASS[_k]
_CLASSES[6, 128:] = 1.0


def figures(text: str) -> list[float]:
    """The figures of one whole text, in the order of FIGURES."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n, lines = len(words), raw.split(b"\n")
    if n == 0:
        return [0.0] * len(FIGURES)
    counts = Counter(words)
    shares = _CLASSES @ np.bincount(np.frombuffer(raw, np.uint8), minlength=256) / len(raw)
    ending = sum(not w[-1:].isalnum() and w[-1] < 128 for w in counts)
    return [
        float(np.log1p(n)),
        sum(map(len, words)) / n,
        len(counts) / n,
        sum(map(eq, words, words[1:])) / n,
        max(counts.values()) / n,
        len(set(lines)) / len(lines),
        float(np.log1p(n / len(lines))),
        *shares.tolist(),
        ending / len(counts),
    ]


def with_figures(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, figures array<float>) of every row."""

    def run(batches):
        for b in batches:
            x = np.array([figures(t) for t in as_texts(b["text"])], dtype=np.float32).reshape(-1, len(FIGURES))
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], flat_list(x.ravel(), [len(FIGURES)] * len(x), pa.float32())], names=["doc_id", "figures"]
            )

    src = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, figures array<float>")


def remainder(id_col: str | Column, n: int) -> Column:
    """crc32 of an id as text, modulo n: the split into folds."""
    return F.crc32(F.col(id_col).cast("string").cast("binary") if isinstance(id_col, str) else id_col.cast("string").cast("binary")) % n


def bounded_sample(rows: DataFrame, cols: list[str], max_rows: int, seed: int = 17) -> DataFrame:
    """At most ``max_rows`` of the distinct rows of ``cols``, those of least hash: the same ones whenever asked.

    All of them where they are no more; a row that is repeated counts once."""
    rows = rows.dropDuplicates(cols)
    total = rows.count()
    if total <= max_rows:
        return rows
    h = F.xxhash64(F.lit(seed), *cols)
    # about half as many more as are wanted, so the sort sees few rows; then exactly as many
    near = rows.where(F.pmod(h, F.lit(1_000_000)) <= int(1_500_000 * max_rows / total))
    return near.orderBy(F.pmod(h, F.lit(1_000_000)), h, *cols).limit(max_rows)


@dataclass
class Gam:
    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        if self.edges and len(x):
            at = self.bins(x)
            for j, t in enumerate(self.tables):
                z += t[at[:, j]]
            for i, j, t in self.pairs:
                z += t[at[:, i], at[:, j]]
        return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def _cut(g: np.ndarray, h: np.ndarray, lo: int, hi: int, ridge: float) -> tuple[float, int]:
    """Best cut of the bins [lo, hi): its gain and the first bin of the right side."""
    cg, ch = np.cumsum(g[lo:hi]), np.cumsum(h[lo:hi])
    if hi - lo < 2:
        return 0.0, hi
    left, right = cg[:-1] ** 2 / (ch[:-1] + ridge), (cg[-1] - cg[:-1]) ** 2 / (ch[-1] - ch[:-1] + ridge)
    gain = left + right - cg[-1] ** 2 / (ch[-1] + ridge)
    k = int(np.argmax(gain))
    return float(gain[k]), lo + k + 1


def _tree(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    """A tree of depth two over the bins of one figure, as a step for each bin."""
    n = len(g)
    _, mid = _cut(g, h, 0, n, ridge)
    ends = sorted({0, mid, n, _cut(g, h, 0, mid, ridge)[1], _cut(g, h, mid, n, ridge)[1]})
    step = np.zeros(n)
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        step[a:b] = g[a:b].sum() / (h[a:b].sum() + ridge)
    return step


def _pair_tree(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[np.ndarray, float]:
    """A tree over a two-way table: one cut of the rows, then one cut of the columns on either side."""
    _, mid = _cut(g.sum(1), h.sum(1), 0, len(g), ridge)
    step, gain = np.zeros_like(g), -(g.sum() ** 2) / (h.sum() + ridge)
    for rows in (slice(0, mid), slice(mid, len(g))):
        gc, hc = g[rows].sum(0), h[rows].sum(0)
        k = _cut(gc, hc, 0, len(gc), ridge)[1]
        for cols in (slice(0, k), slice(k, len(gc))):
            sg, sh = gc[cols].sum(), hc[cols].sum()
            step[rows, cols] = sg / (sh + ridge)
            gain += sg**2 / (sh + ridge)
    return step, float(gain)


def fit(x: np.ndarray, y: np.ndarray, bins: int = 24, rounds: int = 150, rate: float = 0.15, n_pairs: int = 6, pair_rounds: int = 40, ridge: float = 2.0) -> Gam:
    """Cyclic boosting of depth-two trees: figures first, then the best pairs on what is left."""
    rate0 = (y.sum() + 0.5) / (len(y) + 1.0)
    m = Gam(base=float(np.log(rate0 / (1 - rate0))))
    if len(y) == 0 or y.min() == y.max():
        return m
    m.edges = [np.unique(np.quantile(x[:, j], np.arange(1, bins) / bins)) for j in range(x.shape[1])]
    m.tables = [np.zeros(len(e) + 1) for e in m.edges]
    at, z = m.bins(x), np.full(len(y), m.base)

    def slopes():
        p = 1.0 / (1.0 + np.exp(-z))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for j, t in enumerate(m.tables):
            g, h = slopes()
            step = rate * _tree(np.bincount(at[:, j], g, len(t)), np.bincount(at[:, j], h, len(t)), ridge)
            t += step
            z += step[at[:, j]]

    def table(i, j, v):
        shape = len(m.tables[i]), len(m.tables[j])
        return np.bincount(at[:, i] * shape[1] + at[:, j], v, shape[0] * shape[1]).reshape(shape)

    g, h = slopes()
    both = [(i, j) for i in range(x.shape[1]) for j in range(i)]
    both.sort(key=lambda ij: (-_pair_tree(table(*ij, g), table(*ij, h), ridge)[1], ij))
    m.pairs = [(i, j, np.zeros((len(m.tables[i]), len(m.tables[j])))) for i, j in both[:n_pairs]]
    for _ in range(pair_rounds):
        for i, j, t in m.pairs:
            g, h = slopes()
            step = rate * _pair_tree(table(i, j, g), table(i, j, h), ridge)[0]
            t += step
            z += step[at[:, i], at[:, j]]
    return m


def fit_labelled(known: DataFrame, labels: DataFrame, label_col: str, max_rows: int = 20_000) -> Gam:
    """Fit on (doc_id, figures) joined to (doc_id, 0/1 label) rows, on ``max_rows`` distinct rows of them at most: so
    many labels are chosen first, and of the documents with their ids so many again (an id may be repeated)."""
    marked = labels.select(F.col("doc_id").cast("long"), F.col(label_col).cast("int").alias("y")).where("y is not null")
    chosen = F.broadcast(bounded_sample(marked, ["doc_id", "y"], max_rows))
    found = bounded_sample(known.join(chosen, "doc_id").select("doc_id", "y", "figures"), ["doc_id", "y", "figures"], max_rows)
    rows = found.orderBy("doc_id", "y", "figures").toPandas()
    x = np.array(rows["figures"].tolist(), dtype=np.float32).reshape(-1, len(FIGURES))
    return fit(x, rows["y"].to_numpy(np.float64))


def score(known: DataFrame, model: Gam) -> DataFrame:
    """(doc_id, score) of (doc_id, figures) rows."""

    def run(batches):
        for b in batches:
            x = b["figures"].flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FIGURES))
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(model.score(x), pa.float64())], names=["doc_id", "score"])

    return known.mapInArrow(run, "doc_id long, score double")
