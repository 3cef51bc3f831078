"""Language identification by a mixture over languages.

Byte trigrams (letters in lower case, everything else in ASCII as a space) are hashed into a table; each
language learns the shares of its trigrams. A document is a mixture of languages: expectation-maximisation
finds the proportions under which its trigrams are likeliest. The set of languages starts with the single
likeliest one and takes in the next largest share only while the likelihood gains more than a penalty per
language. The prediction is the largest share of the set, ties to the smaller name.

Counts cover all rows given, are summed inside each task and then by key in Spark; the model is one table of
``SLOTS`` shares per language. A text that is null or without any letter is ``und`` with score 0, and so is
every text when nothing was learned. A learned language may have any name, ``und`` too. Rows repeat as given; rows
without language teach nothing; texts of any length are read whole, into a table of fixed size; an empty table gives
an empty result; other columns are ignored. The driver gets one table per language: languages are few.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

UNDETERMINED = "und"
SLOTS = 1 << 14
_TABLE = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)).lower()


def slots(text: str) -> np.ndarray:
    """Hashed trigrams of a whole text, one for each place."""
    raw = np.frombuffer(b" " + text.lower().encode("utf-8", "surrogatepass").translate(_TABLE) + b" ", np.uint8).astype(np.uint32)
    if len(raw) < 3:
        return np.zeros(0, np.int64)
    code = (raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(18)).astype(np.int64)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass
class Languages:
    names: list[str]
    log_share: np.ndarray  # languages x SLOTS

    def predict(self, text: str | None, steps: int = 12, penalty: float = 3.0) -> tuple[str, float, list[str]]:
        """Language, its share (drawn towards an even split by half a trigram per language) and the set."""
        if not self.names or not has_letter(text):
            return UNDETERMINED, 0.0, []
        n = np.bincount(slots(text), minlength=SLOTS)
        at = np.flatnonzero(n)
        n = n[at].astype(np.float64)
        logs = self.log_share[:, at]
        like = np.exp(logs - logs.max(axis=0))
        shift = float(n @ logs.max(axis=0))

        def mixture(rows: np.ndarray) -> tuple[np.ndarray, float]:
            p, x = np.full(len(rows), 1.0 / len(rows)), like[rows]
            for _ in range(steps if len(rows) > 1 else 0):
                p = p * (x @ (n / np.maximum(p @ x, 1e-300))) / n.sum()
            return p, shift + float(n @ np.log(np.maximum(p @ x, 1e-300)))

        every = np.arange(len(self.names))
        shares = mixture(every)[0]
        chosen = np.array([int(np.argmax(logs @ n))])
        best, cost = mixture(chosen)[1], penalty * np.log1p(n.sum())
        p = np.ones(1)
        for k in np.argsort(-shares, kind="stable"):
            if k in chosen:
                continue
            wider = np.sort(np.append(chosen, k))
            q, got = mixture(wider)
            if got - best <= cost:
                break
            chosen, p, best = wider, q, got
        top = int(np.argmax(p))
        total = n.sum()
        score = (p[top] * total + 0.5) / (total + 0.5 * len(self.names))
        return self.names[int(chosen[top])], float(min(1.0, score)), [self.names[int(k)] for k in chosen]


def count_trigrams(docs: DataFrame) -> DataFrame:
    """(lang, slot, n) over all (text, lang) rows with a language."""

    def run(batches):
        counts: dict[str, np.ndarray] = {}

        def out():
            for lang, n in counts.items():
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at])], names=["lang", "slot", "n"])
            counts.clear()

        for b in batches:
            for text, lang in zip(b["text"].to_pylist(), b["lang"].to_pylist(), strict=True):
                if lang not in counts:
                    if len(counts) >= 500:
                        yield from out()
                    counts[lang] = np.zeros(SLOTS, np.int64)
                if text:
                    counts[lang] += np.bincount(slots(text), minlength=SLOTS)
        yield from out()

    src = docs.where("lang is not null").select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    return src.mapInArrow(run, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, smooth: float = 0.5) -> Languages:
    """Learn from all (text, lang) rows. The driver gets one row of counts per language."""
    got = count_trigrams(docs).groupBy("lang").agg(F.collect_list("slot").alias("slot"), F.collect_list("n").alias("n")).orderBy("lang").collect()
    got = sorted((r for r in got if sum(r["n"])), key=lambda r: r["lang"])
    n = np.full((len(got), SLOTS), smooth)
    for i, r in enumerate(got):
        n[i, r["slot"]] += r["n"]
    return Languages([r["lang"] for r in got], np.log(n / n.sum(axis=1, keepdims=True)) if got else n)


def language_of(spark: SparkSession, model: Languages):
    """A column function: text -> struct(lang_pred, score, lang_set)."""
    shared = spark.sparkContext.broadcast(model)  # SLOTS shares per language

    @pandas_udf("struct<lang_pred: string, score: double, lang_set: array<string>>")
    def of(text):
        import pandas as pd

        return pd.DataFrame([shared.value.predict(t) for t in text], columns=["lang_pred", "score", "lang_set"])

    return of


def letters_and_language(spark: SparkSession, model: Languages):
    """A column function: (text, wanted) -> struct(letter, lang_pred): whether the text holds a letter, and its language
    where that is wanted. Not deterministic to Spark, which else would run it once for a filter and once for a column."""
    shared = spark.sparkContext.broadcast(model)

    @pandas_udf("struct<letter: boolean, lang_pred: string>")
    def of(text, wanted):
        import pandas as pd

        rows = [(has_letter(t), shared.value.predict(t)[0] if w else None) for t, w in zip(text, wanted, strict=True)]
        return pd.DataFrame(rows, columns=["letter", "lang_pred"])

    return of.asNondeterministic()


def predict(docs: DataFrame, model: Languages, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, lang_set) of every row."""
    of = language_of(docs.sparkSession, model)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), of(F.col(text_col).cast("string")).alias("p")).select("doc_id", "p.*")
