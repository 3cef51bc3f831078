"""Text features (X13, X14, M11, M12): cleaning, stop words, Porter stems, bag of words.

Cleaning and counting are Spark expressions over whole texts. Only stemming (a pandas UDF over counted tokens, each
distinct token of a batch once) and building ML vectors (once per document) run in Python.
"""

from __future__ import annotations

import functools
import glob
import os
import zipfile
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from tally.session import cut_lineage


@functools.lru_cache(maxsize=None)
def stop_words(language: str = "english") -> tuple[str, ...]:
    """Spark ML's default stop-word list (``StopWordsRemover.loadDefaultStopWords``), read from
    the mllib jar so no JVM is needed (the oracle SQL is generated from the same list)."""
    import pyspark

    jars = os.path.join(os.path.dirname(pyspark.__file__), "jars")
    for jar in sorted(glob.glob(os.path.join(jars, "spark-mllib_*.jar"))):
        with zipfile.ZipFile(jar) as z:
            name = f"org/apache/spark/ml/feature/stopwords/{language}.txt"
            if name in z.namelist():
                return tuple(z.read(name).decode("utf-8").split())
    from pyspark.ml.feature import StopWordsRemover

    return tuple(StopWordsRemover.loadDefaultStopWords(language))


def clean_tokens(text: str | Column, stop: tuple[str, ...] | None = None, min_len: int = 1) -> Column:
    """X13 + X14: letters only, lower case, split on blanks, stop words removed."""
    t = F.col(text) if isinstance(text, str) else text
    letters = F.lower(F.regexp_replace(t, "[^a-zA-Z]", " "))
    toks = F.filter(F.split(F.trim(letters), r"\s+"), lambda w: F.length(w) >= F.lit(max(1, min_len)))
    if stop:
        # ``isin`` with many literals is planned as a hash-set lookup (InSet), not a list scan
        stop_list = list(stop)
        toks = F.filter(toks, lambda w: ~w.isin(stop_list))
    return toks


def tokens_long(df: DataFrame, doc_col: str, text_col: str, stop: tuple[str, ...] | None = None) -> DataFrame:
    """``(doc, token)`` rows of the cleaned texts; stop words are removed after the explode,
    where ``isin`` is planned as a hash-set probe. A run of other signs becomes one blank, so words are split at a single
    blank without a second pattern."""
    letters = F.lower(F.regexp_replace(F.col(text_col), "[^a-zA-Z]+", " "))
    out = df.select(doc_col, F.explode(F.split(letters, " ")).alias("token")).filter(F.length("token") >= 1)
    if stop:
        out = out.filter(~F.col("token").isin(list(stop)))
    return out


# ---- Porter stemmer with the extensions of common toolkits -------------------------------------
# Fixed values from the published algorithm and its extensions: suffix rules of steps 2, 3 and 4, irregular forms.
_STEP2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ("fulli", "ful"), ("logi", "log"),
)
_STEP3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""),
)
_STEP4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
    "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)
_IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}


def _is_cons(w: str, i: int) -> bool:
    c = w[i]
    if c in "aeiou":
        return False
    if c == "y":
        return i == 0 or not _is_cons(w, i - 1)
    return True


def _measure(stem: str) -> int:
    """m in [C](VC)^m[V]."""
    m, i, n = 0, 0, len(stem)
    while i < n and _is_cons(stem, i):
        i += 1
    while i < n:
        while i < n and not _is_cons(stem, i):
            i += 1
        if i >= n:
            break
        while i < n and _is_cons(stem, i):
            i += 1
        m += 1
    return m


def _has_vowel(stem: str) -> bool:
    return any(not _is_cons(stem, i) for i in range(len(stem)))


def _double_cons(w: str) -> bool:
    return len(w) >= 2 and w[-1] == w[-2] and _is_cons(w, len(w) - 1)


def _cvc(w: str) -> bool:
    n = len(w)
    if n == 2:
        return not _is_cons(w, 0) and _is_cons(w, 1)
    return (
        n >= 3 and _is_cons(w, n - 3) and not _is_cons(w, n - 2) and _is_cons(w, n - 1) and w[-1] not in "wxy"
    )


@functools.lru_cache(maxsize=1 << 17)  # frequent tokens stay with the Python worker; the size bounds its memory
def porter_stem(word: str) -> str:
    """Porter's suffix stripping (steps 1a-5b) in the extended variant: irregular forms come from a list, ``ies`` and
    ``ied`` of four-letter words keep ``ie`` (dies -> die), ``y`` turns into ``i`` only after a consonant that is not
    the first letter (enjoy stays), ``bli``, ``fulli``, ``logi`` are suffixes of step 2, and a stripped ``alli`` goes
    through step 2 again. Words of up to 2 letters are kept."""
    w = word
    if w in _IRREGULAR:
        return _IRREGULAR[w]
    if len(w) <= 2:
        return w
    # step 1a
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith("ies"):
        w = w[:-1] if len(w) == 4 else w[:-2]
    elif w.endswith("ss"):
        pass
    elif w.endswith("s"):
        w = w[:-1]
    # step 1b
    extra = False
    if w.endswith("ied"):
        w = w[:-1] if len(w) == 4 else w[:-2]
    elif w.endswith("eed"):
        if _measure(w[:-3]) > 0:
            w = w[:-1]
    elif w.endswith("ed") and _has_vowel(w[:-2]):
        w, extra = w[:-2], True
    elif w.endswith("ing") and _has_vowel(w[:-3]):
        w, extra = w[:-3], True
    if extra:
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif _double_cons(w) and w[-1] not in "lsz":
            w = w[:-1]
        elif _measure(w) == 1 and _cvc(w):
            w += "e"
    # step 1c
    if w.endswith("y") and len(w) > 2 and _is_cons(w, len(w) - 2):
        w = w[:-1] + "i"
    # step 2
    if w.endswith("alli") and _measure(w[:-4]) > 0:
        w = w[:-2]
    for suf, rep in _STEP2:
        if w.endswith(suf):
            if _measure(w[:-3] if suf == "logi" else w[: -len(suf)]) > 0:
                w = w[: -len(suf)] + rep
            break
    # step 3
    for suf, rep in _STEP3:
        if w.endswith(suf):
            if _measure(w[: -len(suf)]) > 0:
                w = w[: -len(suf)] + rep
            break
    # step 4 (longest matching suffix)
    for suf in sorted(_STEP4, key=len, reverse=True):
        if w.endswith(suf):
            stem = w[: -len(suf)]
            if _measure(stem) > 1 and (suf != "ion" or (stem and stem[-1] in "st")):
                w = stem
            break
    # step 5a
    if w.endswith("e"):
        stem = w[:-1]
        m = _measure(stem)
        if m > 1 or (m == 1 and not _cvc(stem)):
            w = stem
    # step 5b
    elif _measure(w) > 1 and _double_cons(w) and w.endswith("l"):
        w = w[:-1]
    return w


@pandas_udf(T.StringType())
def stem(tokens: pd.Series) -> pd.Series:
    """M12 as a column: a token met before by the same worker is looked up."""
    return pd.Series([None if t is None else porter_stem(t) for t in tokens], index=tokens.index, dtype=object)


def _spread(df: DataFrame, *cols: str) -> DataFrame:
    """As many partitions as the session shuffles into: AQE merges small shuffles, and stemming costs far more a byte than
    the sizes it goes by suggest."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *cols)


def stem_vocabulary(tokens: DataFrame, token_col: str = "token") -> DataFrame:
    """``(token, stem)`` for every distinct token."""
    distinct = tokens.select(F.col(token_col).alias("token")).filter(F.col("token").isNotNull()).distinct()
    return _spread(distinct, "token").select("token", stem("token").alias("stem"))


def stem_corpus_counts(tokens: DataFrame, token_col: str = "token") -> DataFrame:
    """``(term, tf)`` corpus counts of Porter stems: tokens are counted first (map-side partial
    aggregation collapses repeats), then each distinct token is stemmed once."""
    per_token = tokens.groupBy(F.col(token_col).alias("token")).agg(F.count(F.lit(1)).alias("_c"))
    return _spread(per_token, "token").select(stem("token").alias("term"), "_c").groupBy("term").agg(F.sum("_c").alias("tf"))


def bow_vocabulary_from_counts(counts: DataFrame, max_features: int = 1500) -> DataFrame:
    """M11 on ``(doc, term, tf)`` counts: top terms by corpus count, ties alphabetical,
    alphabetical term index."""
    totals = counts.filter(F.length("term") >= 2).groupBy("term").agg(F.sum("tf").alias("corpus_count"))
    top = totals.orderBy(F.col("corpus_count").desc(), F.col("term")).limit(max_features)
    # a window over at most ``max_features`` rows: bounded by construction
    return top.withColumn("term_index", (F.row_number().over(Window.orderBy("term")) - 1).cast("int"))


def term_numbers(tokens: DataFrame, max_features: int = 1500, token_col: str = "token") -> tuple[DataFrame, DataFrame]:
    """M11 + M12: the vocabulary (term, corpus_count, term_index) and (token, term_index) of every token whose stem is in
    it. Tokens are counted and stemmed once over the corpus; documents are not needed for it."""
    per_token = tokens.groupBy(F.col(token_col).alias("token")).agg(F.count(F.lit(1)).alias("tf"))
    stems = cut_lineage(_spread(per_token, "token").select("token", stem("token").alias("term"), "tf"))
    vocab = cut_lineage(bow_vocabulary_from_counts(stems.groupBy("term").agg(F.sum("tf").alias("tf")), max_features))
    # at most max_features rows
    return vocab, stems.join(F.broadcast(vocab.select("term", "term_index")), "term").select("token", "term_index")


def bow_counts_by_token(doc_tokens: DataFrame, numbers: DataFrame, doc_col: str, token_col: str = "token") -> DataFrame:
    """``(doc, term_index, tf)``: each token is replaced by the number of its stem, then counted. ``numbers`` holds the
    inflected forms of at most ``max_features`` stems, which Spark broadcasts by its written size, so the tokens are
    shuffled once, as partial counts per document and term."""
    j = doc_tokens.select(doc_col, F.col(token_col).alias("token")).join(numbers, "token")
    return j.groupBy(doc_col, "term_index").agg(F.count(F.lit(1)).alias("tf"))


def bow_vectors(df: DataFrame, counts: DataFrame, terms: Sequence[str], doc_col: str, out: str = "features") -> DataFrame:
    """``df`` with one sparse ML vector per document from the long counts ``(doc, term_index, tf)``: each document's
    terms as an array, as often as they stand in it, and Spark's own ``CountVectorizerModel`` on it. ``terms`` is the
    vocabulary in the order of its numbers; a document without counted terms gets the zero vector."""
    from pyspark.ml.feature import CountVectorizerModel

    if not terms:
        raise ValueError("the vocabulary is empty")
    names = F.array(*[F.lit(w) for w in terms])
    # numbers and counts are shuffled, not the repeated terms: those are written out once a document's list is complete
    listed = counts.groupBy(F.col(doc_col).alias("_doc")).agg(F.collect_list(F.struct("term_index", F.col("tf").cast("int").alias("tf"))).alias("_counts"))
    each = F.transform("_counts", lambda c: F.array_repeat(F.get(names, c["term_index"]), c["tf"]))
    per = listed.select("_doc", F.flatten(each).alias("_terms"))
    j = df.join(per, F.col(doc_col) == F.col("_doc"), "left")
    ready = j.withColumn("_terms", F.coalesce("_terms", F.array().cast("array<string>"))).drop("_doc")
    model = CountVectorizerModel.from_vocabulary(list(terms), inputCol="_terms", outputCol=out)
    return model.transform(ready).drop("_terms")
