"""The corpus pipeline: five stages over ``documents``, each calling one operator of ``tally.llm``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and read again as the
next stage's docs. All but the last return the columns of ``docs``.

A stage that decides by row reads ``docs`` twice, once to decide and once to keep. Its rows are numbered by file and place
in the file, the same in both scans however they are split, so no copy of the texts is made.

All stages: null and empty texts, repeated rows, null ids and further columns are allowed, and an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.llm import exact_dedup, langid, mixing, packing, quality_gam, simhash
from tally.llm.common import fresh, numbered_rows
from tally.llm.queries import tokenizer_path
from tally.session import cut_lineage, ship_package


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no language (null text, or no letter) go; the others' ``lang`` becomes the language that their text is
    found to be in, whatever was stated. ``pack_sequences`` goes by it.

    Learned from four folds of five. Only the text decides what goes, so a learned language of any name stays; where
    nothing can be learned, ``lang`` stays as it is."""
    model = langid.fit(docs.where(quality_gam.remainder("doc_id", 5) != 0))
    found, learned = fresh(docs, "found"), bool(model.names)
    seen = docs.withColumn(found, langid.letters_and_language(spark, model)(F.col("text").cast("string"), F.lit(learned)))
    lang = F.col(found)["lang_pred"].cast(docs.schema["lang"].dataType) if learned else F.col("lang")
    return seen.where(F.col(found)["letter"]).select(*(lang.alias(c) if c == "lang" else F.col(c) for c in docs.columns))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z in lower case) the row with the largest doc_id stays."""
    row = fresh(docs, "row")
    rows = numbered_rows(docs, row)
    kept = exact_dedup.exact_dedup(rows, row).where("kept").select(F.col("row").alias(row))
    return rows.join(kept, row, "left_semi").select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component the row with the smallest doc_id stays."""
    row = fresh(docs, "row")
    rows = numbered_rows(docs, row)
    found = simhash.near_duplicates(rows, words_per_shingle=3, radius=2, id_col=row)
    return rows.join(found.where(F.col(row) == F.col("keep_row")).select(row), row, "left_semi").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeated as often as the mix takes them, null, empty and wordless texts never.

    Documents stay whole: one that the mix takes in part (one at most in a shard of a source) is rounded to the nearer
    number of whole copies, half of it or more to one more; so a shard misses its quota by half a document at most."""
    row, copies = fresh(docs, "row"), fresh(docs, "copies")
    rows = numbered_rows(docs, row)
    whole = F.floor((2 * F.col("taken") + F.col("size")) / (2 * F.col("size")))
    mixed = mixing.mix(rows, row).where("taken > 0").select(F.col("row").alias(row), whole.cast("int").alias(copies))
    each = rows.join(mixed.where(F.col(copies) > 0), row).withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies))))
    return each.select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with its sequence and its place there; a sequence holds one language only."""
    return packing.pack(docs, tokenizer_path(), within="lang").drop("row")


STAGES = [
    ("language_id", language_id),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: the stages hash, train and tokenise; tests hold run() against a brute-force version instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut_lineage(docs)
    return docs
