"""A corpus pipeline: language ID, near-duplicates, benchmark decontamination, personal data, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import decontam, language_id, near_dup, packing, pii, store


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a recognisable language (und: null, empty or letterless text).

    Where no document has a lang, no language is known, and those with a letter are kept. Repeated rows and rows with a
    null key, lang or source are judged by their text alike. Empty tables stay empty; other columns pass through.
    """
    model = language_id.fit(docs)
    if not model.names:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return docs.where(language_id.predict(docs, model)["lang_pred"] != "und")


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least key of each class of near-duplicates.

    Texts without words and rows with a null key or text are in no class and stay, as do all rows of a kept key. Empty
    tables stay empty; other columns pass through.
    """
    return near_dup.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain a benchmark item. Rows with a null key or text stay; null items play no part. Empty
    tables and other columns pass through."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind in brackets; n_chars, where there is such a column, follows the text.

    Null and empty texts stay as they are. Repeated rows are redacted alike; other columns pass through.
    """
    found = docs.withColumn("text", pii.detect(docs, pii.fit(docs), redact=True)["redacted"])
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.char_length("text").cast("long"))
    return found.select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 4096 tokens. A null or empty text is the end id alone; a null key stays null; repeated
    rows are each packed."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language_id", identified), ("near_dedup", deduplicated), ("decontamination", decontaminated), ("pii", redacted), ("packing", packed)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. Each stage but the last is written as a table in the shared folder and read again, so
    that stages that read their input more than once repeat nothing before them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = store.table(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
