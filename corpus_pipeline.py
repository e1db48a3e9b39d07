"""The corpus pipeline: five operators applied to `documents`, one after the other.

Each stage takes (spark, docs, folder) and returns the documents that it keeps, as it leaves
them, with the columns of docs; the last one returns packed pieces. `run` writes each stage
and reads it again, so a lost executor repeats part of one stage.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from oddspend.llm import line_templates, ngram_join, packing, quality, surrogates
from oddspend.llm.queries import KEY, TOKENIZER
from oddspend.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that a quality rule rejects go."""
    return quality.keep(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Recurring lines stay in the first document that has them; documents all of whose lines
    stand in earlier ones go."""
    found = line_templates.drop_recurring(docs, keep_first=True)
    empty = (F.col("n_dropped") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return _like(docs, found.filter(~F.coalesce(empty, F.lit(False))))


def near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies stays, that with the smallest id."""
    return ngram_join.drop_near_copies(docs)


def personal_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Personal data gives way to surrogates."""
    return _like(docs, surrogates.replace(docs, KEY))


def packed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents in sequences of at most 2048 tokens."""
    return packing.pack(docs, TOKENIZER)


def _like(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The columns of docs, with n_chars of the text as it is now."""
    return found.select(*[F.length("text").cast("bigint").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_copies", near_copies),
    ("personal_data", personal_data),
    ("packed", packed),
]

#: None: SQL has no tokenizer for the last stage and no keyed surrogates.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, folder), name)
    return docs
