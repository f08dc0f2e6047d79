"""Small helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Words of a text as a long; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def valid_vectors(df: DataFrame, vector: str, zero_too: bool) -> DataFrame:
    """Rows whose vector has only finite components (``zero_too``: all zeros pass as well)."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    keep = F.col(vector).isNotNull() & ~bad & (F.size(vector) > 0)
    if not zero_too:
        keep = keep & F.exists(vector, lambda x: x != 0)
    return df.filter(keep)


def text_digest(text: str) -> Column:
    """A digest that tells texts apart; null counts as an empty text."""
    return F.sha2(F.coalesce(F.col(text), F.lit("")), 256)


def first_of_components(docs: DataFrame, parts: DataFrame) -> DataFrame:
    """The first row of every component by id, text digest and then the other columns.

    ``parts``: ``doc_id``, ``digest``, ``root`` of every row of ``docs``. A row of an id that also has another text
    is kept or dropped with its own component.
    """
    first = parts.groupBy("root").agg(F.min(F.struct("doc_id", "digest")).alias("first")).select("first.*").distinct()
    others = [F.col(c) for c in docs.columns if c not in ("doc_id", "text")]
    copies = Window.partitionBy("doc_id", "_digest").orderBy(*others, "text")
    kept = docs.withColumn("_digest", text_digest("text")).join(
        first.select(F.col("doc_id").alias("_id"), F.col("digest").alias("_same")), (F.col("doc_id") == F.col("_id")) & (F.col("_digest") == F.col("_same")), "left_semi")
    return kept.withColumn("_nth", F.row_number().over(copies)).filter(F.col("_nth") == 1).select(*docs.columns)
