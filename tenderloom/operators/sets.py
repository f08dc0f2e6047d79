"""Sorts, limits, unions and the latest-row upsert.

Global sorts end with a unique column: range partitioning can then split equal leading values, so a
value shared by a third of the rows does not end in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.priority import has


def sort_leads(df: DataFrame, columns, tiebreak: str) -> DataFrame:
    return df.orderBy(*columns, tiebreak)


def sort_amount_desc(df: DataFrame, column: str, tiebreak: str) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(column), tiebreak)


def pending_topk(jobs: DataFrame, n: int = 10, tiebreak: str = "id") -> DataFrame:
    return jobs.filter(F.col("status") == "pending").orderBy("created_at", tiebreak).limit(n)


def union_sources(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def union_superset(tables: dict[str, DataFrame], label: str = "source_base") -> DataFrame:
    """Tables with differing columns, labelled by their key; missing columns become null."""
    labelled = [df.withColumn(label, F.lit(name)) for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), labelled)


def union_excluded(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.unionByName(new)


def union_ids(tables: list[DataFrame], id_col: str) -> DataFrame:
    """Distinct ids over all tables, blanks left out."""
    return reduce(DataFrame.union, [t.select(id_col) for t in tables]).filter(has(id_col)).distinct()


def upsert_latest(current: DataFrame | None, incoming: DataFrame, keys, order, ingest_time: str = "ingested_at") -> DataFrame:
    """Per key the last row by ``order``; ``created_at`` is the first ingest time, ``updated_at`` the
    last one if there were several.

    ``current`` and ``incoming`` share columns: keys, order, payload and ``ingest_time``. A plain
    aggregate: rows of a hot key meet as partial results, never as one sorted group.
    """
    rows = incoming if current is None else current.unionByName(incoming, allowMissingColumns=True)
    payload = [c for c in rows.columns if c not in (*keys, ingest_time)]
    latest = rows.groupBy(*keys).agg(
        F.max_by(F.struct(*payload), F.struct(*order)).alias("_last"),
        F.min(ingest_time).alias("created_at"), F.max(ingest_time).alias("_seen"),
        F.count("*").alias("_n"))
    return latest.select(
        *keys, "_last.*", "created_at", F.when(F.col("_n") > 1, F.col("_seen")).alias("updated_at"))


def sheets(tables: dict[str, DataFrame], label: str = "sheet") -> DataFrame:
    """Several result tables as one, labelled by sheet name."""
    return union_superset(tables, label)
