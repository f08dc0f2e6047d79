"""Order-dependent deduplication.

All variants rest on :func:`first_wins`: a row number filtered to 1. Catalyst turns that filter into
a group limit which runs before the exchange, so each map task sends at most one row per key and a
key that holds a third of the table is never sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.priority import has, priority_score
from ..functions.text import norm_org_name, null_to_empty


def first_wins(df: DataFrame, keys, order) -> DataFrame:
    """The first row per key in the given total order."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def lead_key(email="email", org_id="org_id", name="name", city="city") -> Column:
    """E-mail and name, else id and name, else name and city."""
    clean = norm_org_name(name)
    return (
        F.when(has(email), F.concat(F.col(email), F.lit("_"), clean))
        .when(has(org_id), F.concat(F.col(org_id), F.lit("_"), clean))
        .otherwise(F.concat(clean, F.lit("_"), F.lower(null_to_empty(city))))
    )


def lead_dedup(df: DataFrame, order) -> DataFrame:
    keyed = df.withColumn("_lead_key", lead_key())
    return first_wins(keyed, ["_lead_key"], order).drop("_lead_key")


def dedup_if_key(df: DataFrame, key: str, order) -> DataFrame:
    """First wins per key; rows with a blank key are all kept.

    Blank rows take the (unique) order columns as part of their partition key: they spread over all
    tasks instead of meeting in one.
    """
    blank = ~has(key)
    spread = [F.when(blank, F.col(c)) for c in order]
    return first_wins(df, [null_to_empty(key), *spread], order)


def dedup_by_id_across_queries(df: DataFrame, id_col: str, query_rank: str, pos: str) -> DataFrame:
    """One row per id found by several queries; rows without an id are dropped."""
    return first_wins(df.filter(has(id_col)), [id_col], [query_rank, pos])


def dedup_most_complete(df: DataFrame, key: str, rank_cols, tiebreak) -> DataFrame:
    """Per key the row with the greatest contact values, so a filled one beats a blank one."""
    return first_wins(df, [key], [F.desc(c) for c in rank_cols] + list(tiebreak))


def master_dedup(df: DataFrame, email: str, label: str, order) -> DataFrame:
    """Best-ranked row per address; equal ranks fall back to ``order``."""
    return first_wins(df, [email], [priority_score(label), *order])


def dedup_exact(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).dropDuplicates()
