"""Table sinks. All write in parallel; none gathers its rows into one file.

Published tables are kept as versions: ``root/<name>/v=<version>`` holds one complete write and
``root/<name>/versions`` names it afterwards, in a file of its own that Spark commits as a whole. Readers take
the last version named, so a table may be rewritten from itself and a failed write leaves the old rows.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from .upsertlog import compact, pending_batches, publish_upserted, read_upserted, vacuum, write_upsert_batch  # noqa: F401


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).csv(path, header=True)


def _write_version(df: DataFrame, root: str, name: str) -> str:
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
    df.write.parquet(f"{root}/{name}/v={version}")
    return version


def _publish(spark: SparkSession, root: str, name: str, version: str) -> None:
    spark.range(1, numPartitions=1).select(F.lit(version)).write.mode("append").text(f"{root}/{name}/versions")


def read_sheet(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The last published version of a table."""
    version = spark.read.text(f"{root}/{name}/versions").agg(F.max("value")).first()[0]
    return spark.read.parquet(f"{root}/{name}/v={version}")


def write_sheets(tables: dict[str, DataFrame], root: str, optional: set[str] = frozenset()) -> list[str]:
    """Publishes each table under ``root/<name>``; optional ones only when they have rows.

    Every plan runs once: whether an optional table has rows is seen in what was written.
    """
    written = []
    for name, df in tables.items():
        spark = df.sparkSession
        version = _write_version(df, root, name)
        if name in optional and spark.read.parquet(f"{root}/{name}/v={version}").isEmpty():
            continue
        _publish(spark, root, name, version)
        written.append(name)
    return written


def replace_one_sheet(df: DataFrame, root: str, name: str) -> None:
    """Publishes a new version of one table of a set; ``df`` may read that same table."""
    _publish(df.sparkSession, root, name, _write_version(df, root, name))


def append_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def register_snapshot(spark: SparkSession, path, source_id: str, version: str, url: str,
                      snapshot_id: str | None = None) -> DataFrame:
    """One row describing a set of files: their total size and line count."""
    lines = spark.read.text(path).select("_metadata.file_path", "_metadata.file_size")
    per_file = lines.groupBy("file_path").agg(F.max("file_size").alias("size"), F.count("*").alias("n"))
    return per_file.agg(
        F.coalesce(F.sum("size"), F.lit(0)).alias("size_bytes"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("record_count"),
    ).select(
        F.lit(snapshot_id or f"snap_{source_id}_{uuid.uuid4().hex}").alias("snapshot_id"),
        F.lit(source_id).alias("source_id"), F.lit(version).alias("provider_version"), F.lit(url).alias("url"),
        "size_bytes", "record_count", F.current_timestamp().alias("downloaded_at"))
