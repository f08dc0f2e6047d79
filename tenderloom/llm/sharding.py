"""Contiguous shards of equal bytes from global prefix sums (law ``bytes``).

Rows are put in range partitions by id. One running sum inside each partition, plus the total of all
partitions before it, gives the global prefix sum of every row without ever sorting the whole table in
one task; the only rows that meet in one task are the totals, one per partition. The line of bytes is
cut at equal targets: a row belongs to the shard that holds the middle of its bytes, so every shard is
contiguous in id order and no shard is off its target by more than one row on either side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored


def byte_shards(docs: DataFrame, shards: int, extra_bytes: int = 16, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per document: id, ``size``, ``text_crc32``, ``shard`` and ``slot``.

    ``size`` is the UTF-8 length (null text: 0) plus ``extra_bytes``; null and empty texts have crc 0.
    Null ids come first; equal ids are ordered by crc and size, and rows equal in all three are
    interchangeable. Other columns are ignored whatever their names. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text).cast("long") + extra_bytes).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"))
    order = ["doc_id", "text_crc32", "size"]
    # written once: range bounds are sampled, and both readers below must see the same partitions
    rows = stored(narrow.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "shard-rows")

    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = (  # one row per partition
        rows.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
        .select("part", F.coalesce(F.sum("bytes").over(upto), F.lit(0)).alias("bytes_before"),
                F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("rows_before"),
                F.sum("bytes").over(Window.orderBy("part").rowsBetween(
                    Window.unboundedPreceding, Window.unboundedFollowing)).alias("all_bytes")))
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        rows.withColumn("upto", F.sum("size").over(inside)).withColumn("nth", F.count("*").over(inside))
        .join(F.broadcast(totals), "part")  # as many rows as there are partitions
        .withColumn("row", F.col("rows_before") + F.col("nth") - 1)
        .withColumn("middle2", 2 * (F.col("bytes_before") + F.col("upto")) - F.col("size"))
        .withColumn("shard", F.least(F.lit(shards - 1), F.expr(
            f"cast((cast(middle2 as decimal(38,0)) * {shards}) div (2 * cast(all_bytes as decimal(38,0))) as int)"))))
    first = placed.groupBy("shard").agg(F.min("row").alias("first_row"))
    return (
        placed.join(F.broadcast(first), "shard")  # as many rows as there are shards
        .select("doc_id", "size", "text_crc32", "shard", (F.col("row") - F.col("first_row")).alias("slot")))
