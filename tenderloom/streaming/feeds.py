"""Incremental jobs on Structured Streaming file sources."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import rules as R
from ..functions.priority import has
from ..operators.filters import target_ok
from ..sources import schemas as S
from ..sources import upsertlog


def fresh_matches(feed: DataFrame, keywords=R.FEED_KEYWORDS, prefixes=R.FEED_CODE_PREFIXES,
                  event_time: str | None = None, lateness: str | None = None) -> DataFrame:
    """The documents of ``feed`` that are new by id and match the selection.

    Of a document that does not match only the id travels: it still makes later ones of that id old.
    """
    if event_time and lateness:
        feed = feed.withColumn(event_time, F.col(event_time).cast("timestamp"))
    timed = [event_time] if event_time and lateness else []
    keyed = feed.filter(has("id")).select(
        "id", *timed, F.when(target_ok(keywords, prefixes), F.struct(*feed.columns)).alias("_doc"))
    if timed:
        fresh = keyed.withWatermark(event_time, lateness).dropDuplicatesWithinWatermark(["id"])
    else:
        fresh = keyed.dropDuplicates(["id"])
    return fresh.filter("_doc is not null").select("_doc.*")


def stream_new_matches(
    spark: SparkSession, src: str, dst: str, checkpoint: str, keywords=R.FEED_KEYWORDS,
    prefixes=R.FEED_CODE_PREFIXES, schema: str = S.TENDER, max_files: int = 100,
    event_time: str | None = None, lateness: str | None = None, compression: str = "gzip",
) -> StreamingQuery:
    """Appends the tenders of a growing feed that are new by id and match the selection.

    The checkpoint is the resumable cursor. Ids are remembered for ever, as the feed needs; with
    ``event_time`` and ``lateness`` only as long as the watermark allows, which bounds the state.
    """
    feed = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).json(src)
    return (
        fresh_matches(feed, keywords, prefixes, event_time, lateness).writeStream.format("json").option("path", dst)
        .option("compression", compression).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def stream_upsert(stream: DataFrame, root: str, checkpoint: str, keys=None, order=None, merge_after: int = 32,
                  ingest_time: str = "ingested_at") -> StreamingQuery:
    """Stores each micro-batch once; ``read_upserted`` gives the merged state.

    A batch is stored under the id of the streaming query, which lives in its checkpoint, and its number. With ``keys`` and
    ``order`` every ``merge_after`` batches are merged, so what a reader opens stays bounded; a batch that is replayed after
    its merge changes nothing.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        upsertlog.write_upsert_batch(batch, root, batch_id, run or hashlib.sha256(checkpoint.encode()).hexdigest())
        if keys and upsertlog.pending_batches(spark, root) >= merge_after:
            upsertlog.compact(spark, root, keys, order, ingest_time)
            upsertlog.vacuum(spark, root)

    return (
        stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
