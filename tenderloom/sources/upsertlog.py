"""A log-structured store of upserts: batches, merged parts and manifests.

* ``root/run=<query>/batch_id=<n>`` holds one batch. Writing it again replaces exactly that batch, so a replay changes nothing.
* ``root/parts/<name>`` holds a merge of batches and older parts: one row per key with its last values, their place in the
  order, and the first and last ingest time and number of its rows. Those combine in any order and grouping, so any
  batches and parts can be merged at any time.
* ``root/manifests/<number>.json`` names the parts that hold the state and the batches they have taken in.

A merge writes a part, then a manifest; only the manifest makes it count. Readers take the last whole manifest, its parts
and the batches it has not taken in. So a crash between the steps leaves a part nobody names, or batches that are named as
taken in and still there; neither changes what is read, and :func:`vacuum` removes both. Older manifests keep their
files until then, for readers that began with them.

Parts have levels: ``fan`` parts of one level become one of the next, so a row is rewritten once a level and a store of
n batches is read as at most ``fan`` parts of each of log(n) levels and the batches since the last merge.
One process merges at a time; a second one fails when it names its manifest.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

_BOOKKEEPING = ("_run", "_batch", "_created", "_seen", "_n")


def _path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, target = _path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def _complete(spark: SparkSession, path: str) -> bool:
    fs, target = _path(spark, f"{path}/_SUCCESS")
    return fs.exists(target)


def _delete(spark: SparkSession, path: str) -> None:
    fs, target = _path(spark, path)
    fs.delete(target, True)


# ------------------------------------------------------------------------------- manifests
def _manifest_numbers(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(m[1]) for n in _names(spark, f"{root}/manifests") if (m := re.fullmatch(r"([0-9]+)\.json", n)))


def _read_manifest(spark: SparkSession, root: str, number: int) -> dict | None:
    """The manifest, or None for one that was not written to its end."""
    fs, target = _path(spark, f"{root}/manifests/{number:012d}.json")
    stream = fs.open(target)
    try:
        raw = bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()
    try:
        return json.loads(raw)
    except ValueError:
        return None


def _last_manifest(spark: SparkSession, root: str) -> dict:
    for number in reversed(_manifest_numbers(spark, root)):
        found = _read_manifest(spark, root, number)
        if found is not None:
            return found
    return {"parts": [], "taken": {}, "begun": {}}


def _write_manifest(spark: SparkSession, root: str, manifest: dict) -> None:
    number = max(_manifest_numbers(spark, root), default=-1) + 1
    fs, target = _path(spark, f"{root}/manifests/{number:012d}.json")
    out = fs.create(target, False)  # fails if somebody else has named this one
    try:
        out.write(bytearray(json.dumps(manifest).encode()))
    finally:
        out.close()


def _holds(ranges: list[list[int]], batch: int) -> bool:
    return any(a <= batch <= b for a, b in ranges)


def _with_batches(ranges: list[list[int]], batches: list[int]) -> list[list[int]]:
    """Ranges of batch numbers with further numbers; neighbours are joined, so numbers without gaps are one range."""
    out: list[list[int]] = []
    for a, b in sorted([*ranges, *([n, n] for n in batches)]):
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


# ------------------------------------------------------------------------------- batches
def write_upsert_batch(df: DataFrame, root: str, batch_id: int, run: str = "0") -> None:
    """Stores one batch; one that a part has taken in already is a replay and is left alone."""
    if not _holds(_last_manifest(df.sparkSession, root)["taken"].get(run, []), batch_id):
        df.write.mode("overwrite").parquet(f"{root}/run={run}/batch_id={batch_id}")


def _stored_batches(spark: SparkSession, root: str) -> list[tuple[str, int]]:
    return [
        (run[4:], int(batch[9:])) for run in _names(spark, root) if run.startswith("run=")
        for batch in _names(spark, f"{root}/{run}") if batch.startswith("batch_id=")]


def _open_batches(spark: SparkSession, root: str, taken: dict) -> list[tuple[str, int]]:
    return [(r, b) for r, b in _stored_batches(spark, root)
            if not _holds(taken.get(r, []), b) and _complete(spark, f"{root}/run={r}/batch_id={b}")]


def pending_batches(spark: SparkSession, root: str) -> int:
    """Batches that no part has taken in yet."""
    return len(_open_batches(spark, root, _last_manifest(spark, root)["taken"]))


def _batch_rows(spark: SparkSession, root: str, batches: list[tuple[str, int]], ingest_time: str) -> DataFrame:
    rows = spark.read.parquet(*[f"{root}/run={r}/batch_id={b}" for r, b in batches])
    place = "/run=([^/]+)/batch_id=([0-9]+)/"
    source = F.col("_metadata.file_path")
    return rows.withColumns({
        "_run": F.regexp_extract(source, place, 1), "_batch": F.regexp_extract(source, place, 2).cast("long"),
        "_created": F.col(ingest_time), "_seen": F.col(ingest_time), "_n": F.lit(1).cast("long")}).drop(ingest_time)


# ------------------------------------------------------------------------------- merging
def _merged(rows: DataFrame, keys, order, begun: dict) -> DataFrame:
    """One row per key with its last values; ``rows`` are batch rows, parts or both.

    Queries follow each other by their first ingest time; inside one the batch number, then ``order``, decides. A plain
    aggregate: rows of a hot key meet as partial results, never as one sorted group.
    """
    payload = [c for c in rows.columns if c not in (*keys, "_created", "_seen", "_n")]
    since = F.create_map(*[F.lit(x) for pair in begun.items() for x in pair])  # one entry per query, not per batch
    return rows.groupBy(*keys).agg(
        F.max_by(F.struct(*payload), F.struct(F.try_element_at(since, F.col("_run")), "_run", "_batch", *order)).alias("_last"),
        F.min("_created").alias("_created"), F.max("_seen").alias("_seen"), F.sum("_n").alias("_n"),
    ).select(*keys, "_last.*", "_created", "_seen", "_n")


def _state(spark: SparkSession, root: str, parts: list[dict], batches: list[tuple[str, int]], begun: dict, ingest_time: str) -> tuple[DataFrame, dict]:
    """All rows of some parts and batches, and the first ingest time of every query known by now.

    A query keeps the time it had when its first batch was merged.
    """
    tables = [spark.read.parquet(*[f"{root}/parts/{p['name']}" for p in parts])] if parts else []
    if batches:
        fresh = _batch_rows(spark, root, batches, ingest_time)
        if any(r not in begun for r, _ in batches):
            first = fresh.groupBy("_run").agg(F.min("_created").cast("string").alias("t")).collect()  # one row per query
            begun = {**{r["_run"]: r["t"] or "" for r in first}, **begun}
        tables.append(fresh)
    rows = tables[0] if len(tables) == 1 else tables[0].unionByName(tables[1], allowMissingColumns=True)
    return rows, begun


def compact(spark: SparkSession, root: str, keys, order, ingest_time: str = "ingested_at", fan: int = 8) -> int:
    """Merges all batches not taken in yet, with parts of the levels that become full; returns how many it took in."""
    now = _last_manifest(spark, root)
    batches = _open_batches(spark, root, now["taken"])
    if not batches:
        return 0
    level, merging, parts = 1, [], list(now["parts"])
    while len(same := [p for p in parts if p["level"] == level]) + 1 >= fan:
        merging += same
        parts = [p for p in parts if p["level"] != level]
        level += 1
    rows, begun = _state(spark, root, merging, batches, now["begun"], ingest_time)
    name = uuid.uuid4().hex
    _merged(rows, keys, order, begun).write.parquet(f"{root}/parts/{name}")
    taken = dict(now["taken"])
    for run in {r for r, _ in batches}:
        taken[run] = _with_batches(taken.get(run, []), [b for r, b in batches if r == run])
    _write_manifest(spark, root, {"parts": [*parts, {"name": name, "level": level}], "taken": taken, "begun": begun})
    return len(batches)


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Removes what none of the last ``keep`` manifests needs: batches all of them have taken in, other parts, older manifests."""
    numbers = _manifest_numbers(spark, root)
    whole = [(n, m) for n in numbers if (m := _read_manifest(spark, root, n)) is not None][-keep:]
    if not whole:
        return
    needed = {p["name"] for _, m in whole for p in m["parts"]}
    for number in numbers:
        if number < whole[0][0]:
            _delete(spark, f"{root}/manifests/{number:012d}.json")
    for part in _names(spark, f"{root}/parts"):
        if part not in needed:
            _delete(spark, f"{root}/parts/{part}")
    for run, batch in _stored_batches(spark, root):
        if all(_holds(m["taken"].get(run, []), batch) for _, m in whole):
            _delete(spark, f"{root}/run={run}/batch_id={batch}")


# ------------------------------------------------------------------------------- reading
def read_upserted(spark: SparkSession, root: str, keys, order, ingest_time: str = "ingested_at") -> DataFrame:
    """Current state of the log: per key the last row over all queries, with ``created_at`` and ``updated_at``."""
    now = _last_manifest(spark, root)
    rows, begun = _state(spark, root, now["parts"], _open_batches(spark, root, now["taken"]), now["begun"], ingest_time)
    state = _merged(rows, keys, order, begun)
    plain = [c for c in state.columns if c not in _BOOKKEEPING]
    return state.select(*plain, F.col("_created").alias("created_at"), F.when(F.col("_n") > 1, F.col("_seen")).alias("updated_at"))


def publish_upserted(spark: SparkSession, root: str, target: str, keys, order) -> None:
    """Writes the current state to a new folder, split by activity code when there is one."""
    state = read_upserted(spark, root, keys, order)
    writer = state.write.mode("errorifexists")
    if "activity_code" in state.columns:
        writer = writer.partitionBy("activity_code")
    writer.parquet(target)
