"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Settings the jobs rely on: runtime re-planning, skew splitting even where it costs one more
#: exchange, a state store that is not bound by executor heap, generated methods small enough for the
#: JIT (larger ones run as split projections), and no call-site capture for every Column that is built.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, app: str = "tenderloom", **conf) -> SparkSession:
    """A session with :data:`SETTINGS`; ``conf`` entries use ``_`` for ``.`` or full names."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_root: str | None = None


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to the machine's own temporary folder: on a cluster the
    executors would not see it.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        _local_root = root = _local_root or tempfile.mkdtemp(prefix="tenderloom-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a finished write is at ``path``, on whatever file system it names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


@contextmanager
def small_methods(spark: SparkSession):
    """Applies the method limit of :data:`SETTINGS` to a session that was built without it."""
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    spark.conf.set(key, SETTINGS[key])
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stored(df: DataFrame, name: str = "stored") -> DataFrame:
    """Writes ``df`` to the shared scratch folder and reads it back.

    For a result that feeds several outputs: each of them then reads rows instead of repeating the
    work, and a lost executor costs a re-read instead of a recomputed lineage.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
