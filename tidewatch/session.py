"""Session helpers: local builder for tests/bench, checkpoint-dir discovery, lineage cuts."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every session we build gets. On a cluster the caller's session wins:
# `get_session` only fills keys that are unset.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tidewatch", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session. Only for tests, bench and local runs."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    return spark.conf.get("spark.checkpoint.dir", None) or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the session's checkpoint dir. Where none is configured, a local
    session gets a fresh scratch folder; a cluster's must be set, as executors
    do not share a machine's folders."""
    d = checkpoint_dir(spark)
    if not d:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="tidewatch-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as a Parquet table under the shared checkpoint folder and
    read it back: later stages start from these files (lineage cut, survives
    executor loss), read them columnar and vectorised, and AQE sees their
    real size. Reading a checkpointed RDD instead would go through the
    row serializer."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/tidewatch/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    _WRITTEN.append(path)
    out = spark.read.parquet(path)
    out._stage_path = path
    return out


def cut_lineage_sized(df: DataFrame, name: str = "stage") -> tuple[DataFrame, int]:
    """:func:`cut_lineage` and the number of rows written (from the files'
    footers; an ``Observation`` would leave the session unable to score with a
    freshly fitted forest, whose training summary holds the session)."""
    out = cut_lineage(df, name)
    return out, out.count()


_WRITTEN: list[str] = []


def drop_stage(df: DataFrame) -> None:
    """Delete the files of a table that :func:`cut_lineage` returned (this very
    frame, not one derived from it). Call it when every table made from it has
    been written, so that no later or repeated task reads it."""
    path = df._stage_path
    if path in _WRITTEN:
        _WRITTEN.remove(path)
        drop_path(df.sparkSession, path)


def drop_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder of the shared file system; whether there was one."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True))


def drop_stages(spark: SparkSession) -> int:
    """Delete the intermediate tables written so far by :func:`cut_lineage`.
    Call it when no result that reads them is needed any more (after the sink
    has been written); returns how many were deleted."""
    n = 0
    while _WRITTEN:
        n += drop_path(spark, _WRITTEN.pop())
    return n
