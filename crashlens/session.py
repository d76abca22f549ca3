"""Session construction and lineage-cut helpers."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. AQE re-plans joins at runtime (broadcast only
# when the measured side is under the threshold, split skewed partitions,
# coalesce small ones); UTC pins timestamp parsing and hour extraction.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "crashlens", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the project defaults.

    On a cluster leave ``master`` as None so spark-submit decides; size
    ``shuffle_partitions`` to the data (about 128-256 MB per partition).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("CRASHLENS_DRIVER_MEMORY", "8g"))
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` wins. When it is unset the
    job fails on a cluster (executors could not see a folder of the driver's);
    only a local master, where driver and executors are one process, gets a
    private temporary folder, which is deleted when the session's JVM ends.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a folder that the driver and all "
                f"executors share (master is {sc.master})")
        configured = tempfile.mkdtemp(prefix="crashlens-ckpt-")
        _delete_on_exit(spark, configured)
    sc.setCheckpointDir(configured)
    return sc._jsc.sc().getCheckpointDir().get()


def _hadoop(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def _delete_on_exit(spark: SparkSession, path: str) -> None:
    fs, hpath = _hadoop(spark, path)
    fs.deleteOnExit(hpath)


_STAGED: list[str] = []
_SCOPES = threading.local()


@contextmanager
def staged_scope(spark: SparkSession):
    """Deletes the folders that this thread stages within the block when it ends:
    results that read them must be written before that. Scopes may be nested."""
    outer, mine = getattr(_SCOPES, "paths", None), []
    _SCOPES.paths = mine
    try:
        yield
    finally:
        _SCOPES.paths = outer
        for path in mine:
            if path in _STAGED:  # not released in between
                _STAGED.remove(path)
                fs, hpath = _hadoop(spark, path)
                fs.delete(hpath, True)
                fs.cancelDeleteOnExit(hpath)


def _staged(spark: SparkSession, path: str) -> None:
    _delete_on_exit(spark, path)
    _STAGED.append(path)
    paths = getattr(_SCOPES, "paths", None)
    if paths is not None:
        paths.append(path)


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts lineage so a lost executor only recomputes from the written files,
    never from the start of a long job. The folder goes with
    :func:`release_staged`, or when the session's JVM ends.
    """
    spark = df.sparkSession
    path = staged_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def staged_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared checkpoint folder that is deleted like a staged table."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stage-{name}-{uuid.uuid4().hex[:12]}"
    _staged(spark, path)
    return path


def stage_partitions(df: DataFrame) -> DataFrame:
    """As :func:`stage_table`, but partitions and the order of their rows stay."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    staged = df.checkpoint()
    path = staged._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
    if path.isDefined():
        _staged(spark, path.get())
    return staged


def release_staged(spark: SparkSession) -> int:
    """Delete every folder that staging wrote so far; returns how many.

    Call it after the action on a query's result: a DataFrame that still reads
    a staged folder cannot run afterwards.
    """
    done = 0
    while _STAGED:
        fs, hpath = _hadoop(spark, _STAGED.pop())
        done += bool(fs.delete(hpath, True))
    return done
