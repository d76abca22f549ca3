"""Versioned tables: readers see one whole version, a refresh never breaks them.

``path/data/<unique>/<name>`` holds the Parquet tables of one version and
``path/commits/<number>`` names its folder. A version exists once its commit file
does, and that file appears by one rename that fails if the number is taken: of
two writers that start from the same version only one commits.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


class CommitConflict(RuntimeError):
    """Another writer has committed the next version already."""


def _hadoop(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def _folders(spark: SparkSession, path: str) -> dict[int, str]:
    """Data folder of every committed version."""
    fs, commits = _hadoop(spark, f"{path}/commits")
    if not fs.exists(commits):
        return {}
    names = [s.getPath().getName() for s in fs.listStatus(commits)]
    return {int(n): f"{path}/commits/{n}" for n in names if n.isdigit()}


def versions(spark: SparkSession, path: str) -> list[int]:
    """Committed versions, ascending; none if there is no such table."""
    return sorted(_folders(spark, path))


def _folder(spark: SparkSession, path: str, version: int | None) -> str:
    commits = _folders(spark, path)
    version = max(commits, default=None) if version is None else version
    if version not in commits:
        raise FileNotFoundError(f"no version {version} of {path}")
    name = spark.read.text(commits[version]).first()["value"]
    return f"{path}/data/{name}"


def read(spark: SparkSession, path: str, names: list[str], version: int | None = None) -> list[DataFrame]:
    """Tables ``names`` of one version, the newest unless told otherwise."""
    folder = _folder(spark, path, version)
    return [spark.read.parquet(f"{folder}/{n}") for n in names]


def commit(spark: SparkSession, path: str, tables: dict[str, DataFrame], after: int | None = None,
           partition_by: list[str] | None = None) -> int:
    """Write ``tables`` as the next version and return its number.

    ``after``: the version that they were derived from (0: none; default: the
    newest now). If another writer commits that number first, the written data
    are deleted and :class:`CommitConflict` is raised.
    """
    after = max(versions(spark, path), default=0) if after is None else after
    name = uuid.uuid4().hex
    for table, df in tables.items():
        w = df.write.mode("overwrite")
        (w.partitionBy(*partition_by) if partition_by else w).parquet(f"{path}/data/{name}/{table}")
    fs, pending = _hadoop(spark, f"{path}/pending/{name}")
    out = fs.create(pending, False)
    out.write(name.encode())
    out.close()
    fs.mkdirs(_hadoop(spark, f"{path}/commits")[1])
    jvm = spark.sparkContext._jvm
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    target = _hadoop(spark, f"{path}/commits/{after + 1:012}")[1]
    try:  # without the option to overwrite
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(pending.toUri(), spark.sparkContext._jsc.hadoopConfiguration()) \
            .rename(pending, target, spark.sparkContext._gateway.new_array(rename, 0))
    except Py4JJavaError as e:
        if not fs.exists(target):
            raise
        fs.delete(pending, False)
        fs.delete(_hadoop(spark, f"{path}/data/{name}")[1], True)
        raise CommitConflict(f"version {after + 1} of {path} exists already") from e
    return after + 1


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete all but the newest ``keep`` versions; returns how many went. Keep
    as many as a reader may lag behind."""
    old = versions(spark, path)[:-keep] if keep > 0 else []
    for v in old:
        fs, folder = _hadoop(spark, _folder(spark, path, v))
        fs.delete(_hadoop(spark, _folders(spark, path)[v])[1], False)
        fs.delete(folder, True)
    return len(old)
