"""Materialised tables: read-through cache (A2) and the enriched crash table (A3)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from crashlens.sources import snapshots


def path_exists(spark: SparkSession, path: str) -> bool:
    """Path test through the Hadoop file system of the session (works for
    local, HDFS and object-store paths alike)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def cached_table(spark: SparkSession, path: str, build: Callable[[], DataFrame],
                 force_refresh: bool = False, partition_by: list[str] | None = None) -> DataFrame:
    """Return the cached table at ``path``; build and commit it first when it
    is missing or ``force_refresh`` is set (A2). The written files are the
    hand-off between jobs, so later stages never recompute ``build``. A refresh
    commits a further version (see ``snapshots``): readers of the last one go on."""
    if force_refresh or not snapshots.versions(spark, path):
        snapshots.commit(spark, path, {"table": build()}, partition_by=partition_by)
        snapshots.vacuum(spark, path)
    return snapshots.read(spark, path, ["table"])[0]


def write_enriched(enriched: DataFrame, path: str) -> None:
    """Crash rows with their neighbourhood features, partitioned by year so
    year filters prune whole folders (A3)."""
    enriched.write.mode("overwrite").partitionBy("year").parquet(path)
