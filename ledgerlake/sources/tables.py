"""Named tables written to shared storage (materialization barriers)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_table_path


def land_table(spark: SparkSession, df: DataFrame, name: str, bucket_col: str | None = None,
               buckets: int | None = None, partition_by: str | None = None,
               files: int | None = None) -> DataFrame:
    """Write ``df`` as an external Parquet table under the shared checkpoint
    folder and return it.  With ``bucket_col`` the table is bucketed and
    sorted on that column, so joins and aggregates keyed by it read co-located
    buckets instead of shuffling.  ``files`` spreads an unbucketed table over
    that many evenly sized files."""
    path = scratch_table_path(spark, name)
    if bucket_col:
        # one writer task per bucket: N files per table, not tasks x N
        df = df.repartition(buckets, bucket_col)
    elif files:
        # evenly sized files, so that a scan has at least ``files`` splits
        df = df.repartition(files)
    w = df.write.format("parquet").mode("overwrite").option("path", path)
    if partition_by:
        w = w.partitionBy(partition_by)
    if bucket_col:
        w = w.bucketBy(buckets, bucket_col).sortBy(bucket_col)
    w.saveAsTable(name)
    return spark.table(name)
