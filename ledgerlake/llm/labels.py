"""Documents joined with their labels, split into folds by a checksum of the id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import HASH_BITS, check_columns, hash52


def id_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's text form modulo ``folds`` (null id: null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def label_table(labels: DataFrame, column: str) -> DataFrame:
    """(doc_id, label) with one row per id: the larger label where an id has
    several.  Null ids and labels other than 0 and 1 are left out."""
    check_columns(labels, doc_id="any", **{column: "int"})
    return (labels.select("doc_id", F.col(column).cast("int").alias("label"))
            .filter("doc_id is not null and label in (0, 1)")
            .groupBy("doc_id").agg(F.max("label").alias("label")))


def label_sample(labels: DataFrame, max_rows: int) -> DataFrame:
    """About ``max_rows`` rows of ``label_table`` (all, if fewer), chosen by a hash
    of the id, so the choice does not depend on partitioning."""
    n = labels.count()
    if n <= max_rows:
        return labels
    return labels.filter(hash52(F.lit("sample"), F.col("doc_id")) < int((1 << HASH_BITS) * (max_rows / n)))
