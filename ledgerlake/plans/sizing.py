"""Size-checked broadcast.

A side is broadcast only after its rows and bytes are known to be under a limit;
otherwise it is returned unchanged and Spark plans a shuffle join (AQE may
still switch to a broadcast at runtime from shuffle statistics)."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BROADCAST_BYTES = 512 << 20
FIXED_BYTES = 16  # of a column that is no text, and of the head of a text


def row_bytes(df: DataFrame) -> F.Column:
    """Estimated bytes of a row: ``FIXED_BYTES`` a column and the bytes of its texts
    (other variable columns by the length of their text form)."""
    size = F.lit(FIXED_BYTES * len(df.columns)).cast("bigint")
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(f.name), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = size + F.coalesce(F.octet_length(F.to_json(f.name)), F.lit(0))
    return size


def broadcast_if_small(df: DataFrame, max_rows: int, keep: list | None = None,
                       max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Persist ``df`` (a small aggregate reused by the join), measure it in one job, and
    hint a broadcast when it has at most ``max_rows`` rows and ``max_bytes`` bytes.
    ``max_rows <= 0`` disables the broadcast (nothing is measured).

    The persisted side belongs to the caller: it is added to ``keep``, whose owner
    unpersists it when the plans that read it are done."""
    if not max_rows or max_rows <= 0:
        return df
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    if keep is not None:
        keep.append(df)
    n, size = df.agg(F.count(F.lit(1)), F.sum(row_bytes(df))).first()
    return F.broadcast(df) if n <= max_rows and (size or 0) <= max_bytes else df
