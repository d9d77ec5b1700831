"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

HASH_BITS = 52  # md5 digits kept by hash52: exact in a double, positive in a long


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` once as Parquet below the shared checkpoint
    folder and read it back.  A lost executor then costs only its own tasks."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hash52(*parts: Column) -> Column:
    """Uniform 52-bit integer of the parts' text form (null: the text ``null``).
    md5 is used because any SQL engine has it."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def unit_interval(h: Column) -> Column:
    """A 52-bit hash as a double inside (0, 1)."""
    return (h.cast("double") + F.lit(0.5)) / F.lit(float(1 << HASH_BITS))


def check_columns(df: DataFrame, **types: str) -> None:
    """Raise a clear error when a needed column is missing."""
    missing = [c for c in types if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")


def hidden(docs: DataFrame, **added: Column) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its columns under private names, so that no name of the
    operator clashes with one of the input, plus the columns ``added`` (computed
    from the input's own names).  Returns the frame and {column: private name}."""
    own = {c: f"_in{i}" for i, c in enumerate(docs.columns)}
    df = docs.select(*[F.col(f"`{c}`").alias(a) for c, a in own.items()], *[v.alias(k) for k, v in added.items()])
    return df, own


def shown(own: dict[str, str]) -> list[Column]:
    """The columns of ``hidden`` under their own names again."""
    return [F.col(a).alias(c) for c, a in own.items()]
