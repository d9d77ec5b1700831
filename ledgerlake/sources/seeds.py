"""Seed reference tables from CSV (A10) with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .adapter import ESG_SIGNALS

S = T.StringType()
ESG_SCHEMA = T.StructType(
    [T.StructField(c, S) for c in ("isin", "gvkey", "cusip", "hqcountrycode")]
    + [T.StructField("year", T.IntegerType(), nullable=False)]
    + [T.StructField(c, T.DoubleType()) for c in ESG_SIGNALS])
ISIN_CIK_SCHEMA = T.StructType([T.StructField("isin", S), T.StructField("cik", S)])
SIC_ISIC_SCHEMA = T.StructType([T.StructField("sic", S), T.StructField("isic", S)])
TICKER_SCHEMA = T.StructType([T.StructField("tnname", S), T.StructField("cik", S)])

SEED_SCHEMAS = {"esg_risk_factors": ESG_SCHEMA, "isin_cik": ISIN_CIK_SCHEMA,
                "sic_isic": SIC_ISIC_SCHEMA, "ticker": TICKER_SCHEMA}


def read_seed(spark: SparkSession, path: str, name: str) -> DataFrame:
    """CSV with a header line; ids stay strings (leading zeros kept) and are
    cast where they are joined."""
    return spark.read.schema(SEED_SCHEMAS[name]).option("header", True).csv(path)
