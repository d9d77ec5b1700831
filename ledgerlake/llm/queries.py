"""Registered queries of the training-data operators: id -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (alignment, decontam, html_text, licenses, mixing, neighbours, packing, quality, sharding, similarity,
               spelling, suffix_dedup, toxicity)
from .common import read_table


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(read_table(spark, sf_dir, "pages"))


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_neighbours(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.similarity_join(read_table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeats_query(read_table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents"), licenses.known_licenses(spark))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination_query(read_table(spark, sf_dir, "documents"),
                                        read_table(spark, sf_dir, "benchmark"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_query(read_table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_tokenizers(read_table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(read_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_html_extraction, op2_nearest_neighbours, op3_jaccard_join, op4_suffix_dedup, op5_toxicity,
                                   op6_license_scan, op7_sharding, op8_decontamination, op9_mixing, op10_quality,
                                   op11_best_fit_packing, op12_tokenizer_alignment, op13_spelling_variants)}


def oracle_sql() -> dict[str, str]:
    return {"op6_license_scan": licenses.scan_sql(),
            "op7_sharding": sharding.shard_documents_sql(),
            "op8_decontamination": decontam.contamination_sql(),
            "op9_mixing": mixing.mix_sql(),
            "op13_spelling_variants": spelling.spelling_sql()}
