"""Views and tables by name.

``register_models`` publishes every model under the name the source uses, so
SQL written against those names runs unchanged with ``spark.sql``.
``register_view`` adds a user-defined KPI view after the naming and shape
checks the source's request workflow imposes.
"""

from __future__ import annotations

import re

from pyspark.errors import ParseException
from pyspark.sql import DataFrame, SparkSession

from ..functions.tags import METRICS

_NAME = re.compile(r"^[a-z][a-z0-9]*(_[a-z0-9]+)*$")
_RELATION = re.compile(r"UnresolvedRelation \[([^\]]*)\]")
_WITH = re.compile(r"\bCTE \[([^\]]*)\]")
_WRITES = re.compile(r"InsertIntoStatement|InsertIntoDir|MergeInto|DeleteFromTable|UpdateTable")


class ViewRuleError(ValueError):
    pass


def relations(spark: SparkSession, sql: str) -> list[list[str]]:
    """Name parts of every relation that one query reads, by Spark's own parser.
    Names that the query defines itself (WITH) are among them."""
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    except ParseException as e:
        raise ViewRuleError(f"the text is not one statement: {e.getMessage() or e}") from None
    kind = spark._jvm.java.lang.Class.forName(
        "org.apache.spark.sql.catalyst.plans.logical.Command", True,
        spark._jvm.java.lang.Thread.currentThread().getContextClassLoader())
    tree = plan.toString()
    if kind.isInstance(plan) or plan.getClass().getSimpleName().startswith("Create") or _WRITES.search(tree):
        raise ViewRuleError("the statement must be a query")
    return [[part.strip() for part in m.split(",")] for m in _RELATION.findall(tree)]


def with_names(spark: SparkSession, sql: str) -> set[str]:
    """Names that the query defines itself, by WITH."""
    tree = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql).toString()
    return {name.strip().lower() for m in _WITH.findall(tree) for name in m.split(",")}


def check_view(spark: SparkSession, name: str, sql: str) -> None:
    """snake_case name under 50 characters; one query; no trailing semicolon; no
    database prefix on relations."""
    if not _NAME.match(name) or len(name) >= 50:
        raise ViewRuleError(f"view name must be snake_case and under 50 characters: {name!r}")
    if sql.strip().endswith(";"):
        raise ViewRuleError("no trailing semicolon")
    for parts in relations(spark, sql):
        if len(parts) > 1:
            raise ViewRuleError(f"relations must not carry a database prefix: {'.'.join(parts)}")


def register_view(spark: SparkSession, name: str, sql: str) -> DataFrame:
    check_view(spark, name, sql)
    df = spark.sql(sql)
    df.createOrReplaceTempView(name)
    return df


def save_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def save_table(spark: SparkSession, df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Materialise as Parquet (shared checkpoint folder unless ``path``) and register."""
    from ..session import scratch_table_path
    path = path or scratch_table_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.parquet(path)
    out.createOrReplaceTempView(name)
    return out


# The names under which the source publishes its models, kept so
# that SQL written against them runs unchanged.
SOURCE_VIEW_NAMES = {
    "assets": ("assets_usd", "assets_xyz", "t_a"),
    "cash": ("cash_usd", "cash_xyz", "t_c"),
    "debt": ("debt_usd", "debt_xyz", "t_d"),
    "float": ("float_usd", "float_xyz", "t_f"),
    "revenue": ("fy_revenue_usd", "fy_revenue_xyz", "t_r"),
    "income": ("fy_income_usd", "fy_income_fx", "t_i"),
}


def published_names() -> set[str]:
    """Names of all published models."""
    return set(_model_builders(None))


def _model_builders(models) -> dict:
    """Published name -> function that builds the model."""
    out = {
        "stg_dera_sub": lambda: models.stg_sub, "stg_dera_num": lambda: models.stg_num,
        "stg_dera_tag": lambda: models.stg_tag, "stg_esg_risk_factors": lambda: models.stg_esg,
        "closing_fx": lambda: models.closing_fx, "average_fx": lambda: models.average_fx,
    }
    for metric in METRICS:
        usd, xyz, t = SOURCE_VIEW_NAMES[metric]
        out[usd] = lambda m=metric: models.metric_view(m, "usd")
        out[xyz] = lambda m=metric: models.metric_view(m, "xyz")
        out[t] = lambda m=metric: models.t(m)
    out.update({
        "int_float_candidates": lambda: models.float_candidates, "int_float_inferred": lambda: models.float_inferred,
        "float": lambda: models.float_latest, "financials": lambda: models.financials(),
        "asset_weighted_phys_climate_exposure_view": lambda: models.exposure(),
        "physical_climate_change_exposure_view": lambda: models.exposure(),
    })
    return out


def register_models(models, names=None) -> list[str]:
    """Temp views for the models, under the source's names; ``names``: only these.
    (Building ``financials`` runs the jobs of its ``t_*`` tables.)"""
    builders = _model_builders(models)
    chosen = [n for n in builders if names is None or n in names]
    for name in chosen:
        builders[name]().createOrReplaceTempView(name)
    return chosen


# Schema of each published model, as the source lays them out
# (<base>, <base>_stg, <base>_int, <base>_marts)
SCHEMA_SUFFIX = {
    "stg_dera_sub": "_stg", "stg_dera_num": "_stg", "stg_dera_tag": "_stg", "stg_esg_risk_factors": "_stg",
    "int_float_candidates": "_int", "int_float_inferred": "_int",
    "float": "_marts", "financials": "_marts",
}


def save_models_as_tables(models, base: str = "analytics", path_root: str | None = None) -> list[str]:
    """Write every model as a Parquet table in the catalog, in the schema the
    source uses for it, so that schema-qualified SQL (``analytics_marts.financials``)
    resolves.  Tables are external under ``path_root`` (default: the shared
    checkpoint folder)."""
    from ..session import scratch_table_path
    spark = models.spark
    names = register_models(models)
    out = []
    for name in names:
        db = base + SCHEMA_SUFFIX.get(name, "")
        spark.sql(f"create database if not exists `{db}`")
        path = f"{path_root.rstrip('/')}/{db}/{name}" if path_root else scratch_table_path(spark, f"{db}/{name}")
        (spark.table(name).write.mode("overwrite").format("parquet").option("path", path)
            .saveAsTable(f"`{db}`.`{name}`"))
        out.append(f"{db}.{name}")
    return out
