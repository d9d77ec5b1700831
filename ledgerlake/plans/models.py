"""The model graph as plain function composition.

``FilingModels`` wires the operators together over one set of raw relations
(driver-derived, landed Parquet, or anything with the raw columns).  Every
property is a lazy DataFrame; nothing runs until an action (size checks for
broadcasts and the ``t_*`` files run their own small jobs).  Each consumer
scans ``num`` for its own tags only, by a filter that reaches the scan.  With ``materialize=True`` every shared intermediate (facts, rates,
metric values, converted amounts) is persisted, for a run that builds all
models; ``release()`` frees them.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from ..functions.tags import (FLOAT_PRICE_TAGS, FLOAT_REPORTED_TAGS, FLOAT_SHARE_TAGS, FX_AVERAGE_TAGS,
                              FX_CLOSING_TAGS, METRICS, all_fact_tags)
from ..operators import convert, exposure, floats, fx, kpis, marts, metrics, staging
from ..session import checkpoint_dir
from ..sources.adapter import ESG_SIGNALS, DriverRaw


class FilingModels:
    def __init__(self, spark: SparkSession, raw, materialize: bool = False,
                 max_broadcast_rows: int | None = None, truthy=("true",), uom_mode: str = "pair",
                 strict: bool = False, count_rejects: bool = False):
        """``truthy``: spellings read as true for the boolean flags (the source
        tests ``= 'true'`` only); ``uom_mode``: see ``convert.converted_tables``;
        ``strict``: fail when a non-blank raw value does not parse (the source's
        casts raise) instead of reading it as NULL (scans ``num`` once for it); ``count_rejects``: count
        such values in the job that builds the staging models, see ``reject_counts``; ``max_broadcast_rows``: one
        row limit for every size-checked broadcast (filings, rates, industry
        means, ESG panel); None keeps each site's default, 0 never broadcasts."""
        self.spark = spark
        self.raw = raw
        self.materialize = materialize
        self.max_broadcast_rows = max_broadcast_rows
        self.truthy = truthy
        self.uom_mode = uom_mode
        self.strict = strict
        self.count_rejects = count_rejects
        self._observed: dict = {}
        self._persisted: list = []
        self._written: list = []

    @classmethod
    def from_driver(cls, spark: SparkSession, sf_dir: str, **kw) -> "FilingModels":
        return cls(spark, DriverRaw(spark, sf_dir), **kw)

    def _limit(self, default: int) -> int:
        return default if self.max_broadcast_rows is None else self.max_broadcast_rows

    def _keep(self, df: DataFrame) -> DataFrame:
        if not self.materialize:
            return df
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
        self._persisted.append(df)
        return df

    def release(self) -> None:
        """Unpersist what this graph persisted (shared intermediates, size-checked
        broadcast sides) and delete the ``t_*`` files it wrote; its DataFrames of
        ``financials`` and the KPIs cannot be read afterwards."""
        while self._persisted:
            self._persisted.pop().unpersist()
        while self._written:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self._written.pop())
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        self.__dict__.pop("converted_table", None)

    # ---------------------------------------------------------------- staging
    @cached_property
    def stg_sub(self) -> DataFrame:
        if self.strict:
            staging.assert_clean(self.rejects_sub, "sub")
        return staging.stg_sub(self._counted("sub", self.raw.sub, staging.sub_checks()), self.truthy)

    def _counted(self, table: str, raw: DataFrame, checks: dict) -> DataFrame:
        if not self.count_rejects:
            return raw
        raw, self._observed[table] = staging.observe_rejects(raw, checks, f"rejects_{table}")
        return raw

    def reject_counts(self) -> dict:
        """{table: {"n_rows": rows, column: values that do not parse}} of the staging models built so
        far, counted by the jobs that built them (``count_rejects``).  Call it after an action that
        reads the whole of them: it waits for one, and a job that stops early has counted less."""
        return {table: dict(seen.get) for table, seen in self._observed.items()}

    def assert_none_rejected(self) -> None:
        """Strict mode by the counts: fail if any value of the staging models built so far did not parse."""
        bad = {t: {c: n for c, n in counts.items() if c != "n_rows" and n} for t, counts in self.reject_counts().items()}
        if any(bad.values()):
            raise staging.RejectedRowsError(f"values do not parse: {bad}")

    @property
    def rejects_sub(self) -> DataFrame:
        return staging.sub_rejects(self.raw.sub)

    @property
    def rejects_num(self) -> DataFrame:
        return staging.num_rejects(self.raw.num)

    @cached_property
    def stg_num(self) -> DataFrame:
        """All facts of FY filings, as the source's staging view."""
        self._check_num()
        return staging.stg_num(self._counted("num", self.raw.num, staging.num_checks()), self.stg_sub,
                               max_broadcast_rows=self._limit(staging.FILINGS_BROADCAST_ROWS),
                               keep=self._persisted)

    @cached_property
    def facts(self) -> DataFrame:
        """Facts of the ~50 tags any model reads, joined once to FY filing attributes
        (one copy of each identical filing row).  The tag filter runs before any
        exchange, so only those facts are shuffled."""
        return self._keep(self.facts_for(all_fact_tags()))

    def _check_num(self) -> None:
        """Fail on the first unparsable fact in strict mode (checked once per graph)."""
        if self.strict and not getattr(self, "_num_checked", False):
            staging.assert_clean(self.rejects_num, "num")
            self._num_checked = True

    @cached_property
    def stg_tag(self) -> DataFrame:
        return staging.stg_tag(self.raw.tag, self.truthy)

    @cached_property
    def stg_esg(self) -> DataFrame:
        return staging.stg_esg(self.raw.esg_risk_factors, self.raw.isin_cik, ESG_SIGNALS)

    # --------------------------------------------------------------------- FX
    @cached_property
    def fx_rates(self) -> DataFrame:
        """Rates from the facts of the rate tags only (unless the graph shares all facts)."""
        facts = self.facts if self.materialize else self.facts_for(FX_CLOSING_TAGS + FX_AVERAGE_TAGS)
        return self._keep(fx.fx_rates(facts))

    @property
    def closing_fx(self) -> DataFrame:
        return fx.closing_fx(self.facts, self.fx_rates)

    @property
    def average_fx(self) -> DataFrame:
        return fx.average_fx(self.facts, self.fx_rates)

    # ---------------------------------------------------------------- metrics
    @cached_property
    def metric_values(self) -> DataFrame:
        return self._keep(metrics.metric_values(self.facts))

    def metric_view(self, name: str, currency: str) -> DataFrame:
        """One metric view.  Without shared intermediates it reads only that
        metric's tags (the single pass pays off when all metrics are needed)."""
        if self.materialize:
            return metrics.metric_view(self.metric_values, name, currency)
        return metrics.metric_view(metrics.metric_values(self.facts_for(METRICS[name].tags), [METRICS[name]]),
                                   name, currency)

    def facts_for(self, tags, distinct_filings: bool = True) -> DataFrame:
        """Facts of the given tags only, joined to FY filing attributes (one copy of each
        identical filing row unless ``distinct_filings`` is off)."""
        self._check_num()
        return staging.stg_num(self.raw.num, self.stg_sub, tags=tuple(tags), with_filing=True,
                               distinct_filings=distinct_filings,
                               max_broadcast_rows=self._limit(staging.FILINGS_BROADCAST_ROWS),
                               keep=self._persisted)

    @cached_property
    def converted(self) -> DataFrame:
        return self._keep(convert.converted_tables(self.metric_values, self.fx_rates,
                                                   max_broadcast_rows=self._limit(convert.RATES_BROADCAST_ROWS),
                                                   uom_mode=self.uom_mode, keep=self._persisted))

    @cached_property
    def converted_table(self) -> DataFrame:
        """``converted`` written once, as Parquet by metric in the shared checkpoint
        folder.  The source materialises its six ``t_*`` models as tables for the
        same reason: the financials mart reads all six, and each read of the lazy
        plan would scan and aggregate the facts again.  A read of one metric opens
        its own files and columns only."""
        path = f"{checkpoint_dir(self.spark).rstrip('/')}/converted-{uuid.uuid4().hex}"
        self._written.append(path)
        self.converted.write.partitionBy("metric").parquet(path)
        return self.spark.read.schema(self.converted.schema).parquet(path)

    def t(self, name: str) -> DataFrame:
        """One converted metric.  Without shared intermediates it scans that metric's tags
        and the rate tags only."""
        if self.materialize:
            return convert.t_table(self.converted, name)
        spec = METRICS[name]
        values = metrics.metric_values(self.facts_for(spec.tags), [spec])
        return convert.t_table(convert.converted_tables(
            values, self.fx_rates, specs=[spec], max_broadcast_rows=self._limit(convert.RATES_BROADCAST_ROWS),
            uom_mode=self.uom_mode, keep=self._persisted), name)

    def t_tables(self) -> dict:
        return {n: convert.t_table(self.converted_table, n) for n in METRICS}

    # ------------------------------------------------------------------ marts
    @cached_property
    def float_candidates(self) -> DataFrame:
        facts = self.facts if self.materialize else self.facts_for(FLOAT_SHARE_TAGS + FLOAT_PRICE_TAGS)
        return floats.float_candidates(facts)

    @cached_property
    def float_inferred(self) -> DataFrame:
        """Reported floats keep the source's multiplicity: once per filing row."""
        reported = self.facts_for(FLOAT_REPORTED_TAGS, distinct_filings=False)
        return floats.float_inferred(reported, self.float_candidates)

    @cached_property
    def float_latest(self) -> DataFrame:
        return floats.float_latest(self.float_inferred, self.stg_sub)

    def financials(self, dedupe: bool = False) -> DataFrame:
        return marts.financials(self.t_tables(), self.stg_sub, dedupe=dedupe)

    # ------------------------------------------------------- exposure & KPIs
    def exposure(self, signal: str = "ph_expo_ew", match_year: bool = False) -> DataFrame:
        return exposure.asset_weighted_exposure(self.stg_esg, self.metric_view("assets", "usd"),
                                                signal=signal, match_year=match_year)

    def exposure_by_industry(self, year: int = 2024, signal: str = "cc_expo_ew") -> DataFrame:
        return exposure.exposure_by_industry(self.raw.esg_risk_factors,
                                             self.metric_view("assets", "usd"), year=year,
                                             signal=signal)

    def kpis(self, dedupe: bool = True) -> DataFrame:
        """KPIs read the financials mart twice (rows and industry means), so the
        mart is persisted first; its lineage is already cut at the written
        ``t_*`` files, so a lost block is rebuilt from there, not from ``num``."""
        fin = self.financials(dedupe=dedupe).persist(StorageLevel.MEMORY_AND_DISK)
        self._persisted.append(fin)
        return kpis.all_kpis(fin, self.stg_esg, max_broadcast_rows=self.max_broadcast_rows, keep=self._persisted)
