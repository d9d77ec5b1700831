"""Upkeep of the six ``t_*`` tables and of the financials mart by what a landing changed.

A full build reads all of ``num``.  ``UpkeptTables`` instead keeps, beside the results, two layers cut
by srcdir that need no filing: the largest value per (filing, metric, date, unit) and the
facts of the rate tags.  After a landing only the srcdirs that its log shows as changed are read from
``num``; from the layers follow

* the filings touched (old and new rows of changed srcdirs of ``num`` and ``sub``) and their firm-years;
* the rates, and from those that moved, the filings with an amount that looks one up, and their firm-years;
* the amounts of these firm-years, which replace the old ones in the years they fall into;
* the financials of the firms touched, which replace the old ones in their buckets.

The results are those of a full build: maxima fold over srcdirs and the rates are means of all their facts.
Files are written aside and all tables change with one commit of a log like the landing's
(``sources/landing_log``), so a refresh that dies leaves the old state and the next one does its work again.
"""

from __future__ import annotations

import uuid
from dataclasses import replace
from typing import NamedTuple
from urllib.parse import unquote

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import base_currency, parse_pair
from ..functions.tags import FX_AVERAGE_TAGS, FX_CLOSING_TAGS, METRICS
from ..operators import convert, fx, marts, metrics, staging
from ..sources.landing import read_landed
from ..sources.landing_log import LOAD, CommitConflict, LandingState, Part, child_names, commit, read_state, versions
from .sizing import broadcast_if_small

#: Table -> its columns; the first four are cut by srcdir, all, year and bucket.
SCHEMAS = {
    "values": "adsh string, metric string, ddate date, uom string, value decimal(28,4)",
    "quotes": "adsh string, tag string, ddate date, qtrs int, uom string, value decimal(28,4)",
    "rates": "kind string, base string, ddate date, to_usd double, from_usd double",
    "amounts": "metric string, adsh string, cik bigint, name string, sic int, fy date, ddate date, amount_usd double",
    "financials": "name string, cik bigint, fy date, ddate date, sic int, " + ", ".join(
        f"{c} double" for c in marts.FIN_COLS[5:]),
}
BUCKETS = 64
FOLLOWED = ("landing", "version")  # key of the landing version that the tables follow


class Refresh(NamedTuple):
    """What a refresh did: the landing version followed, the srcdirs read from ``num``, and the years of the amounts
    and buckets of the financials written anew."""
    version: int
    srcdirs: tuple
    years: tuple
    buckets: tuple


def changed_srcdirs(old: LandingState, new: LandingState, table: str) -> set[str]:
    """Those whose rows differ between two states of a landing."""
    def dirs(state):
        return {s: p.dirs for (t, s), p in state.parts.items() if t == table}
    a, b = dirs(old), dirs(new)
    return {s for s in a.keys() | b.keys() if a.get(s, ()) != b.get(s, ())}


def _same_firm_year(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """``rows`` with (``left_semi``) or without (``left_anti``) those of the firm-years ``keys``."""
    k = keys.select(F.col("cik").alias("_cik"), F.col("fy").alias("_fy"))
    return rows.join(k, F.col("cik").eqNullSafe(F.col("_cik")) & F.col("fy").eqNullSafe(F.col("_fy")), how)


class UpkeptTables:
    """The ``t_*`` tables and the financials of a landing root, kept below ``root``.

    ``refresh`` brings them up to the last landing; ``amounts``, ``t`` and ``financials`` read them.  An
    empty landing gives empty tables.  Where the landing's log no longer holds the version that was
    followed, everything is built anew."""

    def __init__(self, spark: SparkSession, raw_root: str, root: str, buckets: int = BUCKETS,
                 max_broadcast_rows: int | None = None):
        """``buckets``: files of the financials, by hash of cik; it must not change over the life of ``root``."""
        self.spark, self.raw_root, self.root = spark, raw_root.rstrip("/"), root.rstrip("/")
        self.buckets, self.max_broadcast_rows = buckets, max_broadcast_rows

    # ------------------------------------------------------------------ files
    def _read(self, state: LandingState, table: str, keys=None) -> DataFrame:
        dirs = [d for (t, k), p in sorted(state.parts.items()) if t == table and (keys is None or k in keys) for d in p.dirs]
        if not dirs:
            return self.spark.createDataFrame([], SCHEMAS[table])
        return self.spark.read.schema(SCHEMAS[table]).parquet(*[f"{self.root}/{d}" for d in dirs])

    def _write(self, state: LandingState, table: str, rows: DataFrame, key: str | None = None, keys=("all",)) -> LandingState:
        """``state`` with the parts ``keys`` of a table replaced by ``rows``, cut by the column ``key``."""
        folder = f"{table}/{LOAD}={uuid.uuid4().hex}"
        if key is None:
            rows.write.parquet(f"{self.root}/{folder}")
            found = {"all": folder}
        else:
            rows.hint("rebalance", key).write.partitionBy(key).parquet(f"{self.root}/{folder}")
            found = {unquote(n[len(key) + 1:]): f"{folder}/{n}" for n in child_names(self.spark, f"{self.root}/{folder}")
                     if n.startswith(f"{key}=")}
        state = state.with_columns(table, rows.columns)
        for k in keys:
            state = state.with_part(table, k, Part((found[k],) if k in found else ()))
        return state

    def _limit(self, default: int) -> int:
        return default if self.max_broadcast_rows is None else self.max_broadcast_rows

    # ---------------------------------------------------------------- reading
    def amounts(self) -> DataFrame:
        """All converted amounts: metric, adsh, cik, name, sic, fy, ddate, amount_usd."""
        return self._read(read_state(self.spark, self.root), "amounts")

    def t(self, name: str) -> DataFrame:
        return convert.t_table(self.amounts(), name)

    def financials(self) -> DataFrame:
        return self._read(read_state(self.spark, self.root), "financials")

    # ---------------------------------------------------------------- refresh
    def refresh(self) -> Refresh | None:
        """Follow the landing; None where nothing has changed.  Of two refreshes at once one fails with
        ``CommitConflict``."""
        kept: list = []
        try:
            return self._refresh(kept)
        finally:
            for df in kept:
                df.unpersist()

    def _refresh(self, kept: list) -> Refresh | None:
        spark = self.spark
        now, state = read_state(spark, self.raw_root), read_state(spark, self.root)
        start, before = state.version, LandingState()
        if FOLLOWED in state.parts:
            version = int(state.parts[FOLLOWED].archive)
            if version == now.version:
                return None
            if version in versions(spark, self.raw_root):
                before = read_state(spark, self.raw_root, version)
            elif version:
                state = LandingState()
        changed = {table: changed_srcdirs(before, now, table) for table in ("sub", "num")}
        if not any(changed.values()) and not (start and not state.version):
            return self._commit(state, start, Refresh(now.version, (), (), ()))

        def keep(df: DataFrame) -> DataFrame:
            kept.append(df.persist(StorageLevel.MEMORY_AND_DISK))
            return df

        def stg_sub(at: LandingState) -> DataFrame:
            return staging.stg_sub(read_landed(spark, self.raw_root, "sub", version=at.version))
        old_sub, new_sub = stg_sub(before), stg_sub(now)
        changed_sub = [s.filter(F.col("srcdir").isin(*changed["sub"])) for s in (old_sub, new_sub)]

        old_values = self._read(state, "values", changed["num"])
        state = self._with_layers(state, now, changed["num"])
        touched = old_values.select("adsh").union(self._read(state, "values", changed["num"]).select("adsh"))
        for s in changed_sub:
            touched = touched.union(s.select("adsh"))

        filings = broadcast_if_small(staging.fy_filings(new_sub).distinct(), self._limit(staging.FILINGS_BROADCAST_ROWS), kept)
        old_rates = self._read(state, "rates")
        state = self._write(state, "rates", fx.fx_rates(self._read(state, "quotes").join(filings, "adsh")))

        # old filings of other srcdirs are among the new ones
        annual = staging.fy_filings(changed_sub[0]).select("adsh", "cik", "fy", "form").union(
            filings.select("adsh", "cik", "fy", "form")).filter(staging.is_annual())
        lookups = keep(self._lookups(self._read(state, "values")))
        if not now.srcdirs("sub") <= changed["sub"]:  # else all filings are touched
            moved = keep(self._moved(old_rates, self._read(state, "rates")))
            if not moved.isEmpty():
                touched = touched.union(self._looked_up(self._read(state, "values"), lookups, moved, kept))
            annual = annual.join(touched.distinct(), "adsh", "left_semi")
        keys = keep(annual.select("cik", "fy").distinct())
        per_year = keys.groupBy(F.year("fy")).count().collect()  # fiscal years: a few dozen at most
        years = sorted(r[0] for r in per_year)

        mine = _same_firm_year(filings.filter(staging.is_annual()), keys, "left_semi")
        limit = self._limit(staging.FILINGS_BROADCAST_ROWS)
        if sum(r[1] for r in per_year) <= limit:  # else there are more filings, or none is left of most firm-years
            mine = broadcast_if_small(mine, limit, kept)
        amounts = convert.converted_tables(
            metrics.largest_values(self._read(state, "values").join(mine, "adsh")), self._read(state, "rates"),
            max_broadcast_rows=self._limit(convert.RATES_BROADCAST_ROWS), keep=kept, lookups=lookups.select("base", "ddate"))
        names = [str(y) for y in years]
        stay = _same_firm_year(self._read(state, "amounts", names), keys, "left_anti")
        state = self._write(state, "amounts", stay.unionByName(amounts).withColumn("year", F.year("fy")), "year", names)

        ciks = keys.select("cik")
        for s in changed_sub:
            ciks = ciks.union(s.select("cik"))
        bucket = F.pmod(F.hash("cik"), F.lit(self.buckets))
        ciks = keep(ciks.filter("cik is not null").distinct())  # a firm without a number is in no financials
        places = sorted(r[0] for r in ciks.select(bucket).distinct().collect())
        firms = self._read(state, "amounts").join(ciks, "cik", "left_semi")
        fresh = marts.financials({n: convert.t_table(firms, n) for n in METRICS}, new_sub.join(ciks, "cik", "left_semi"))
        names = [str(b) for b in places]
        stay = self._read(state, "financials", names).join(ciks, "cik", "left_anti")
        state = self._write(state, "financials", stay.select(*marts.FIN_COLS).unionByName(fresh).withColumn("bucket", bucket),
                            "bucket", names)

        return self._commit(state, start, Refresh(now.version, tuple(sorted(changed["num"])), tuple(years), tuple(places)))

    def _commit(self, state: LandingState, start: int, done: Refresh) -> Refresh:
        state = state.with_part(*FOLLOWED, Part((), str(done.version)))

        def change(last: LandingState) -> LandingState:
            if last.version != start:
                raise CommitConflict(f"{self.root}: another refresh was faster")
            return replace(state, version=last.version)
        commit(self.spark, self.root, change)
        return done

    def _with_layers(self, state: LandingState, now: LandingState, srcdirs: set[str]) -> LandingState:
        """The two layers with those srcdirs of ``num`` read anew."""
        num = read_landed(self.spark, self.raw_root, "num", version=now.version).filter(F.col("srcdir").isin(*srcdirs))
        values = metrics.qualifying_facts(staging.typed_num(num, metrics.metric_tags()))
        values = values.groupBy("srcdir", "adsh", "metric", "ddate", "uom").agg(F.max("value").alias("value"))
        quotes = staging.typed_num(num, FX_CLOSING_TAGS + FX_AVERAGE_TAGS).filter("value is not null")
        state = self._write(state, "values", values.select("adsh", "metric", "ddate", "uom", "value", "srcdir"), "srcdir", srcdirs)
        return self._write(state, "quotes", quotes.select("adsh", "tag", "ddate", "qtrs", "uom", "value", "srcdir"),
                           "srcdir", srcdirs)

    @staticmethod
    def _moved(old: DataFrame, new: DataFrame) -> DataFrame:
        """(kind, base, ddate) of the rates that came, went or changed."""
        key = ["kind", "base", "ddate"]
        both = old.select(*key, F.col("to_usd").alias("a"), F.lit(1).alias("was")).join(
            new.select(*key, F.col("to_usd").alias("b"), F.lit(1).alias("there")), key, "full")
        same = F.col("was").eqNullSafe(F.col("there")) & F.col("a").eqNullSafe(F.col("b"))
        return both.filter(~same).select(*key)

    @staticmethod
    def _lookups(values: DataFrame) -> DataFrame:
        """(uom, ddate, base) of the amounts in another currency: units x dates, however many facts there are."""
        units = values.filter("uom <> 'USD'").select("uom", "ddate").distinct()
        return units.withColumn("base", base_currency(*parse_pair("uom"))).filter("base is not null")

    def _looked_up(self, values: DataFrame, lookups: DataFrame, moved: DataFrame, kept: list) -> DataFrame:
        """adsh of the filings with an amount in another currency that looks up one of the rates ``moved``."""
        asked = convert.fx_candidates(lookups).select("uom", lookups["ddate"], "kind", "base", "fx_date")
        m = moved.select("kind", "base", F.col("ddate").alias("fx_date"))
        hit = asked.join(m, ["kind", "base", "fx_date"], "left_semi").select("uom", "ddate").distinct()
        hit = broadcast_if_small(hit, self._limit(convert.RATES_BROADCAST_ROWS), kept)
        return values.join(hit, ["uom", "ddate"], "left_semi").select("adsh")
