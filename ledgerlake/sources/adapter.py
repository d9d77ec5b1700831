"""Deterministic mapping of the driver's star-schema tables onto filing-shaped raw tables.

The driver tables hold no filings, so ``orders``/``customer`` become submissions,
``lineitem`` becomes numeric facts, ``customer`` becomes the ESG panel and the
ISIN map.  The mapping is written once as SQL text per dialect: Spark runs it on
the driver tables, and the DuckDB oracle runs the very same text, so both engines
start from identical raw rows.  Every raw column is a string, as landed.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


def _ymd(expr: str, dialect: str) -> str:
    if dialect == "spark":
        return f"date_format({expr}, 'yyyyMMdd')"
    return f"strftime({expr}, '%Y%m%d')"


def _years(dialect: str) -> str:
    return "explode(array(0, 1, 2))" if dialect == "spark" else "unnest([0, 1, 2])"


# Twenty ESG signal columns: (topic, kind) in seed order.
ESG_TOPICS = ("cc", "op", "rg", "ph")
ESG_KINDS = ("expo", "risk", "pos", "neg", "sent")
ESG_SIGNALS = tuple(f"{t}_{k}_ew" for t in ESG_TOPICS for k in ESG_KINDS)


def _esg_signal_expr(j: int, name: str) -> str:
    """Synthetic signal j: a bounded residue of custkey*(year offset), scaled to [0, 0.01).

    cc_expo_ew and ph_expo_ew follow the two columns given in FIXTURES.md; the other
    eighteen follow the same pattern with a rule-derived multiplier, modulus and NULL
    period.  Sentiment columns are centred so that they take both signs.
    """
    if name == "cc_expo_ew":
        off, mod, null_mod = 3, 1000, None
    elif name == "ph_expo_ew":
        off, mod, null_mod = 1, 997, 7
    else:
        off, mod, null_mod = 1 + j % 4, 1000 - 7 * j, (11 + j if j % 3 == 0 else None)
    centre = mod // 2 if name.endswith("_sent_ew") else 0
    val = f"round(cast((c_custkey * (y + {off}) % {mod}) - {centre} as double) / 100000.0, 6)"
    if null_mod:
        val = f"case when c_custkey % {null_mod} = 0 then null else {val} end"
    return f"cast({val} as double) as {name}"


def adapter_sql(dialect: str = "spark") -> dict[str, str]:
    """SQL text of the five raw relations. Table names are plain identifiers
    (``orders``, ``customer``, ``lineitem``) for DuckDB and ``{orders}`` style
    placeholders for ``spark.sql(..., orders=df)``."""
    if dialect == "spark":
        t = {n: "{" + n + "}" for n in ("orders", "customer", "lineitem", "raw_num")}
    else:
        t = {n: n for n in ("orders", "customer", "lineitem", "raw_num")}
    raw_sub = f"""
select 'A' || lpad(cast(o_orderkey as string), 12, '0') as adsh,
  lpad(cast(c_custkey as string), 10, '0') as cik, c_name as name,
  cast(1000 + c_nationkey as string) as sic,
  case when o_orderkey % 17 = 0 then '' else cast(900000000 + c_custkey as string) end as ein,
  case o_orderkey % 5 when 0 then '10-K' when 1 then '20-F' when 2 then '10-K' when 3 then '40-F' else '10-Q' end as form,
  case when o_orderkey % 23 = 0 then '' else {_ymd('o_orderdate', dialect)} end as period,
  case when o_orderkey % 29 = 0 then '' when o_orderkey % 31 = 0 then '2013'
       else cast(year(o_orderdate) + 20 as string) end as fy,
  case when o_orderkey % 5 = 4 then 'Q2' else 'FY' end as fp,
  {_ymd('o_orderdate', dialect)} as filed, '' as accepted,
  'true' as wksi, 'false' as prevrpt, 'true' as detail,
  cast(year(o_orderdate) as string) || 'q' || cast(quarter(o_orderdate) as string) as srcdir
from {t['orders']} join {t['customer']} on o_custkey = c_custkey"""

    raw_num = f"""
with a as (
  select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
    l_shipdate, o_orderdate,
    (l_partkey * 7 + l_suppkey * 3 + l_linenumber) % 20 as k, (l_partkey + l_linenumber) % 10 as u
  from {t['lineitem']} join {t['orders']} on l_orderkey = o_orderkey
), b as (
  select *, last_day(cast((case when k in (12, 13) then o_orderdate else l_shipdate end) + interval 20 year as date)) as dd
  from a
)
select 'A' || lpad(cast(l_orderkey as string), 12, '0') as adsh,
  case when k in (14, 15) and month(dd) not in (3, 6, 9) then 'Other'
       when k in (16, 17) and not (month(dd) = 12 or (month(dd) = 4 and year(dd) % 2 = 1)) then 'Other'
       else case k when 0 then 'Assets' when 1 then 'Assets' when 2 then 'Cash' when 3 then 'CashAndCashEquivalents'
         when 4 then 'LongTermDebt' when 5 then 'SecuredDebt' when 6 then 'EntityPublicFloat' when 7 then 'PublicFloat'
         when 8 then 'Revenues' when 9 then 'Revenue' when 10 then 'NetIncomeLoss' when 11 then 'ProfitLoss'
         when 12 then 'SharesOutstanding' when 13 then 'SharePrice' when 14 then 'ClosingForeignExchangeRate'
         when 15 then 'ForeignCurrencyExchangeRateTranslation1' when 16 then 'AverageForeignExchangeRate'
         when 17 then 'AverageForeignExchangeRate' else 'Other' end end as tag,
  'us-gaap/2020' as version, case when l_quantity % 13 = 0 then 'SUB' else '' end as coreg,
  {_ymd('dd', dialect)} as ddate,
  case when k in (8, 9, 10, 11, 16, 17) then '4' else '0' end as qtrs,
  case when k = 12 then 'shares' when k = 13 then 'USD/shares'
       when k between 14 and 17 then case u % 4 when 0 then 'EURUSD' when 1 then 'USD/JPY' when 2 then 'GBP/USD' else 'EUR' end
       else case u when 0 then 'EUR' when 1 then 'EURUSD' when 2 then 'USD/JPY' when 3 then 'GBP/USD' else 'USD' end end as uom,
  '' as segments,
  cast(cast(case when k in (10, 11) and l_linenumber % 3 = 0 then -l_extendedprice
        when k between 14 and 17 then 0.5 + l_discount * 10 else l_extendedprice end as decimal(28,4)) as string) as value,
  '' as footnote, cast(year(o_orderdate) as string) || 'q' || cast(quarter(o_orderdate) as string) as srcdir
from b"""

    raw_tag = f"""
select distinct tag, version, case when tag = 'Other' then 'true' else 'false' end as custom, 'false' as abstract,
  '' as datatype, '' as iord,
  case when tag in ('Assets', 'Cash') then 'D' else '' end as crdr, tag as tlabel, '' as doc, '2020q1' as srcdir
from {t['raw_num']}"""

    signals = ",\n  ".join(_esg_signal_expr(j, n) for j, n in enumerate(ESG_SIGNALS))
    esg = f"""
select 'US' || lpad(cast(c_custkey as string), 10, '0') as isin, cast(c_custkey as string) as gvkey,
  '' as cusip, 'US' as hqcountrycode, cast(2019 + y as int) as year,
  {signals}
from (select c_custkey, {_years(dialect)} as y from {t['customer']}) cy"""

    isin_cik = f"""
select 'US' || lpad(cast(c_custkey as string), 10, '0') as isin, lpad(cast(c_custkey as string), 10, '0') as cik
from {t['customer']} where c_custkey % 10 <> 9"""
    return {"raw_sub": raw_sub, "raw_num": raw_num, "raw_tag": raw_tag,
            "esg_risk_factors": esg, "isin_cik": isin_cik}


def _chained(dialect: str, f: str, g: str, body: str) -> str:
    """One query over the steps ``f`` and ``g``, which reads f: by WITH, in Spark by subqueries.  There the
    names of a WITH would be numbered by their place in the whole plan, and a persisted part not be known again in it."""
    if dialect != "spark":
        return f"\nwith f as ({f}),\ng as ({g.format(f='f')})\n{body.format(g='g')}"
    step = g.format(f=f"({f}) f")
    return body.format(g=f"({step}) g")


def dirty_sql(dialect: str = "spark") -> dict[str, str]:
    """The same filings and facts with the faults real ones have: filings filed in two quarters,
    malformed identifiers and years, the known bad dates, blank, absent and malformed values, missing
    units, repeated facts, and rates far from 1 (USD/JPY near 100, USD/IRR near 42,000)."""
    t = {n: "{" + n + "}" if dialect == "spark" else f"clean_{n}" for n in ("raw_num", "raw_sub")}
    sub_cols = ("adsh", "cik", "name", "sic", "ein", "form", "period", "fy", "fp", "filed", "accepted", "wksi",
                "prevrpt", "detail", "srcdir")
    faults = {"cik": "case when n % 37 = 0 then 'CIK?' else cik end",
              "sic": "case when n % 13 = 0 then 'abc' else sic end",
              "period": "case when n % 43 = 0 then '20201399' else period end",
              "fy": "case when n % 41 = 0 then 'FY20' else fy end"}
    picked = ", ".join(f"{faults[c]} as {c}" if c in faults else c for c in sub_cols)
    raw_sub = _chained(
        dialect, f"select *, cast(substr(adsh, 2) as bigint) as n from {t['raw_sub']}", f"select {picked}, n from {{f}}",
        f"""select {', '.join(sub_cols)} from {{g}}
union all
select {', '.join(c if c != 'srcdir' else "'again'" for c in sub_cols)} from {{g}} where n % 11 = 0""")
    amount = "cast(value as decimal(28,4))"
    raw_num = _chained(
        dialect, f"""select *, cast(abs({amount}) * 100 as bigint) % 100 as k, tag like '%ExchangeRate%' as is_rate
           from {t['raw_num']}""", f"""
  select adsh, tag, version, coreg,
    case k when 1 then '29231231' when 2 then '21061130' when 3 then '21051130' when 4 then '21080430'
           when 5 then '' when 6 then '20200230' else ddate end as ddate,
    case k when 12 then 'x' when 13 then '' else qtrs end as qtrs,
    case when k = 15 then null when k = 16 then 'Usd' when uom = 'USD/JPY' and k % 20 = 0 then 'USD/IRR' else uom end as uom,
    segments,
    case when is_rate and uom = 'USD/JPY' and k % 20 = 0 then cast(cast({amount} * 42105.37 as decimal(28,4)) as string)
         when is_rate and uom = 'USD/JPY' then cast(cast({amount} * 103.21 as decimal(28,4)) as string)
         when is_rate then value
         when k = 7 then '' when k = 8 then '12,5' when k = 9 then 'n/a' when k = 10 then null
         when k = 11 then '000' || value else value end as value,
    footnote, srcdir, k
  from {{f}}""", """select adsh, tag, version, coreg, ddate, qtrs, uom, segments, value, footnote, srcdir from {g}
union all
select adsh, tag, version, coreg, ddate, qtrs, uom, segments, value, footnote, srcdir from {g} where k = 17""")
    return {"raw_sub": raw_sub, "raw_num": raw_num}


def read_driver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def source_bytes(spark: SparkSession, sf_dir: str, *names: str) -> int:
    """Bytes of the driver tables ``names`` in their files; tables that are not there have none."""
    try:
        total = 0
        for name in names:
            jp = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
            fs = jp.getFileSystem(spark._jsc.hadoopConfiguration())
            total += int(fs.getContentSummary(jp).getLength()) if fs.exists(jp) else 0
        return total
    except Exception:  # remote session: size only matters for numbers of files and partitions
        return 0


def choose_buckets(spark: SparkSession, source_bytes: int, bytes_per_bucket: int = 256 << 20) -> int:
    """Enough buckets (or files) for every core, and one per ~256 MB of source."""
    try:
        cores = spark.sparkContext.defaultParallelism
    except Exception:  # a remote (Connect) session has no SparkContext
        cores = int(spark.conf.get("spark.sql.shuffle.partitions", "8"))
    return max(cores, -(-source_bytes // bytes_per_bucket))


SPREAD_BYTES = 128 << 20  # facts from more source than this leave their join in many partitions


ESG_BYTES_PER_FILE = 1 << 20  # of customers, whose panel is some 14 times larger


def choose_files(spark: SparkSession, source_bytes: int) -> int | None:
    """Files over which landed facts are spread by a shuffle of their own: one per core for a small
    source, which may come out of its join in one partition; None for a large one, whose facts are written as the
    join leaves them (the shuffle would move and sort every row once more, at its full width)."""
    return None if source_bytes > SPREAD_BYTES else choose_buckets(spark, source_bytes)


class DriverRaw:
    """Raw filing-shaped relations derived from the driver tables of one scale.

    ``land=True`` (default) writes the derived raw tables once per application
    under the shared checkpoint folder, as the landing job would, as plain
    Parquet.  ``buckets=N`` (or ``"auto"``: a bucket per core and per ~256 MB of
    source) instead writes ``sub`` and ``num`` bucketed and
    sorted by ``adsh`` into N buckets: the facts x filings join and every
    aggregate keyed by adsh then need no shuffle, but a bucket is read by one
    task, so a filing holding a third of all facts would pin that third to one
    task.  The default layout keeps the facts splittable and lets the join
    broadcast the (size-checked) filings or split a hot key at runtime.
    ``land=False`` keeps the relations as lazy plans over the driver tables.  Files of a small
    source are evened out by ``choose_files``.
    """

    _landed: dict = {}
    _lock = threading.RLock()  # queries may be built from several threads; raw_tag lands raw_num first

    def __init__(self, spark: SparkSession, sf_dir: str, land: bool = True, buckets: int | str | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.land = land
        if buckets == "auto":
            buckets = choose_buckets(spark, self._source_bytes())
        self.buckets = buckets
        self._sql = adapter_sql("spark")
        self._cache: dict[str, DataFrame] = {}

    def _t(self, name):
        return read_driver(self.spark, self.sf_dir, name)

    def _source_bytes(self) -> int:
        return source_bytes(self.spark, self.sf_dir, "lineitem")

    def _plan(self, key) -> DataFrame:
        if key == "raw_sub":
            return self.spark.sql(self._sql[key], orders=self._t("orders"), customer=self._t("customer"))
        if key == "raw_num":
            return self.spark.sql(self._sql[key], lineitem=self._t("lineitem"), orders=self._t("orders"))
        if key == "raw_tag":
            return self.spark.sql(self._sql[key], raw_num=self._get("raw_num"))
        customer = self._t("customer")
        if key == "esg_risk_factors":
            # 60 signals of a customer are costly to write and a customer is a few bytes: one split may hold them all
            customer = customer.select("c_custkey").repartition(
                choose_buckets(self.spark, source_bytes(self.spark, self.sf_dir, "customer"), ESG_BYTES_PER_FILE), "c_custkey")
        return self.spark.sql(self._sql[key], customer=customer)

    def _get(self, key) -> DataFrame:
        if key in self._cache:
            return self._cache[key]
        if not self.land:
            df = self._plan(key)
        else:
            from .tables import land_table
            try:
                app = self.spark.sparkContext.applicationId
            except Exception:
                app = self.spark.conf.get("spark.app.id", "app")
            tag = "".join(ch if ch.isalnum() else "_" for ch in self.sf_dir.strip("/"))
            ident = (app, self.sf_dir, key, self.buckets)
            name = f"{key}_{tag}_{abs(hash(ident)) % 10**8}"
            with DriverRaw._lock:
                if ident not in DriverRaw._landed:
                    bucket = "adsh" if key in ("raw_sub", "raw_num") and self.buckets else None
                    files = choose_files(self.spark, self._source_bytes()) if key == "raw_num" else None
                    land_table(self.spark, self._plan(key), name, bucket_col=bucket, buckets=self.buckets,
                               files=files)
                    DriverRaw._landed[ident] = name
            df = self.spark.table(DriverRaw._landed[ident])
        self._cache[key] = df
        return df

    @property
    def sub(self) -> DataFrame:
        return self._get("raw_sub")

    @property
    def num(self) -> DataFrame:
        return self._get("raw_num")

    @property
    def tag(self) -> DataFrame:
        return self._get("raw_tag")

    @property
    def esg_risk_factors(self) -> DataFrame:
        return self._get("esg_risk_factors")

    @property
    def isin_cik(self) -> DataFrame:
        return self._get("isin_cik")


class DirtyRaw(DriverRaw):
    """``DriverRaw`` with the faults of ``dirty_sql``."""

    @property
    def sub(self) -> DataFrame:
        return self.spark.sql(dirty_sql()["raw_sub"], raw_sub=super().sub)

    @property
    def num(self) -> DataFrame:
        return self.spark.sql(dirty_sql()["raw_num"], raw_num=super().num)
