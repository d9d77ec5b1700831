"""Command line: the landing job, the model build and ad-hoc SQL.

  python -m ledgerlake land  --zips-dir DIR --raw DIR [--mode append|skip|replace] [--rebalance N]
  python -m ledgerlake build --raw DIR --seeds DIR --out DIR [--strict]
  python -m ledgerlake refresh --raw DIR --out DIR
  python -m ledgerlake sql   --raw DIR --seeds DIR --query "select ..." [--out DIR] [--views DIR]
  python -m ledgerlake view  --views DIR --name NAME [--query "select ..."]

``build`` writes every model (staging, rates, the twelve metric views, the six
``t_*`` tables, float, financials, exposure, KPIs) as Parquet under --out,
one folder per model named as the source names it; with --strict it ends after the staging models when a value of
theirs did not parse.  ``refresh`` keeps the six ``t_*`` tables and the financials below --out up
to date with the landing, by the quarters landed since the last call.  ``sql`` registers the
same names as views and runs one SELECT over them and the stored views.  ``view``
stores one user view, or drops it when no query is given.
"""

from __future__ import annotations

import argparse
import json
import os

from .plans import views
from .plans.models import FilingModels
from .plans.upkeep import UpkeptTables
from .plans.view_catalog import ViewCatalog
from .session import build_session
from .sources.landing import LandedRaw, land_archives
from .sources.seeds import read_seed


def _models(spark, raw_dir: str, seeds_dir: str, materialize: bool = True, **options) -> FilingModels:
    seeds = {name: read_seed(spark, os.path.join(seeds_dir, f"{name}.csv"), name)
             for name in ("esg_risk_factors", "isin_cik")}
    return FilingModels(spark, LandedRaw(spark, raw_dir, seeds=seeds), materialize=materialize, **options)


STAGED_FIRST = ("stg_dera_sub", "stg_dera_num")


def build_all(models: FilingModels, out_dir: str) -> list[str]:
    """Write every model below ``out_dir``.  Where the models count rejects, the staging models
    come first, and a value that did not parse ends the build there."""
    spark, written = models.spark, []

    def write(names):
        for name in views.register_models(models, names):
            spark.table(name).write.mode("overwrite").parquet(os.path.join(out_dir, name))
            written.append(name)
    if models.count_rejects:
        write(set(STAGED_FIRST))
        models.assert_none_rejected()
    write(views.published_names() - set(written))
    models.kpis().write.mode("overwrite").parquet(os.path.join(out_dir, "kpis"))
    written.append("kpis")
    return written


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="ledgerlake")
    sub = ap.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("land")
    a.add_argument("--zips-dir", required=True)
    a.add_argument("--raw", required=True)
    a.add_argument("--mode", choices=["append", "skip", "replace"], default="append")
    a.add_argument("--rebalance", type=int, help="spread decoded lines over N partitions (default: where archives are few or uneven; 0: never)")
    b = sub.add_parser("build")
    b.add_argument("--raw", required=True)
    b.add_argument("--seeds", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--strict", action="store_true", help="fail when a non-blank value does not parse")
    b.add_argument("--catalog-schema", help="also save every model as a table in <schema>, <schema>_stg, "
                                            "<schema>_int, <schema>_marts (the source's layout)")
    r = sub.add_parser("refresh")
    r.add_argument("--raw", required=True)
    r.add_argument("--out", required=True)
    q = sub.add_parser("sql")
    q.add_argument("--raw", required=True)
    q.add_argument("--seeds", required=True)
    q.add_argument("--query", required=True)
    q.add_argument("--out")
    q.add_argument("--views", help="folder of stored user views that the query may read")
    v = sub.add_parser("view")
    v.add_argument("--views", required=True)
    v.add_argument("--name", required=True)
    v.add_argument("--query")
    args = ap.parse_args(argv)

    spark = build_session()
    if args.cmd == "land":
        print(json.dumps(land_archives(spark, args.zips_dir, args.raw, mode=args.mode,
                                       rebalance=args.rebalance)))
    elif args.cmd == "build":
        m = _models(spark, args.raw, args.seeds, count_rejects=args.strict)
        print(json.dumps(build_all(m, args.out)))
        if args.catalog_schema:
            print(json.dumps(views.save_models_as_tables(m, args.catalog_schema, args.out + "/_catalog")))
        m.release()
    elif args.cmd == "refresh":
        done = UpkeptTables(spark, args.raw, args.out).refresh()
        print(json.dumps(done and done._asdict()))
    elif args.cmd == "view":
        catalog = ViewCatalog(spark, args.views)
        catalog.define({args.name: args.query}) if args.query else catalog.drop(args.name)
        print(json.dumps(catalog.order()))
    else:
        m = _models(spark, args.raw, args.seeds, materialize=False)
        df = ViewCatalog(spark, args.views).query(m, args.query)
        if args.out:
            df.write.mode("overwrite").parquet(args.out)
        else:
            df.show(50, truncate=False)


if __name__ == "__main__":
    main()
