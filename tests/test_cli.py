"""The command line in a separate process: land archives (one lacks tag.txt and
several base columns), then SQL over the models."""

import os
import subprocess
import sys
import zipfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_cli_land_and_sql(tmp_path):
    zips = tmp_path / "zips"
    zips.mkdir()
    with zipfile.ZipFile(zips / "2021q1.zip", "w") as z:
        z.writestr("sub.txt", "adsh\tcik\tname\tsic\tform\tperiod\tfy\tfp\tfiled\taccepted\twksi\tprevrpt\tdetail\n"
                              "A1\t1\tACME\t1000\t10-K\t20201231\t2020\tFY\t20210201\t\ttrue\tfalse\ttrue\n")
        z.writestr("num.txt", "adsh\ttag\tversion\tcoreg\tddate\tqtrs\tuom\tvalue\tfootnote\n"
                              "A1\tAssets\tus-gaap/2020\t\t20201231\t0\tUSD\t1000\t\n"
                              "A1\tRevenues\tus-gaap/2020\t\t20201231\t4\tUSD\t500\t\n")
    seeds = tmp_path / "seeds"
    seeds.mkdir()
    (seeds / "isin_cik.csv").write_text("isin,cik\n")
    (seeds / "esg_risk_factors.csv").write_text("isin,gvkey,cusip,hqcountrycode,year\n")
    env = dict(os.environ, PYTHONPATH=ROOT)
    raw = tmp_path / "raw"
    subprocess.run([sys.executable, "-m", "ledgerlake", "land", "--zips-dir", str(zips), "--raw", str(raw)],
                   check=True, env=env, cwd=str(tmp_path), capture_output=True, timeout=600)
    out = tmp_path / "out"
    subprocess.run([sys.executable, "-m", "ledgerlake", "sql", "--raw", str(raw), "--seeds", str(seeds),
                    "--query", "select cik, revenue_usd, assets_usd from financials", "--out", str(out)],
                   check=True, env=env, cwd=str(tmp_path), capture_output=True, timeout=600)
    import pyarrow.parquet as pq
    t = pq.read_table(str(out)).to_pylist()
    assert t == [{"cik": 1, "revenue_usd": 500.0, "assets_usd": 1000.0}]
