"""Write quarterly zip archives (sub.txt, num.txt, tag.txt per srcdir) from the
driver-derived raw tables, as test input for the landing job.

Spark writes one tab-separated file per (table, srcdir); the zip step only
copies those files into archives.

usage: python tools/make_archives.py <sf_dir> <out_dir>
"""

from __future__ import annotations

import glob
import os
import sys
import zipfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlake.session import build_session  # noqa: E402
from ledgerlake.sources.adapter import DriverRaw  # noqa: E402


def write_archives(spark, sf_dir: str, out_dir: str) -> list[str]:
    raw = DriverRaw(spark, sf_dir)
    staging = os.path.join(out_dir, "_tsv")
    tables = {"sub": raw.sub, "num": raw.num, "tag": raw.tag}
    for name, df in tables.items():
        (df.repartition("srcdir").write.mode("overwrite").partitionBy("srcdir")
           .option("sep", "\t").option("header", True).option("quote", "\u0000")
           .option("emptyValue", "").csv(os.path.join(staging, name)))
    srcdirs = sorted({os.path.basename(p).split("=", 1)[1]
                      for p in glob.glob(os.path.join(staging, "*", "srcdir=*"))})
    made = []
    for src in srcdirs:
        path = os.path.join(out_dir, f"{src}.zip")
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for name in tables:
                parts = sorted(glob.glob(os.path.join(staging, name, f"srcdir={src}", "part-*")))
                if parts:
                    z.write(parts[0], f"{name}.txt")
        made.append(path)
    return made


if __name__ == "__main__":
    spark = build_session("local[8]", shuffle_partitions=8)
    print(len(write_archives(spark, sys.argv[1], sys.argv[2])), "archives")
