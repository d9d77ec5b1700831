"""Landing of quarterly archives into raw Parquet tables.

Archive layout: one ``YYYYqN.zip`` per quarter holding tab-separated
``sub.txt``, ``num.txt`` and ``tag.txt`` (header line first, UTF-8, no quoting).

Execution:
  * archives are listed by Spark's ``binaryFile`` source (non-zip files are
    ignored by the glob) and read by the data source of ``archive_source``: one
    task opens one archive as a seekable file, streams one member line
    by line and yields Arrow batches of at most ``batch_lines`` lines: a task
    never holds a whole archive or a whole decoded member;
  * splitting, padding/folding and the column mapping are Catalyst
    expressions over those lines;
  * headers (one per archive member) are the only thing joined back, as a
    size-checked broadcast;
  * output is Parquet by ``srcdir``, written aside and made visible for all
    tables at once by a commit to the log of ``landing_log``, which also holds
    the columns; modes append / skip / replace.
"""

from __future__ import annotations

import io
import json
import logging
import uuid
import zipfile
from concurrent.futures import ThreadPoolExecutor
from functools import partial
from urllib.parse import unquote

import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.sizing import broadcast_if_small
from .archive_source import MEMBERS, archive_reader, member_lines, open_archive
from .landing_log import LOAD, LandingState, Part, child_names, commit, read_state

log = logging.getLogger(__name__)

# Base columns of the raw tables (the quarterly data sets' documented fields).
# Every landed table carries them, NULL where an archive's header lacks one;
# columns seen only in a header are added after them.
RAW_BASE_COLUMNS = {
    "sub": ("adsh", "cik", "name", "sic", "countryba", "stprba", "cityba", "zipba", "bas1", "bas2", "baph",
            "countryma", "stprma", "cityma", "zipma", "mas1", "mas2", "countryinc", "stprinc", "ein",
            "former", "changed", "afs", "wksi", "fye", "form", "period", "fy", "fp", "filed", "accepted",
            "prevrpt", "detail", "instance", "nciks", "aciks"),
    "num": ("adsh", "tag", "version", "coreg", "ddate", "qtrs", "uom", "segments", "value", "footnote"),
    "tag": ("tag", "version", "custom", "abstract", "datatype", "iord", "crdr", "tlabel", "doc"),
}
LINE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("srcdir", T.StringType()),
    T.StructField("table", T.StringType()),
    T.StructField("line_no", T.LongType()),
    T.StructField("line", T.StringType()),
])


# ------------------------------------------------------------------ A4 / A5
def clean_line(line) -> F.Column:
    """Strip trailing CR/LF characters (the line terminator)."""
    line = F.col(line) if isinstance(line, str) else line
    return F.rtrim(line, F.lit("\r\n"))


def normalize_fields(parts, n) -> F.Column:
    """Exactly ``n`` fields: pad short rows with '' and fold extra fields into
    the last one, joined back with tabs."""
    parts = F.col(parts) if isinstance(parts, str) else parts
    n = F.lit(n) if isinstance(n, int) else n
    size = F.size(parts)
    pad = F.concat(parts, F.array_repeat(F.lit(""), n - size))
    fold = F.concat(F.slice(parts, 1, n - 1),
                    F.array(F.array_join(F.slice(parts, n, size - n + 1), "\t")))
    return F.when(size < n, pad).when(size > n, fold).otherwise(parts)


def split_fields(line) -> F.Column:
    """Split on tab, no quoting, empty fields kept."""
    return F.split(line, "\t", -1)


def parse_fixed_header(lines: DataFrame, line_col: str, header: list) -> DataFrame:
    """Parse text lines against one known header (blank lines are skipped)."""
    n = len(header)
    clean = lines.withColumn("_line", clean_line(line_col)).filter(F.col("_line") != F.lit(""))
    parts = normalize_fields(split_fields(F.col("_line")), n)
    out = clean.withColumn("_parts", parts)
    return out.select(*[c for c in lines.columns if c != line_col],
                      *[F.col("_parts")[i].alias(h) for i, h in enumerate(header)])


# ------------------------------------------------------------------ A1 - A3
def srcdir_of(path) -> F.Column:
    """File name up to the first dot: ``.../2019q4.zip`` -> ``2019q4``."""
    path = F.col(path) if isinstance(path, str) else path
    return F.regexp_extract(path, r"([^/]+?)(\.[^/]*)?$", 1)


def _pyarrow_readable(uri: str) -> bool:
    if uri.startswith("file:"):
        return True
    try:
        import pyarrow.fs as pafs
        pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
        return True
    except Exception:
        return False


def list_archives(spark: SparkSession, zips_dir: str, read_content: bool | None = None) -> DataFrame:
    """``binaryFile`` listing of ``*.zip`` (case-insensitive) with ``srcdir``.

    By default only paths are listed and each task opens its archive as a
    seekable file (local files directly, other stores through pyarrow): the
    header pass then reads just the zip directory and the first line of each
    member, and no task holds a whole archive in memory.  Where pyarrow cannot
    open the store, ``content`` (the archive bytes, read by Spark) is carried
    instead."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(zips_dir)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(jvm_path) or not fs.getFileStatus(jvm_path).isDirectory():
        raise FileNotFoundError(f"{zips_dir} is no folder")
    df = (spark.read.format("binaryFile").option("pathGlobFilter", "*.[zZ][iI][pP]")
          .option("recursiveFileLookup", "false").load(zips_dir))
    first = df.select("path").take(1)
    if not first:
        raise FileNotFoundError(f"{zips_dir} holds no zip archive")
    if read_content is None:
        read_content = not _pyarrow_readable(first[0]["path"])
    cols = ["path", srcdir_of("path").alias("srcdir"), "length"]
    if read_content:
        cols.insert(1, "content")
    return df.select(*cols)


def _archives(pdf):
    """(path, srcdir, ZipFile) for each archive row of a pandas batch."""
    has_content = "content" in pdf.columns
    for i in range(len(pdf)):
        srcdir = pdf["srcdir"].iat[i]
        if has_content and pdf["content"].iat[i] is not None:
            handle = io.BytesIO(pdf["content"].iat[i])
        else:
            handle = open_archive(pdf["path"].iat[i])
        with handle, zipfile.ZipFile(handle) as z:
            yield pdf["path"].iat[i], srcdir, z


def _source_cols(archives: DataFrame) -> list:
    return [c for c in ("path", "content", "srcdir") if c in archives.columns]


def _decode_archives(batches, batch_lines: int, members):
    for pdf in batches:
        for path, srcdir, z in _archives(pdf):
            names = set(z.namelist())
            for member in members:
                if member not in names:
                    continue
                for first, run in member_lines(z, member, batch_lines):
                    yield pd.DataFrame({"path": path, "srcdir": srcdir, "table": member.split(".")[0],
                                        "line_no": range(first, first + len(run)), "line": run})


def archive_lines(archives: DataFrame, batch_lines: int = 50_000, members=MEMBERS, paths: list | None = None) -> DataFrame:
    """(path, srcdir, table, line_no, line) for every line of the wanted members of the archives (of those in ``paths``);
    line 0 is the header (BOM removed).  Output leaves each task in Arrow batches of at most ``batch_lines`` lines.

    Archives listed by path are read by the data source, one task per (archive, member).  Where ``archives``
    carries their bytes, because only Spark can read the store, one task decodes one archive."""
    if "content" in archives.columns:
        if paths is not None:
            archives = archives.filter(F.col("path").isin(*paths))
        return archives.select(*_source_cols(archives)).mapInPandas(
            lambda it: _decode_archives(it, batch_lines, members), LINE_SCHEMA)
    if paths is None:
        paths = sorted(r["path"] for r in archives.select("path").collect())
    return (archive_reader(archives.sparkSession).option("paths", json.dumps(paths))
            .option("members", ",".join(members)).option("batchLines", batch_lines).load())


HEADER_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("srcdir", T.StringType()),
    T.StructField("table", T.StringType()),
    T.StructField("header_line", T.StringType()),
    T.StructField("has_rows", T.BooleanType()),
])


def _read_headers(batches, members):
    for pdf in batches:
        rows = []
        for path, srcdir, z in _archives(pdf):
            names = set(z.namelist())
            for member in members:
                if member not in names:
                    continue
                with z.open(member) as fh:
                    text = io.TextIOWrapper(fh, encoding="utf-8", errors="replace", newline="")
                    first = text.readline()
                    filled = any(line.strip("\r\n") for line in text)  # stops at the first row
                # an empty member is present but has no header (and loads nothing)
                rows.append((path, srcdir, member.split(".")[0], first.lstrip("\ufeff") if first else None, filled))
        yield pd.DataFrame(rows, columns=["path", "srcdir", "table", "header_line", "has_rows"])


def archive_headers(archives: DataFrame, members=MEMBERS) -> DataFrame:
    """(path, srcdir, table, header array, has_rows) per member present; only the zip
    directory and the first lines of each member are read.  An empty member has a NULL header."""
    return (archives.select(*_source_cols(archives))
            .mapInPandas(lambda it: _read_headers(it, members), HEADER_SCHEMA)
            .select("path", "srcdir", "table", "has_rows",
                    F.when(F.col("header_line").isNotNull(),
                           split_fields(clean_line("header_line"))).alias("header")))


# ------------------------------------------------------------------ A5 / A6
def rows_for_table(lines: DataFrame, headers: DataFrame, table: str, columns: list,
                   max_broadcast_rows: int = 100_000, keep: list | None = None, known: list | None = None) -> DataFrame:
    """Raw rows of one table with the union of all header columns.

    A column missing from an archive's header reads NULL for that archive's
    rows (schema evolution); short rows are padded with '' and long rows folded.
    The position of every output column in each archive's header is worked
    out once per archive (on the small header frame), so each line only
    indexes into its split fields.  ``known``: the header arrays themselves, where the caller has them: a column that has
    one place in all of them is read from there, and one that none has is NULL, without a look at the line's archive.
    """
    places = {c: {h.index(c) if c in h else None for h in known} for c in columns} if known else {}
    wanted = F.array(*[F.lit(c) for c in columns])
    # two archives may carry one srcdir: each line goes with the header of its own archive
    key = "path" if "path" in lines.columns else "srcdir"
    h = (headers.filter(F.col("table") == F.lit(table))
         .select(key, F.size("header").alias("_n"),
                 F.transform(wanted, lambda c: F.array_position(F.col("header"), c).cast("int")).alias("_pos")))
    h = broadcast_if_small(h, max_broadcast_rows, keep)
    body = (lines.filter((F.col("table") == F.lit(table)) & (F.col("line_no") > 0))
            .withColumn("_line", clean_line("line")).filter(F.col("_line") != F.lit("")))
    j = body.join(h, key, "inner")
    j = j.withColumn("_parts", normalize_fields(split_fields(F.col("_line")), F.col("_n")))
    cols = []
    for k, c in enumerate(columns):
        if len(places.get(c, ())) == 1:
            (place,) = places[c]
            cols.append((F.lit(None).cast("string") if place is None else F.col("_parts")[place]).alias(c))
            continue
        pos = F.col("_pos")[k]
        cols.append(F.when(pos > 0, F.element_at(F.col("_parts"), pos)).alias(c))
    return j.select(*cols, "srcdir")


# ------------------------------------------------------------------ A7 - A9
def landed_srcdirs(spark: SparkSession, out_root: str, table: str) -> set:
    """srcdirs of which a table holds rows."""
    return read_state(spark, out_root).srcdirs(table)


def land_archives(spark: SparkSession, zips_dir: str, out_root: str, mode: str = "append",
                  batch_lines: int = 50_000, read_content: bool | None = None,
                  rebalance: int | None = None, before_commit=None) -> dict:
    """Land every archive of ``zips_dir`` into ``out_root/{sub,num,tag}``.

    mode: 'append' adds rows, 'skip' leaves (table, srcdir) already landed
    untouched, 'replace' puts the rows it loads in the place of those of the same (table, srcdir).  All tables
    change at once, by one commit to the log; a landing that fails before leaves what was there.  Returns the
    srcdirs written per table.

    A zip member is one deflate stream, so it is inflated by one task.  When
    archives are fewer than cores or uneven in size (see ``line_partitions``),
    runs of decoded lines are spread over partitions before parsing and writing (one
    shuffle of the lines), so only the inflating stays on one core.  ``rebalance=N``
    spreads them over N partitions in any case, 0 never.  ``before_commit()`` is called when all rows are written
    and before they become visible; if it raises, nothing has changed.
    """
    return land_listed(list_archives(spark, zips_dir, read_content), out_root, mode, batch_lines, rebalance,
                       before_commit=before_commit)


TEXT_BYTES_PER_ZIP_BYTE = 8  # tab-separated facts deflate to about an eighth
LINE_PARTITION_BYTES = 128 << 20
LINES_PER_RUN = 1 << 18  # lines of one member that move together, some 30 MB


def line_partitions(lengths: list, cores: int) -> int:
    """Partitions over which the decoded lines of archives of these sizes are spread; 0 where
    one task per archive is even enough: at least as many archives as cores, none twice the mean."""
    total = sum(lengths)
    if not total or (len(lengths) >= cores and max(lengths) <= 2 * total / len(lengths)):
        return 0
    return max(cores, -(-total * TEXT_BYTES_PER_ZIP_BYTE // LINE_PARTITION_BYTES))


def _columns(table: str, rows: list) -> list:
    """The base columns of a table, then every other header column."""
    columns = list(RAW_BASE_COLUMNS[table])
    for r in rows:
        for c in r["header"] or ():
            if c != "srcdir" and c not in columns:
                columns.append(c)
    return columns


def _write_aside(spark: SparkSession, lines: DataFrame, load: list, table: str, out_root: str) -> dict:
    """Write the rows of one table below a folder of this load.  Returns {srcdir: folder below the root}."""
    columns = _columns(table, load)
    headers = spark.createDataFrame([(r["path"], table, r["header"]) for r in load],
                                    "path string, table string, header array<string>")
    folder = f"{table}/{LOAD}={uuid.uuid4().hex}"
    kept_sides: list = []
    rows = rows_for_table(lines, headers, table, columns, keep=kept_sides, known=[r["header"] for r in load])
    rows.write.partitionBy("srcdir").parquet(f"{out_root}/{folder}")
    for side in kept_sides:
        side.unpersist()
    names = [n for n in child_names(spark, f"{out_root}/{folder}") if n.startswith("srcdir=")]
    return {unquote(n[len("srcdir="):]): f"{folder}/{n}" for n in names}


def _outdone(state: LandingState, table: str, srcdir: str, path: str) -> bool:
    """Whether an archive of the same folder that comes behind ``path`` has delivered this (table, srcdir) before."""
    part = state.parts.get((table, srcdir))
    before = part.archive if part and part.archive else ""
    return before.rpartition("/")[0] == path.rpartition("/")[0] and before > path


def land_listed(archives: DataFrame, out_root: str, mode: str = "append", batch_lines: int = 50_000,
                rebalance: int | None = None, by_path: bool = False, before_commit=None) -> dict:
    """``land_archives`` for archives already listed (path, srcdir, perhaps content and length;
    without a length lines are spread only by an explicit ``rebalance``).

    Archives are taken in the order of their paths.  Where several carry one srcdir,
    'append' keeps the rows of all, 'replace' those of the last, 'skip' those of the
    first.  In 'replace' a member without rows leaves its (table, srcdir) empty.  ``by_path`` (for 'replace')
    holds this order over several calls too: an archive gives way to one of its folder that comes behind it by path
    and was landed before, as the log tells for each (table, srcdir)."""
    if mode not in ("append", "skip", "replace"):
        raise ValueError(f"unknown mode {mode}")
    spark, out_root = archives.sparkSession, out_root.rstrip("/")
    # one small row per archive member
    found = archive_headers(archives).collect()
    length = F.col("length") if "length" in archives.columns else F.lit(0)
    listed = archives.select("path", "srcdir", length.alias("length")).collect()
    by_name: dict = {r["path"]: (r["srcdir"], set()) for r in listed}
    sizes = {r["path"]: r["length"] for r in listed}
    for r in found:
        by_name[r["path"]][1].add(r["table"] + ".txt")
    for path in sorted(by_name):
        for m in MEMBERS:
            if m not in by_name[path][1]:
                log.warning("archive %s has no %s", by_name[path][0], m)
    state = read_state(spark, out_root)
    written, columns, loaded, jobs = {}, {}, [], []  # loaded: (table, srcdir, folder or None, archive)
    for member in MEMBERS:
        table = member.split(".")[0]
        rows = sorted((r for r in found if r["table"] == table), key=lambda r: r["path"])
        if mode == "skip":
            rows = [r for r in rows if r["srcdir"] not in state.srcdirs(table)]
        seen = rows
        if by_path:
            rows = [r for r in rows if not _outdone(state, table, r["srcdir"], r["path"])]
        if mode != "append":  # one archive per srcdir
            kept: dict = {}
            for r in rows:
                if mode == "replace" or (r["srcdir"] not in kept and r["header"] is not None and r["has_rows"]):
                    kept[r["srcdir"]] = r
            rows = list(kept.values())
        load = [r for r in rows if r["header"] is not None and r["has_rows"]]
        write = None
        if load:
            # one pass per table that decompresses only that member
            lines = archive_lines(archives, batch_lines, (member,), [r["path"] for r in load])
            spread = rebalance
            if spread is None:
                spread = line_partitions([sizes[r["path"]] for r in load], spark.sparkContext.defaultParallelism)
            if spread:
                # runs of lines stay together, so a task writes few partitions of the table
                lines = lines.repartition(spread, "path", F.floor(F.col("line_no") / LINES_PER_RUN))
            write = partial(_write_aside, spark, lines, load, table, out_root)
        # an archive that is replaced at once has still brought its columns; a skipped one is not looked into
        columns[table] = _columns(table, load if mode == "skip" else seen)
        jobs.append((table, {r["srcdir"]: r["path"] for r in rows}, write))
        written[table] = sorted({r["srcdir"] for r in load})
    # a task reads one member and they are few: the tables are written at once, so that no core waits for the last member
    # of one table before the next begins
    with ThreadPoolExecutor(len(MEMBERS)) as pool:
        begun = [(table, last, write and pool.submit(inheritable_thread_target(spark)(write))) for table, last, write in jobs]
    for table, last, write in begun:
        folders = write.result() if write else {}
        loaded += [(table, s, folders.get(s), p) for s, p in last.items() if mode == "replace" or s in folders]

    def change(state: LandingState) -> LandingState:
        for table, names in columns.items():
            state = state.with_columns(table, names)
        for table, srcdir, folder, path in loaded:
            there = state.parts.get((table, srcdir), Part(()))
            if (mode == "skip" and there.dirs) or (by_path and _outdone(state, table, srcdir, path)):
                continue  # another landing was faster
            new = (folder,) if folder else ()
            state = state.with_part(table, srcdir, Part(there.dirs + new if mode == "append" else new, path))
        return state
    if before_commit:
        before_commit()
    if loaded or any(r["header"] for r in found):
        commit(spark, out_root, change)
    return written


def read_landed(spark: SparkSession, out_root: str, table: str, version: int | None = None) -> DataFrame:
    """Landed raw table: all archives, every column seen so far (NULL where an archive had none).  Folders and columns
    come from the log, so no file is opened before the query runs.  A table no archive has
    delivered yet reads as empty with its base columns, as a freshly created raw table would.  ``version``
    reads an earlier state of the log."""
    root = out_root.rstrip("/")
    state = read_state(spark, root, version)
    columns = state.columns.get(table) or RAW_BASE_COLUMNS.get(table, ())
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, "srcdir"]])
    dirs = state.dirs(table)
    if not dirs:
        return spark.createDataFrame([], schema)
    whole = T.StructType([*schema.fields[:-1], T.StructField(LOAD, T.StringType()), schema.fields[-1]])
    return (spark.read.schema(whole).option("basePath", f"{root}/{table}")
            .parquet(*[f"{root}/{d}" for d in dirs]).select(*schema.names))


class LandedRaw:
    """Raw relations from landed Parquet plus seed CSVs (same interface as DriverRaw)."""

    def __init__(self, spark: SparkSession, out_root: str, seeds: dict | None = None):
        self.spark, self.root, self.seeds = spark, out_root, seeds or {}

    @property
    def sub(self):
        return read_landed(self.spark, self.root, "sub")

    @property
    def num(self):
        return read_landed(self.spark, self.root, "num")

    @property
    def tag(self):
        return read_landed(self.spark, self.root, "tag")

    @property
    def esg_risk_factors(self):
        return self.seeds["esg_risk_factors"]

    @property
    def isin_cik(self):
        return self.seeds["isin_cik"]
