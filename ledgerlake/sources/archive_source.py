"""Lines of zip archives as a Spark data source.

    spark.dataSource.register(FilingArchives)
    spark.read.format("filing_archives").load("zips/").filter("srcdir = '2019q4' and table = 'num'")

Every (archive, member) is one partition.  Filters on ``srcdir``, ``table`` and ``path`` by equality or ``in`` are
taken into the planning: an archive that they rule out is never opened.  Planning lists the folder and opens
nothing; a task opens its archive as a seekable file and streams one member.
"""

from __future__ import annotations

import io
import json
import re
import zipfile
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

MEMBERS = ("sub.txt", "num.txt", "tag.txt")
SOURCE = "filing_archives"
BATCH_LINES = 50_000
COLUMNS = pa.schema([("path", pa.string()), ("srcdir", pa.string()), ("table", pa.string()),
                     ("line_no", pa.int64()), ("line", pa.string())])


def srcdir_name(path: str) -> str:
    """File name up to the first dot."""
    return re.search(r"([^/]+?)(\.[^/]*)?$", path)[1]


def local_path(path: str) -> str | None:
    """The local file of a path as Spark writes it (``file:`` in front, nothing escaped); None for other stores."""
    if path.startswith("file:"):
        return "/" + path[len("file:"):].lstrip("/")
    return path if path.startswith("/") else None


def open_archive(path: str):
    """Seekable handle on an archive."""
    if (local := local_path(path)) is not None:
        return open(local, "rb")
    import pyarrow.fs as pafs
    fs, inner = pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return fs.open_input_file(inner)


def list_folder(folder: str) -> list[str]:
    """Paths of the zip archives in a folder, in order."""
    import pyarrow.fs as pafs
    if (local := local_path(folder)) is not None:
        fs, inner = pafs.LocalFileSystem(), local
    else:
        fs, inner = pafs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))
    names = [f.base_name for f in fs.get_file_info(pafs.FileSelector(inner)) if f.type == pafs.FileType.File]
    return [f"{folder.rstrip('/')}/{n}" for n in sorted(names) if n.lower().endswith(".zip")]


def member_lines(z: zipfile.ZipFile, member: str, batch_lines: int) -> Iterator[tuple[int, list[str]]]:
    """(number of the first line, lines) of a member in runs of at most ``batch_lines``; the byte order mark is dropped."""
    with z.open(member) as fh:
        text = io.TextIOWrapper(fh, encoding="utf-8", errors="replace", newline="")
        first, run = 0, []
        for line in text:
            run.append(line if first or run else line.lstrip("\ufeff"))
            if len(run) >= batch_lines:
                yield first, run
                first, run = first + len(run), []
        if run:
            yield first, run


BLOCK_BYTES = 4 << 20  # inflated at a time
BOM = "\ufeff".encode("utf-8")


def _line_array(text: bytes) -> pa.Array:
    """Lines of a text with their ends (``\\n``, ``\\r\\n`` or ``\\r``), over the text's own bytes."""
    try:
        text.decode("utf-8")
    except UnicodeDecodeError:
        text = text.decode("utf-8", "replace").encode("utf-8")
    chars = np.frombuffer(text, np.uint8)
    end = chars == 10
    if b"\r" in text:
        alone = chars == 13
        alone[:-1] &= ~end[1:]
        end |= alone
    offsets = np.concatenate([[0], np.flatnonzero(end) + 1]).astype(np.int32)
    if offsets[-1] != len(text) or len(offsets) == 1:
        offsets = np.append(offsets, np.int32(len(text)))
    return pa.Array.from_buffers(pa.string(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(text)])


def member_line_arrays(z: zipfile.ZipFile, member: str, batch_lines: int) -> Iterator[tuple[int, pa.Array]]:
    """``member_lines`` with runs as Arrow arrays, cut from whole blocks of text without a step per line."""
    with z.open(member) as fh:
        first, start, parts = 0, True, []
        while True:
            block = fh.read(BLOCK_BYTES)
            cut = block.rfind(b"\n") + 1
            if block and not cut:
                parts.append(block)
                continue
            text = b"".join([*parts, block[:cut]])
            parts = [block[cut:]]
            if text:
                if start:
                    while text.startswith(BOM):
                        text = text[len(BOM):]
                    start = False
                lines = _line_array(text)
                for i in range(0, len(lines), batch_lines):
                    run = lines.slice(i, batch_lines)
                    yield first, run
                    first += len(run)
            if not block:
                return


@dataclass
class ArchiveMember(InputPartition):
    path: str
    member: str

    def __init__(self, path: str, member: str):
        self.path, self.member = path, member


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict):
        if "paths" in options:
            self.paths, self.folder = json.loads(options["paths"]), None
        elif options.get("path"):
            self.paths, self.folder = None, options["path"]
        else:
            raise ValueError(f"{SOURCE} needs a folder or the option 'paths'")
        self.members = [m for m in options.get("members", ",".join(MEMBERS)).split(",") if m]
        self.batch_lines = int(options.get("batchLines", BATCH_LINES))
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            values = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            if values is None or len(f.attribute) != 1 or f.attribute[0] not in ("srcdir", "table", "path"):
                yield f
                continue
            column = f.attribute[0]
            self.wanted[column] = self.wanted.get(column, values) & values

    def _wants(self, column: str, value: str) -> bool:
        return column not in self.wanted or value in self.wanted[column]

    def partitions(self) -> list[ArchiveMember]:
        paths = self.paths if self.paths is not None else list_folder(self.folder)
        return [ArchiveMember(p, m) for p in paths if self._wants("path", p) and self._wants("srcdir", srcdir_name(p))
                for m in self.members if self._wants("table", m.split(".")[0])]

    def read(self, partition: ArchiveMember) -> Iterator[pa.RecordBatch]:
        if not isinstance(partition, ArchiveMember):  # nothing was planned
            return
        table, srcdir = partition.member.split(".")[0], srcdir_name(partition.path)
        with open_archive(partition.path) as handle, zipfile.ZipFile(handle) as z:
            if partition.member not in z.namelist():
                return
            for first, run in member_line_arrays(z, partition.member, self.batch_lines):
                n = len(run)
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(partition.path, n), pa.repeat(srcdir, n), pa.repeat(table, n),
                     pa.array(np.arange(first, first + n)), run], schema=COLUMNS)


class FilingArchives(DataSource):
    """path, srcdir, table, line_no, line of every line of the members ``sub.txt``, ``num.txt`` and ``tag.txt``
    (or of those that the option ``members`` names) of the archives of a folder, or of those that the option
    ``paths`` lists as JSON."""

    @classmethod
    def name(cls) -> str:
        return SOURCE

    def schema(self) -> str:
        return "path string, srcdir string, table string, line_no long, line string"

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options)


def archive_reader(spark: SparkSession):
    """``spark.read`` for the source, with filters taken into its planning."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(FilingArchives)
    return spark.read.format(SOURCE)
