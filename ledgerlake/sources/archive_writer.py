"""Zip archives from lines: the inverse of ``landing.archive_lines``.

One task writes one archive, because an archive is one file.  Lines travel to it packed: each task that
makes lines joins them to runs of one (archive, member, position) and deflates them, so the
shuffle moves and sorts a few packed runs instead of every line, and the writer holds one run at
a time.  The file gets its name only when it is whole, so a repeated task attempt leaves no torn
archive behind.
"""

from __future__ import annotations

import zipfile
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _file_system(root: str):
    """pyarrow file system and the folder's path in it."""
    import pyarrow.fs as pafs
    if root.startswith("file:"):
        root = "/" + root[len("file:"):].lstrip("/")
    if root.startswith("/"):
        return pafs.LocalFileSystem(), root
    return pafs.FileSystem.from_uri(root.replace("s3a://", "s3://", 1))


WRITERS_PER_CORE = 8  # so that few archives share a partition by chance
RUN_BYTES = 4 << 20  # text of a packed run
DEFLATE_LEVEL = 1  # one task deflates an archive, and this is most of its time
OPEN_RUNS = 256  # runs a task fills at once
PACKED = pa.schema([("archive", pa.string()), ("member", pa.string()), ("position", pa.int32()), ("run", pa.binary())])


class _Run:
    """Lines of one (archive, member, position), deflated as they come."""

    def __init__(self):
        self.parts, self.size, self.deflate = [], 0, zlib.compressobj(DEFLATE_LEVEL)

    def add(self, text) -> None:
        self.parts.append(self.deflate.compress(text))
        self.size += len(text)

    def packed(self) -> bytes:
        return b"".join([*self.parts, self.deflate.flush()])


def _pack(batches):
    """(archive, member, position, run) of lines in any order; a NULL line adds nothing to its run."""
    runs: dict = {}

    def emit(keys):
        for key in keys:
            yield pa.RecordBatch.from_pylist([dict(zip(PACKED.names, (*key, runs.pop(key).packed())))], PACKED)

    for batch in batches:
        archive, member, position, line = (batch.column(c) for c in PACKED.names[:3] + ["line"])
        place = pc.binary_join_element_wise(archive, member, position.cast(pa.string()), "\0").dictionary_encode().indices
        order = np.argsort(place.to_numpy(), kind="stable")
        starts = np.flatnonzero(np.diff(place.to_numpy()[order], prepend=-1))
        ended = pc.fill_null(pc.binary_join_element_wise(line.take(pa.array(order)), "", "\n"), "")
        ends = np.frombuffer(ended.buffers()[1], np.int32)[ended.offset:ended.offset + len(ended) + 1]
        text = memoryview(ended.buffers()[2] or b"")  # the lines of a run lie one behind the other
        for i, j in zip(starts, [*starts[1:], len(order)]):
            at = int(order[i])
            key = (archive[at].as_py(), member[at].as_py(), position[at].as_py())
            if key not in runs:
                if len(runs) >= OPEN_RUNS:
                    yield from emit(list(runs))
                runs[key] = _Run()
            runs[key].add(text[ends[i]:ends[j]])
            if runs[key].size >= RUN_BYTES:
                yield from emit([key])
    yield from emit(list(runs))


def _write(batches, root: str):
    fs, folder = _file_system(root)
    attempt = TaskContext.get().taskAttemptId()
    archive = member = sink = zipped = entry = None

    def finish():
        entry.close()
        zipped.close()
        sink.close()
        fs.move(f"{folder}/_{archive}.{attempt}", f"{folder}/{archive}")

    for batch in batches:
        for a, m, run in zip(*(batch.column(c) for c in ("archive", "member", "run"))):
            a, m = a.as_py(), m.as_py()
            if a != archive:
                if archive is not None:
                    finish()
                archive, member = a, None
                fs.create_dir(folder, recursive=True)
                sink = fs.open_output_stream(f"{folder}/_{archive}.{attempt}")
                zipped = zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED, compresslevel=DEFLATE_LEVEL)
            if m != member:
                if member is not None:
                    entry.close()
                member = m
                entry = zipped.open(member, "w", force_zip64=True)
            entry.write(zlib.decompress(run.as_py()))
        yield batch.slice(0, 0).select(["archive"])
    if archive is not None:
        finish()


def member_lines(rows: DataFrame, archive, member: str, columns: list, with_rows: bool = True) -> DataFrame:
    """Lines of one member per archive: a header, then the rows as tab-separated text (NULL as '')."""
    keyed = rows.withColumn("archive", archive)
    head = keyed.select("archive").distinct().select(
        "archive", F.lit(member).alias("member"), F.lit(0).alias("position"), F.lit("\t".join(columns)).alias("line"))
    if not with_rows:
        return head
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return head.unionByName(keyed.select("archive", F.lit(member).alias("member"), F.lit(1).alias("position"),
                                         F.concat_ws("\t", *fields).alias("line")))


def write_archives(lines: DataFrame, root: str) -> None:
    """Write (archive, member, position, line) as ``root/<archive>``; lines come in the order of
    their position, a NULL line alone makes an empty member."""
    packed = lines.select("archive", "member", F.col("position").cast("int").alias("position"), "line").mapInArrow(
        _pack, "archive string, member string, position int, run binary")
    # a number of partitions keeps small archives from being gathered in one task
    (packed.repartition(WRITERS_PER_CORE * lines.sparkSession.sparkContext.defaultParallelism, "archive").sortWithinPartitions("archive", "member", "position")
     .mapInArrow(lambda it: _write(it, root), "archive string").write.format("noop").mode("overwrite").save())
