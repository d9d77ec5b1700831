"""Best-fit packing of tokenised documents into sequences of a fixed length, in
bulk-synchronous rounds.

A round range-sorts the unplaced pieces together with the gaps of the open sequences, the
largest first.  Every range is swept: a piece goes to its successor among the gaps met
so far (the smallest that holds it), and the gap shrinks.  Pieces left over have successors only in
ranges of larger sizes; those are dealt out by rank, the largest piece to the smallest
gap, from the numbers of pieces and gaps that each range has left.  Pieces that no gap held in
the round before, and that are longer than half of the longest such piece, open sequences when the next
round finds no gap either.  Rounds repeat until no piece is left; the longest piece left halves each time.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import check_columns, written
from .tokens import word_ids

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
END_ID = 0
SWEEP_ROWS = 200_000  # pieces and gaps that a task sweeps
SMALL = 32  # pieces of at most this length open sequences without another halving
BATCH_BYTES = 8_000_000  # bytes of text that are encoded at once

_PIECES = "doc_id {id_type}, uid long, piece int, start long, length long, ids_crc32 long"
_SWEPT = "what int, id long, size int, seq long, offset int, part int, rank long"
PLACED, GAP, LEFT = 0, 1, 2


def _piece_rows(tokenizer: str, capacity: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, made = word_ids(tokenizer), TaskContext.get().partitionId() << 40
        end = END_ID.to_bytes(4, "little")
        for batch in batches:
            texts, at = batch.column("text"), 0
            size = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(), dtype=np.int64)
            while at < len(texts):
                before = size[at - 1] if at else 0
                stop = max(at + 1, int(np.searchsorted(size, before + BATCH_BYTES, "right")))
                begins, known = ids.of(texts.slice(at, stop - at))
                doc, piece, start, length, crc = [], [], [], [], []
                for i, (lo, hi) in enumerate(zip(begins[:-1].tolist(), begins[1:].tolist()), at):
                    own = bytes(known[lo:hi]) + end
                    for k, s in enumerate(range(0, len(own), 4 * capacity)):
                        part = own[s:s + 4 * capacity]
                        doc.append(i)
                        piece.append(k)
                        start.append(s // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(doc, pa.int64())),
                     pa.array(range(made, made + len(doc)), pa.int64()), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    ["doc_id", "uid", "piece", "start", "length", "ids_crc32"])
                made += len(doc)
                at = stop
    return rows


def document_pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, uid, piece, start, length, ids_crc32 of every piece; ``uid`` numbers them without order."""
    return docs.select("doc_id", "text").mapInArrow(
        _piece_rows(tokenizer, capacity), _PIECES.format(id_type=dict(docs.dtypes)["doc_id"]))


class Gaps:
    """Open sequences by the room they have."""

    def __init__(self):
        self.rooms, self.by_room = [], {}

    def add(self, room: int, seq: int) -> None:
        if room not in self.by_room:
            insort(self.rooms, room)
            self.by_room[room] = []
        self.by_room[room].append(seq)

    def successor(self, size: int) -> tuple[int, int] | None:
        """Take the smallest gap of ``size`` or more: (room, sequence)."""
        k = bisect_left(self.rooms, size)
        if k == len(self.rooms):
            return None
        room = self.rooms[k]
        seqs = self.by_room[room]
        seq = seqs.pop()
        if not seqs:
            del self.rooms[k], self.by_room[room]
        return room, seq


def _sweep(capacity: int, open_above: int):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, gaps, left, least = TaskContext.get().partitionId(), Gaps(), 0, 0
        columns = ["what", "id", "size", "seq", "offset", "part", "rank"]
        for pdf in batches:
            out = []
            for is_piece, own, size, tried in zip(pdf["is_piece"].tolist(), pdf["id"].tolist(), pdf["size"].tolist(),
                                                  pdf["tried"].tolist()):
                least = size
                if not is_piece:
                    gaps.add(size, own)
                    continue
                room, seq = gaps.successor(size) or (0, 0)
                if not room and tried and size > open_above:
                    room, seq = capacity, own
                if room:
                    out.append((PLACED, own, size, seq, capacity - room, part, -1))
                    if room > size:
                        gaps.add(room - size, seq)
                else:
                    out.append((LEFT, own, size, -1, -1, part, left))
                    left += 1
            yield pd.DataFrame(out, columns=columns)
        # the gaps as large as the smallest row of this range hold any piece of the ranges behind it
        out, rank = [], 0
        for room in reversed(gaps.rooms):
            for seq in gaps.by_room[room]:
                out.append((GAP, seq, room, -1, -1, part, rank if room >= least else -1))
                rank += 1
        yield pd.DataFrame(out, columns=columns)
    return rows


def deal(ranges: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Runs (range of pieces, its first rank, range of gaps, its last rank, how many) from (range, pieces left,
    gaps left) in order of falling size.  A range's pieces take the smallest gaps of the ranges before it: the
    first piece of a run goes with the last gap of it, the second with the last but one."""
    stack, out = [], []
    for part, pieces, gaps in ranges:
        first = 0
        while first < pieces and stack:
            at, high = stack.pop()
            n = min(high, pieces - first)
            out.append((part, first, at, high - 1, n))
            first += n
            if high > n:
                stack.append((at, high - n))
        if gaps:
            stack.append((part, gaps))
    return out


def _round(state: DataFrame, n: int, capacity: int, open_above: int):
    """One round over (is_piece, id, size, tried).  Returns (placed, next state, pieces left, the longest of them)."""
    spark = state.sparkSession
    order = [F.col("size").desc(), F.col("is_piece"), F.col("id")]
    swept = written(state.repartitionByRange(-(-n // SWEEP_ROWS), *order).sortWithinPartitions(*order)
                    .mapInPandas(_sweep(capacity, open_above), _SWEPT), "packing-swept")
    is_left, usable = F.col("what") == LEFT, (F.col("what") == GAP) & (F.col("rank") >= 0)
    ranges = swept.groupBy("part").agg(
        F.count(F.when(is_left, 1)).alias("pieces"), F.count(F.when(usable, 1)).alias("gaps"),
        F.max(F.when(is_left, F.col("size"))).alias("longest"), F.count(F.when(F.col("what") == GAP, 1)).alias("open"))
    ranges = sorted(ranges.collect(), key=lambda r: r["part"])
    runs = deal([(r["part"], r["pieces"], r["gaps"]) for r in ranges])
    met: dict[int, int] = {}
    for part, *_, k in runs:
        met[part] = met.get(part, 0) + k
    rest = [r for r in ranges if r["pieces"] > met.get(r["part"], 0)]
    left = sum(r["pieces"] - met.get(r["part"], 0) for r in rest)
    longest = max((r["longest"] for r in rest), default=0)

    placed = swept.filter(F.col("what") == PLACED).select(F.col("id").alias("uid"), "seq", "offset")
    pieces, gaps = swept.filter(is_left), swept.filter(F.col("what") == GAP)
    if runs:  # at most two runs a range
        dealt = spark.createDataFrame(runs, "part int, first long, gap_part int, last long, k long")
        to = F.broadcast(dealt)
        pieces = pieces.join(to, (pieces["part"] == to["part"]) & (F.col("rank") >= F.col("first"))
                             & (F.col("rank") < F.col("first") + F.col("k")), "left").select(
            "id", "size", F.col("gap_part").alias("at"), (F.col("last") - (F.col("rank") - F.col("first"))).alias("nth"))
        of = F.broadcast(dealt.select(F.col("gap_part").alias("of_part"), "last", "k"))
        gaps = gaps.join(of, (F.col("part") == F.col("of_part")) & (F.col("rank") <= F.col("last"))
                         & (F.col("rank") > F.col("last") - F.col("k")), "left").select(
            "id", "size", F.col("of_part").alias("at"), F.col("rank").alias("nth"))
        taken = gaps.filter("at is not null").select(F.col("id").alias("seq"), F.col("size").alias("room"), "at", "nth")
        matched = written(pieces.filter("at is not null").join(taken, ["at", "nth"]), "packing-matched")
        placed = placed.union(matched.select(F.col("id").alias("uid"), "seq",
                                             (F.lit(capacity) - F.col("room")).alias("offset")))
        pieces, gaps = pieces.filter("at is null"), gaps.filter("at is null").select("id", "size").union(
            matched.select("seq", (F.col("room") - F.col("size")).alias("size")).filter("size > 0"))
    state = (gaps.select(F.lit(0).alias("is_piece"), "id", "size", F.lit(False).alias("tried"))
             .union(pieces.select(F.lit(1), "id", "size", F.lit(True))))
    return placed, state, left, longest, left + sum(r["open"] for r in ranges)


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(uid, sequence_id, offset) of pieces (uid, length) shorter than the capacity."""
    state = pieces.select(F.lit(1).alias("is_piece"), F.col("uid").alias("id"), F.col("length").cast("int").alias("size"),
                          F.lit(True).alias("tried"))
    left = n = state.count()
    open_above, placed = capacity // 2, None
    while left:
        own, state, left, longest, n = _round(state, n, capacity, open_above)
        placed = own if placed is None else placed.union(own)
        open_above = longest // 2 if longest > SMALL else 0
    if placed is None:
        return pieces.select("uid", F.col("uid").alias("sequence_id"), F.lit(0).cast("long").alias("offset")).limit(0)
    return placed.select("uid", F.col("seq").alias("sequence_id"), F.col("offset").cast("long").alias("offset"))


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document.

    A document is the ids of its text and an end id; a null or empty text is the end id alone.
    Documents longer than ``capacity`` are cut into pieces of that length, the last may be shorter.
    Repeated rows and null ids are packed like others, an empty table gives no rows, other columns are ignored.
    ``sequence_id`` is the number of the piece that opened the sequence; pieces fill it from 0 without holes."""
    check_columns(docs, doc_id="any", text="string")
    pieces = written(document_pieces(docs, capacity, tokenizer), "pieces")
    whole, short = pieces.filter(F.col("length") == capacity), pieces.filter(F.col("length") < capacity)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return (short.join(place(short.select("uid", "length"), capacity), "uid").select(*columns)
            .union(whole.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("uid").alias("sequence_id"),
                                F.lit(0).cast("long").alias("offset"))))
