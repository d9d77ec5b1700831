"""Removal of long repeated byte strings with suffix arrays.

A byte goes when it lies in a string of ``length`` bytes that starts anywhere
else too.  The work is divided so that every pair of equal strings meets in one
shard:

1. Each string of ``length`` bytes owns one of its 64-byte substrings, the one
   with the smallest hash (leftmost among equals), its *anchor*.  Equal strings
   own equal anchors.  The consecutive strings that own one anchor make up a
   *context* of a few hundred bytes; contexts divide all strings of a text.
2. Anchors are counted by hash.  Contexts whose anchor occurs only once in the
   corpus hold no repeated string and stay where they are.
3. The other contexts, each different one once, are dealt to shards by anchor.
   Every shard builds a suffix array by Larsson-Sadakane refinement and the
   common prefixes of neighbours by Kasai's method, vectorised over contexts.
   Runs of common prefixes of ``length`` bytes are the repeated strings.
4. An anchor with more contexts than a shard may hold is spread over several
   shards.  Their sorted strings are merged by ranges: every string finds its
   range by binary search over the range bounds, and equal strings meet there.

Texts that occur as whole copies are counted by digest beforehand.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import check_columns, written

LENGTH = 200
ANCHOR = 64
SHARD_CONTEXTS = 4_000  # contexts in a shard on average: about 1 MB of text
LARGE = 2  # an anchor with more than so many times that is spread over shards
PIECE = 1 << 22  # bytes of a text that are hashed at once

_BYTE_HASH = np.random.RandomState(7).randint(0, 2 ** 63, 256).astype(np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = 0x2545F4914F6CDD1D


def _gram_hashes(b: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k-byte substring; k is a power of two."""
    h, step, power = _BYTE_HASH[b], 1, _STEP
    while step < k:
        h = h[:-step] * np.uint64(power) + h[step:]
        power = power * power % (1 << 64)
        step *= 2
    h = h * _MIX
    h ^= h >> np.uint64(32)
    h *= _MIX
    return h ^ (h >> np.uint64(29))


def contexts(raw: bytes, length: int = LENGTH, k: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first string, end of strings) of the contexts of a text, in order.
    Long texts are hashed in overlapping pieces; a cut between two pieces may divide a
    context, which leaves every string in one."""
    n = len(raw) - length + 1  # strings
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    hashes, starts, w = [], [], length - k + 1
    for first in range(0, n, PIECE):
        b = np.frombuffer(raw, np.uint8, count=min(PIECE + length - 1, len(raw) - first), offset=first)
        h = _gram_hashes(b, k)
        best, step = h, 1  # smallest hash of the substrings of each string
        while 2 * step <= w:
            best = np.minimum(best[:-step], best[step:])
            step *= 2
        if step < w:
            best = np.minimum(best[:step - w], best[w - step:])
        new = np.ones(len(best), bool)
        # the anchor's place changes with its hash, and after the string that starts with it
        np.logical_or(best[1:] != best[:-1], best[:-1] == h[:len(best) - 1], out=new[1:])
        new = np.flatnonzero(new)
        hashes.append(best[new])
        starts.append(new + first)
    start = np.concatenate(starts)
    return np.concatenate(hashes), start, np.append(start[1:], n)


# ---- suffix arrays ---------------------------------------------------------------------------------------------

def _sort_groups(group: np.ndarray, after: np.ndarray, place: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in order of (group, after, place), and where (group, after) changes."""
    fresh = np.ones(len(place), bool)
    if 3 * bits <= 63:  # one integer holds all three
        key = group.astype(np.int64)
        key <<= bits
        key |= after
        key <<= bits
        key |= place
        key.sort()
        place = (key & ((1 << bits) - 1)).astype(np.int32)
        key >>= bits
        np.not_equal(key[1:], key[:-1], out=fresh[1:])
        return place, fresh
    key = (group.astype(np.int64) << 32) | after  # places of a group are in order already
    order = np.argsort(key, kind="stable")
    fresh[1:] = np.diff(key[order]) != 0
    return place[order], fresh


def _unsettled(fresh: np.ndarray) -> np.ndarray:
    """Members of groups of several, where ``fresh`` marks the first of each group."""
    several = ~fresh
    several[:-1] |= ~fresh[1:]
    return several


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffix array of ``text`` by Larsson-Sadakane refinement: suffixes are sorted by
    their first 4 bytes, then groups of equal ones are refined by the rank ``h`` places
    on, with h doubling, until every group is single or ``depth`` bytes are compared.
    Suffixes equal to that depth stay in text order."""
    n = len(text)
    if not n:
        return np.empty(0, np.int32)
    bits = (n + 1).bit_length()
    wide = np.zeros(n + 4, np.int64)
    wide[:n] = text
    wide[:n] += 1  # 0 is the end of the text
    first = ((wide[:n] * 257 + wide[1:n + 1]) * 257 + wide[2:n + 2]) * 257 + wide[3:n + 3]
    sa, fresh = (_sort_groups(np.zeros(n, np.int32), first, np.arange(n), bits) if 3 * bits > 63 else
                 _sort_first(first, bits))
    slots = np.arange(n, dtype=np.int32)  # places in sa
    rank = np.zeros(n + 1, np.int32)  # 1 + place in sa of the first of the group; 0 is the end of the text
    open_, s, h = slots, sa, 4
    while True:
        # a group is named by the place of its first member
        rank[s] = np.repeat(open_[fresh] + 1, np.diff(np.append(np.flatnonzero(fresh), len(s))))
        more = _unsettled(fresh)
        open_, s = open_[more], s[more]
        if h >= depth or not len(open_):
            return sa
        s, fresh = _sort_groups(rank[s], rank[np.minimum(s + np.int32(h), np.int32(n))], s, bits)
        sa[open_] = s
        h *= 2


def _sort_first(first: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    key = first << bits
    key |= np.arange(len(first))
    key.sort()
    fresh = np.ones(len(key), bool)
    place = (key & ((1 << bits) - 1)).astype(np.int32)
    key >>= bits
    np.not_equal(key[1:], key[:-1], out=fresh[1:])
    return place, fresh


def common_prefixes(text: np.ndarray, sa: np.ndarray, start: np.ndarray, size: np.ndarray, cap: int) -> np.ndarray:
    """Common prefix (at most ``cap``) of each suffix in ``sa`` with the one before.
    ``sa``: the suffixes at the first ``size`` places from each ``start``, sorted.
    Kasai's method: if the suffix after the predecessor is there too, the next one
    starts from one less than the last found, else from nothing.  All runs of places
    walk side by side, and bytes are compared eight at a time."""
    n = len(text)
    before = np.full(n + 1, -1, np.int32)
    before[sa[1:]] = sa[:-1]
    there = np.zeros(n + 1, bool)
    there[sa] = True
    wide = np.zeros(n + cap + 16, np.uint64)
    wide[:n] = text
    eight = wide[:-7].copy()
    for i in range(1, 8):
        eight |= wide[i:len(wide) - 7 + i] << np.uint64(8 * i)
    bytes_of = [np.uint64((1 << 8 * i) - 1) for i in range(1, 8)]
    found = np.zeros(n, np.int32)
    order = np.argsort(-size, kind="stable")
    start, size = start[order], size[order]
    known, after = np.zeros(len(start), np.int64), np.full(len(start), -1)
    for t in range(int(size[0]) if len(size) else 0):
        live = int(np.searchsorted(-size, -t, side="left"))
        p = start[:live] + t
        q = before[p].astype(np.int64)
        # of two suffixes equal beyond the sorted depth either may come first: then only the
        # very suffix after the last predecessor is known to share the rest
        l = np.where((q < 0) | ((known[:live] == cap - 1) & (q != after[:live])), 0, known[:live])
        act = np.flatnonzero((q >= 0) & (l < cap))
        while len(act):
            x = eight[p[act] + l[act]] ^ eight[q[act] + l[act]]
            same = x == 0
            end = act[~same]
            x = x[~same]
            for low in bytes_of:
                l[end] += (x & low) == 0
            act = act[same]
            l[act] += 8
            act = act[l[act] < cap]
        l = np.minimum(l, np.minimum(cap, n - np.maximum(p, q)))
        found[p] = l
        known, after = np.where(there[q + 1], np.maximum(l - 1, 0), 0), q + 1
    return found[sa]


def repeated_groups(parts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix array over the contexts ``parts``.  For every string that a context owns:
    (context number, offset, group); strings with one group are equal."""
    size = np.array([len(x) for x in parts], np.int64)
    start = np.cumsum(size) - size
    text = np.frombuffer(b"".join(parts), np.uint8)
    which = np.repeat(np.arange(len(parts), dtype=np.int32), size)
    offset = (np.arange(len(text)) - start[which]).astype(np.int32)
    tail = (size[which] - offset).astype(np.int32)
    sa = suffix_array(text, length)
    sa = sa[tail[sa] >= length]
    group = np.cumsum(common_prefixes(text, sa, start, size - length + 1, length) < length)
    return which[sa], offset[sa], group


def _ranges(offsets: np.ndarray) -> list[int]:
    """Sorted offsets as a flat list of [first, end) pairs."""
    cut = np.flatnonzero(np.diff(offsets) > 1)
    first = offsets[np.concatenate([[0], cut + 1])]
    end = offsets[np.concatenate([cut, [len(offsets) - 1]])] + 1
    return np.column_stack([first, end]).ravel().astype(np.int32).tolist()


def _marked(parts_id, context: np.ndarray, offset: np.ndarray) -> pd.DataFrame:
    """Rows (class, ranges) of the marked strings."""
    order = np.lexsort((offset, context))
    context, offset = context[order], offset[order]
    cut = np.flatnonzero(np.diff(context)) + 1
    rows = [(parts_id[c[0]], _ranges(o)) for c, o in zip(np.split(context, cut), np.split(offset, cut)) if len(c)]
    return pd.DataFrame(rows, columns=["class", "ranges"])


# ---- Spark stages ----------------------------------------------------------------------------------------------

def _raw(text) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _text_key(raw: bytes) -> tuple[int, int]:
    """96 bits of a text's digest, as a long and an int."""
    d = hashlib.md5(raw).digest()
    return int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:12], "big")


def _anchor_rows(length: int):
    """(anchor, text_key, spot): every context of every text.  ``spot`` holds 32 more bits
    of the text key and the number of the context in its text."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            anchor, key, spot = [], [], []
            for text in pdf["text"]:
                raw = _raw(text)
                h, _, _ = contexts(raw, length)
                if len(h):
                    a, b = _text_key(raw)
                    anchor.append(h.view(np.int64))
                    key.append(np.full(len(h), a))
                    spot.append(((np.uint64(b) << np.uint64(32)) | np.arange(len(h)).astype(np.uint64)).view(np.int64))
            if anchor:
                yield pd.DataFrame({"anchor": np.concatenate(anchor), "text_key": np.concatenate(key),
                                    "spot": np.concatenate(spot)})
    return rows


def _context_rows(length: int):
    """(class, anchor, context, sign, text_key, key2, first): the listed contexts of a text."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for text, key, key2, places in zip(pdf["text"], pdf["text_key"], pdf["key2"], pdf["places"]):
                raw = _raw(text)
                h, start, end = contexts(raw, length)
                at = np.unique(np.asarray(places, np.int64))
                for a, s, e in zip(h[at].view(np.int64), start[at], end[at]):
                    part = raw[s:e + length - 1]
                    out.append((hashlib.blake2b(part, digest_size=16).digest(), a, part, key, key2, s))
                if len(out) > 20_000:
                    yield pd.DataFrame(out, columns=["class", "anchor", "context", "text_key", "key2", "first"])
                    out = []
            yield pd.DataFrame(out, columns=["class", "anchor", "context", "text_key", "key2", "first"])
    return rows


def _key_columns(df: DataFrame, raw="_raw") -> list:
    digest = F.md5(F.col(raw))
    signed = F.conv(F.substring(digest, 1, 16), 16, -10).cast("long")
    return [signed.alias("text_key"), F.conv(F.substring(digest, 17, 8), 16, 10).cast("long").alias("key2")]


def repeated_ranges(docs: DataFrame, length: int = LENGTH, shard_contexts: int = SHARD_CONTEXTS) -> tuple[DataFrame, DataFrame]:
    """(texts, ranges).  ``texts``: (text_key, key2, text) of the texts that hold an anchor
    that occurs elsewhere.  ``ranges``: (text_key, key2, firsts, ranges), for those texts the places
    of the strings that start elsewhere too."""
    spark = docs.sparkSession
    schema = "anchor long, text_key long, spot long"
    anchors = docs.select("text").filter(F.octet_length("text") >= length).mapInPandas(_anchor_rows(length), schema)
    # copies of one text have equal (text_key, spot): an anchor is of interest with two different ones
    sign = F.xxhash64("text_key", "spot")
    several = (anchors.groupBy("anchor").agg(F.min(sign).alias("low"), F.max(sign).alias("high"))
               .filter("low <> high").select("anchor"))
    wanted = (anchors.join(several, "anchor")
              .groupBy("text_key", F.shiftrightunsigned("spot", 32).alias("key2"))
              .agg(F.collect_set(F.col("spot").bitwiseAND(F.lit((1 << 32) - 1)).cast("int")).alias("places")))
    raw = docs.select("text", F.col("text").cast("binary").alias("_raw")).filter(F.octet_length("text") >= length)
    keyed = raw.select("text", *_key_columns(raw))
    texts = keyed.join(wanted, ["text_key", "key2"]).dropDuplicates(["text_key", "key2"])
    texts = written(texts, "repeats-texts")

    schema = "class binary, anchor long, context binary, text_key long, key2 long, first long"
    parts = written(texts.mapInPandas(_context_rows(length), schema), "repeats-contexts")
    sign = F.xxhash64("text_key", "key2", "first")
    classes = (parts.groupBy("class", "anchor", "context").agg(F.min(sign).alias("low"), F.max(sign).alias("high"))
               .select("class", "anchor", "context", (F.col("low") != F.col("high")).alias("several")))
    classes = written(classes, "repeats-classes")
    sizes = classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    large = sizes.filter(F.col("n") > LARGE * shard_contexts)
    shards = max(1, -(-classes.count() // shard_contexts))

    def decide(pdf: pd.DataFrame) -> pd.DataFrame:
        which, offset, group = repeated_groups(pdf["context"].tolist(), length)
        weight = np.where(pdf["several"].to_numpy()[which], 2, 1)
        again = np.bincount(group, weights=weight)[group] >= 2 if len(group) else np.zeros(0, bool)
        return _marked(pdf["class"].tolist(), which[again], offset[again])

    small = classes.join(large, "anchor", "left_anti").withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    found = small.groupBy("shard").applyInPandas(decide, "class binary, ranges array<int>")

    def list_strings(pdf: pd.DataFrame) -> pd.DataFrame:
        part = pdf["context"].tolist()
        which, offset, group = repeated_groups(part, length)
        weight = np.where(pdf["several"].to_numpy()[which], 2, 1)
        ids = pdf["class"].tolist()
        cut = np.flatnonzero(np.diff(group)) + 1 if len(group) else []
        rows = [(part[w[0]][o[0]:o[0] + length], int(x.sum()), [ids[i] for i in w], o.astype(np.int32).tolist())
                for w, o, x in zip(np.split(which, cut), np.split(offset, cut), np.split(weight, cut)) if len(w)]
        return pd.DataFrame(rows, columns=["string", "weight", "classes", "offsets"])

    spread = classes.join(large, "anchor").withColumn("slice", F.pmod(
        F.xxhash64("class"), F.ceil(F.col("n") / F.lit(shard_contexts)).cast("long")))
    strings = spread.groupBy("anchor", "slice").applyInPandas(
        list_strings, "string binary, weight int, classes array<binary>, offsets array<int>")
    merged = (strings.repartitionByRange(shards, "string")
              .withColumn("total", F.sum("weight").over(W.partitionBy("string"))).filter("total >= 2"))
    marks = (merged.select(F.explode(F.arrays_zip("classes", "offsets")).alias("m"))
             .select(F.col("m.classes").alias("class"),
                     F.array(F.col("m.offsets"), F.col("m.offsets") + F.lit(1)).alias("ranges")))
    by_class = found.unionByName(marks)
    ranges = (parts.select("class", "text_key", "key2", "first").join(by_class, "class")
              .groupBy("text_key", "key2").agg(F.collect_set(F.struct("first", "ranges")).alias("found")))
    return texts, ranges


def _cut(length: int):
    """(text_key, key2, n_removed, n_spans, kept_sha256, kept) of texts with their ranges."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for text, key, key2, found in zip(pdf["text"], pdf["text_key"], pdf["key2"], pdf["found"]):
                raw = _raw(text)
                edge = np.zeros(len(raw) + 1, np.int32)
                for f in found:
                    r = np.asarray(f["ranges"], np.int64) + f["first"]
                    edge[r[0::2]] += 1  # ranges of one context do not touch
                    edge[r[1::2] + length - 1] -= 1
                gone = np.cumsum(edge[:-1]) > 0
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                out.append((key, key2, int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
            yield pd.DataFrame(out, columns=["text_key", "key2", "n_removed", "n_spans", "kept_sha256", "kept"])
    return rows


def remove_repeats(docs: DataFrame, length: int = LENGTH, shard_contexts: int = SHARD_CONTEXTS) -> DataFrame:
    """(text_key, key2, n_removed, n_spans, kept_sha256, kept) of each text that loses bytes and
    has no whole copy.  ``kept``: the remaining bytes."""
    texts, ranges = repeated_ranges(docs, length, shard_contexts)
    schema = "text_key long, key2 long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    return texts.select("text", "text_key", "key2").join(ranges, ["text_key", "key2"]).mapInPandas(_cut(length), schema)


def repeats_query(docs: DataFrame, length: int = LENGTH, shard_contexts: int = SHARD_CONTEXTS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document.

    A null text is an empty text.  Texts shorter than ``length`` lose nothing; a
    longer text that occurs twice loses everything (one span).  Repeated rows
    count as copies.  Other columns are ignored; an empty table gives no rows."""
    check_columns(docs, doc_id="any", text="string")
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("_raw"))
    rows = rows.select("doc_id", F.octet_length("_raw").cast("long").alias("n_bytes"), *_key_columns(rows),
                       F.sha2("_raw", 256).alias("whole_sha256"))
    copies = (rows.filter(F.col("n_bytes") >= length).groupBy("text_key", "key2").agg(F.count(F.lit(1)).alias("copies"))
              .filter("copies > 1"))
    cut = remove_repeats(docs, length, shard_contexts).drop("kept")
    out = rows.join(copies, ["text_key", "key2"], "left").join(cut, ["text_key", "key2"], "left")
    copied = F.col("copies").isNotNull()
    return out.select(
        "doc_id", "n_bytes",
        F.when(copied, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copied, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copied, F.sha2(F.lit("").cast("binary"), 256))
        .otherwise(F.coalesce("kept_sha256", "whole_sha256")).alias("kept_sha256"))
