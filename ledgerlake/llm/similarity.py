"""Similarity join of documents on the Jaccard index of their five-word shingles.

The method is the chosen-path join.  Each set is embedded as 64 tokens (position
and minimum hash), which two sets share in proportion to their Jaccard index.
In each run a set follows every token that a shared hash of the path selects; a
token is selected with probability 1 / (threshold * tokens), so two sets at the
threshold share one child of a common node on average and unlike sets part.
Small nodes are compared by brute force.  A large one is first compared with one of its sets, the pivot: sets
that match it leave the node as its partners, so a large group of near copies costs one
comparison a set and is never split; the others are split again.  Runs, each with its own
pivots, repeat until a pair at the threshold is found with the target probability.

Pairs found by their tokens join sets into clusters; inside a cluster all pairs are then decided
exactly on the shingles, in blocks where a cluster is large.  Only one row per
set, bucket member or spanning edge is ever a Spark row, never all pairs.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import check_columns, hidden, shown, written

WORDS = 5
THRESHOLD = 0.8
TOKENS = 64
DEPTH = 3
RECALL = 0.9999  # for a pair exactly at the threshold that is split at every level
BUCKET = 2_000  # members of a node that are compared at once
BLOCK_SETS = 1_000
BLOCK_SHINGLES = 4_000_000
MATCH_MARGIN = 4.5  # standard deviations below the expected matches that still count as a candidate

_WORD = re.compile(r"\w+")
_A = np.random.RandomState(3).randint(1, 2 ** 62, TOKENS).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_B = np.random.RandomState(4).randint(0, 2 ** 63, TOKENS).astype(np.uint64)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _GOLD
    x = (x ^ (x >> np.uint64(29))) * _GOLD
    return x ^ (x >> np.uint64(32))


class WordHashes:
    """64-bit hashes of words, remembered up to a bounded number of words."""

    def __init__(self, limit: int = 1 << 20):
        self.known, self.limit = {}, limit

    def __call__(self, words: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > self.limit:
            known.clear()
        out = np.empty(len(words), np.uint64)
        for i, w in enumerate(words):
            h = known.get(w)
            if h is None:
                h = known[w] = int.from_bytes(hashlib.blake2b(w.encode("utf-8", "replace"), digest_size=8).digest(), "big")
            out[i] = h
        return out


def text_words(text: str | None) -> list[str]:
    """Lower-cased runs of letters, digits and underscores."""
    return _WORD.findall((text or "").lower())


def shingles(words: list[str], hashes: WordHashes) -> np.ndarray:
    """Distinct hashes of five consecutive words, sorted; of all words, if fewer."""
    if not words:
        return np.empty(0, np.uint64)
    w = hashes(words)
    n = max(len(w) - WORDS + 1, 1)
    h = np.zeros(n, np.uint64)
    for i in range(min(WORDS, len(w))):
        h = h * np.uint64(0x100000001B3) + w[i:i + n]
    return np.unique(_mix(h + np.uint64(min(len(w), WORDS))))


def sketch(s: np.ndarray) -> np.ndarray:
    """Minimum hashes, one per token position."""
    low = np.full(TOKENS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(s), 4096):
        low = np.minimum(low, (s[i:i + 4096, None] * _A + _B).min(0))
    return (low >> np.uint64(32)).astype(np.uint32)


def runs_needed(recall: float = RECALL, depth: int = DEPTH) -> int:
    """Runs after which a pair at the threshold has met with probability ``recall``:
    the common paths of a run form a branching process with one child on average.  Takes
    the mean number of matching tokens for granted; README gives the miss over all numbers."""
    alive = 1.0
    for _ in range(depth):
        alive = 1 - math.exp(-alive)
    return math.ceil(math.log(1 - recall) / math.log(1 - alive))


def chosen(paths: np.ndarray, tokens: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Children of ``paths`` (one per row of ``tokens``): (row, child path)."""
    with np.errstate(over="ignore"):
        token = _mix(tokens.astype(np.uint64) + (np.arange(TOKENS, dtype=np.uint64) << np.uint64(32)) + _GOLD)
        child = _mix(paths[:, None] * _GOLD + token)
    row, at = np.nonzero(child < np.uint64(int(2 ** 64 / (threshold * TOKENS))))
    return row, _mix(child[row, at] + _GOLD)


def _stack(col: pd.Series, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(col), dtype).reshape(len(col), -1)


def _sketch_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = WordHashes()
    for pdf in batches:
        key, size, tokens = [], [], []
        for text in pdf["text"]:
            words = text_words(text)
            s = shingles(words, hashes)
            key.append(hashlib.blake2b(" ".join(words).encode("utf-8", "replace"), digest_size=16).digest()
                       if words else None)
            size.append(len(s))
            tokens.append(sketch(s).tobytes() if words else None)
        yield pd.DataFrame({"doc_id": pdf["doc_id"], "row_key": pdf["row_key"], "set_key": key, "size": size,
                            "tokens": tokens})


def _first_paths(runs: int, threshold: float):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for i in range(0, len(pdf), 2000):
                part = pdf.iloc[i:i + 2000]
                tokens, key = _stack(part["tokens"], np.uint32), part["set_key"].to_numpy()
                for run in range(runs):
                    root = np.full(len(part), _mix(np.array([run + 1], np.uint64))[0])
                    row, path = chosen(root, tokens, threshold)
                    yield pd.DataFrame({"path": path.view(np.int64), "set_key": key[row]})
    return rows


def _settle(threshold: float, split: bool):
    """Rows of large nodes with their pivot: (set_key, pivot, no path) where the pivot is a candidate; (set_key, no pivot,
    path) for the sets that stay, under every child path or (``split`` false) under the node's own."""
    need, leave = least_matches(threshold), math.ceil(threshold * TOKENS)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            key, pivot, path = (pdf[c].to_numpy() for c in ("set_key", "pivot", "path"))
            tokens = _stack(pdf["tokens"], np.uint32)
            same = (tokens == _stack(pdf["pivot_tokens"], np.uint32)).sum(1)
            met = np.flatnonzero((same >= need) & (key != pivot))
            stay = np.flatnonzero(same < leave)  # the pivot leaves with those that it stands for
            if split and len(stay):
                row, child = chosen(path[stay].view(np.uint64), tokens[stay], threshold)
                stay, child = stay[row], child.view(np.int64)
            else:
                child = path[stay]
            yield pd.DataFrame({"set_key": key[met], "pivot": pivot[met], "path": pd.array([None] * len(met), "Int64")})
            yield pd.DataFrame({"set_key": key[stay], "pivot": [None] * len(stay), "path": pd.array(child, "Int64")})
    return rows


def grouped(keys: list[str], handle: Callable[[pd.DataFrame], pd.DataFrame | None], target_rows: int = 20_000):
    """For ``mapInPandas`` over partitions sorted by ``keys``: hands whole groups to
    ``handle``, many small ones at a time.  Holds one group and a batch."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0

        def ready(all_: bool):
            nonlocal held, size
            pdf = pd.concat(held, ignore_index=True) if len(held) > 1 else held[0]
            new = np.zeros(len(pdf), bool)
            for k in keys:
                v = pdf[k].to_numpy()
                new[1:] |= v[1:] != v[:-1]
            new[0] = True
            starts = np.flatnonzero(new)
            cut = len(pdf) if all_ else int(starts[-1])
            held, size = ([pdf.iloc[cut:]] if cut < len(pdf) else []), len(pdf) - cut
            if cut:
                yield handle(pdf.iloc[:cut], starts[starts < cut])

        for pdf in batches:
            if len(pdf):
                held.append(pdf)
                size += len(pdf)
                if size >= target_rows:
                    yield from ready(False)
        if held:
            yield from ready(True)
    return rows


def spanning_edges(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges from the first member of each connected part of a boolean matrix to the others."""
    todo, out = np.ones(len(linked), bool), []
    for root in range(len(linked)):
        if not todo[root]:
            continue
        todo[root] = False
        front = np.array([root])
        while len(front):
            front = np.flatnonzero(linked[front].any(0) & todo)
            todo[front] = False
            out += [(root, int(i)) for i in front]
    return out


def least_matches(threshold: float) -> int:
    """Matching tokens that a candidate needs: almost every pair at the threshold has more."""
    return max(1, math.floor(threshold * TOKENS - MATCH_MARGIN * math.sqrt(TOKENS * threshold * (1 - threshold))))


def _candidate_edges(threshold: float):
    need = least_matches(threshold)

    def handle(pdf: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        marks, key = _stack(pdf["marks"], np.uint16), pdf["set_key"].to_numpy()
        side = pdf["side"].to_numpy()
        size = np.diff(np.append(starts, len(pdf)))
        left, right = [], []
        few = np.repeat(np.where(size <= 24, size, 0), size)  # small nodes: all rows at once, by distance in the node
        at = np.arange(len(pdf)) - np.repeat(starts, size)
        d = 1
        while True:
            i = np.flatnonzero(at + d < few)
            if not len(i):
                break
            ok = (marks[i] == marks[i + d]).sum(1) >= need
            left.append(key[i[ok]])
            right.append(key[i[ok] + d])
            d += 1
        for s, m in zip(starts[size > 24], size[size > 24]):
            own = marks[s:s + m]
            linked = np.zeros((m, m), bool)
            for i in range(m):
                linked[i] = (own[i] == own).sum(1) >= need
            linked &= (side[s:s + m, None] != side[s:s + m]) | (side[s:s + m, None] == 0)
            e = np.array(spanning_edges(linked), np.int64).reshape(-1, 2) + s
            left.append(key[e[:, 0]])
            right.append(key[e[:, 1]])
        return pd.DataFrame({"a": np.concatenate(left) if left else [], "b": np.concatenate(right) if right else []})
    return grouped(["path", "left", "right"], handle)


def _block_pairs(df: DataFrame, n: str, by: list[str]) -> DataFrame:
    """Give each row of a group with ``n`` blocks to every pair of blocks that its own is
    in.  ``side``: 0 where a pair is one block, else 1 for the lower and 2 for the upper."""
    df = df.withColumn("block", F.pmod(F.xxhash64("set_key"), F.col(n).cast("long")).cast("int"))
    df = df.withColumn("other", F.explode(F.sequence(F.lit(0), F.col(n).cast("int") - 1)))
    return (df.withColumn("left", F.least("block", "other")).withColumn("right", F.greatest("block", "other"))
            .withColumn("side", F.when(F.col("left") == F.col("right"), 0)
                        .when(F.col("block") == F.col("left"), 1).otherwise(2)).drop("block", "other"))


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, root) for the nodes of undirected ``edges`` (a, b): root is the least node of
    the connected part.  Alternates linking larger and smaller neighbours to
    the least one until the edges form stars."""
    edges = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .distinct(), "edges")
    for _ in range(rounds):
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(least.select("a", F.col("m").alias("b"))).distinct())
        edges = written(small, "edges")
        # stars: no node is both below and above
        if edges.join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_semi").limit(1).count() == 0 and \
                edges.groupBy("a").count().filter("count > 1").limit(1).count() == 0:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select("b", F.col("b").alias("root")).distinct())
    raise RuntimeError("connected parts did not settle")


def _exact(threshold: float):
    def handle(pdf: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        out = []
        for s, e in zip(starts, np.append(starts[1:], len(pdf))):
            part = pdf.iloc[s:e].drop_duplicates("set_key")
            key, side = part["set_key"].tolist(), part["side"].to_numpy()
            sets = [np.frombuffer(x, np.uint64) for x in part["shingles"]]
            linked = jaccard(sets) >= threshold - 1e-12
            linked &= (side[:, None] != side) | (side[:, None] == 0)
            np.fill_diagonal(linked, False)
            out += [(k, None, int(n)) for k, n in zip(key, linked.sum(1)) if n]
            out += [(key[i], key[j], 0) for i, j in spanning_edges(linked)]
        return pd.DataFrame(out, columns=["a", "b", "links"])
    return grouped(["part", "left", "right"], handle, target_rows=2_000)


def jaccard(sets: list[np.ndarray]) -> np.ndarray:
    """Jaccard index of all pairs of sorted arrays without repeats."""
    size = np.array([len(x) for x in sets], float)
    token, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), size.astype(int))
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    column = np.cumsum(np.concatenate([[False], token[1:] != token[:-1]])) if len(token) else np.empty(0, int)
    often = np.bincount(column)[column] > 1
    column, owner = np.unique(column[often], return_inverse=True)[1], owner[often]
    shared = np.zeros((len(sets), len(sets)), np.float32)
    ends = np.searchsorted(column, np.arange(0, (column[-1] + 1 if len(column) else 0) + 2048, 2048))
    for lo, hi in zip(ends, ends[1:]):
        x = np.zeros((len(sets), 2048), np.float32)
        x[owner[lo:hi], column[lo:hi] % 2048] = 1
        shared += x @ x.T
    union = size[:, None] + size - shared
    return np.divide(shared, union, out=np.zeros_like(union), where=union > 0)


def _set_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = WordHashes()
    for pdf in batches:
        out = []
        for text, key, part, blocks in zip(pdf["text"], pdf["set_key"], pdf["part"], pdf["blocks"]):
            out.append((key, part, blocks, shingles(text_words(text), hashes).tobytes()))
        yield pd.DataFrame(out, columns=["set_key", "part", "blocks", "shingles"])


def _row_key(docs: DataFrame):
    """Digest of id and text: rows with equal ones are copies of one row."""
    return F.md5(F.concat_ws("\x1f", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
                             F.coalesce(F.col("text"), F.lit(""))))


def similarity_labels(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL,
                      bucket: int = BUCKET, block_sets: int = BLOCK_SETS) -> DataFrame:
    """(doc_id, row_key, set_key, root, links) for every row: ``set_key`` names the word sequence
    (null without words), ``root`` the group of directly or indirectly linked sequences,
    ``links`` counts the other sequences with a Jaccard index of ``threshold`` or more."""
    base = docs.select("doc_id", _row_key(docs).alias("row_key"), "text")
    id_type = dict(base.dtypes)["doc_id"]
    sketched = written(base.mapInPandas(
        _sketch_rows, f"doc_id {id_type}, row_key string, set_key binary, size long, tokens binary"), "sketches")
    kinds = written(sketched.filter("set_key is not null").groupBy("set_key").agg(
        F.first("size").alias("size"), F.first("tokens").alias("tokens"), F.min("row_key").alias("row_key")), "sets")

    runs = runs_needed(recall)
    path_schema = "path long, set_key binary"
    paths = kinds.select("tokens", "set_key").mapInPandas(_first_paths(runs, threshold), path_schema)
    leaves, pivot_edges = [], []
    for level in range(1, DEPTH + 1):
        n = paths.groupBy("path").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        nodes = written(paths.join(n, "path"), f"paths{level}")
        leaves.append(nodes.filter(F.col("n") <= bucket).withColumn("blocks", F.lit(1)))
        large = nodes.filter(F.col("n") > bucket)
        pivots = large.groupBy("path").agg(F.min(F.struct(F.xxhash64("path", "set_key").alias("h"), "set_key")).alias("p"))
        tokens = kinds.select("set_key", "tokens")
        pivots = pivots.select("path", F.col("p.set_key").alias("pivot")).join(
            tokens.toDF("pivot", "pivot_tokens"), "pivot")
        settled = written(large.join(tokens, "set_key").join(pivots, "path")
                          .select("set_key", "tokens", "path", "pivot", "pivot_tokens")
                          .mapInPandas(_settle(threshold, level < DEPTH), "set_key binary, pivot binary, path long"),
                          f"settled{level}")
        pivot_edges.append(settled.filter("pivot is not null").select(F.col("pivot").alias("a"), F.col("set_key").alias("b")))
        paths = settled.filter("path is not null").select("path", "set_key")
    # unlike sets that no level has parted
    n = paths.groupBy("path").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    leaves.append(paths.join(n, "path").withColumn("blocks", F.ceil(F.col("n") / F.lit(bucket)).cast("int")))
    members = leaves[0]
    for other in leaves[1:]:
        members = members.unionByName(other)

    # the low halves of the tokens are enough to compare
    @F.pandas_udf("binary")
    def halves(tokens: pd.Series) -> pd.Series:
        return pd.Series([x.tobytes() for x in _stack(tokens, np.uint32).astype(np.uint16)] if len(tokens) else [],
                         dtype=object)

    marked = kinds.select("set_key", halves("tokens").alias("marks"))
    members = _block_pairs(members, "blocks", ["path"]).join(marked, "set_key")
    members = members.select("path", "left", "right", "side", "set_key", "marks")
    node = ["path", "left", "right"]
    near = (members.repartition(*node).sortWithinPartitions(*node)
            .mapInPandas(_candidate_edges(threshold), "a binary, b binary"))
    for edges in pivot_edges:
        near = near.union(edges)
    clusters = components(near)

    sized = clusters.join(kinds.select(F.col("set_key").alias("node"), "size", "row_key"), "node")
    blocks = sized.groupBy("root").agg(F.ceil(F.greatest(
        F.count(F.lit(1)) / F.lit(block_sets), F.sum("size") / F.lit(BLOCK_SHINGLES))).alias("blocks"))
    wanted = sized.join(blocks, "root").select("row_key", F.col("node").alias("set_key"), F.col("root").alias("part"),
                                               "blocks")
    # copies of a row end here: one row per set is sent
    sets = base.select("row_key", "text").join(wanted, "row_key").distinct().mapInPandas(
        _set_rows, "set_key binary, part binary, blocks long, shingles binary")
    pairs = ["part", "left", "right"]
    sets = (_block_pairs(sets, "blocks", ["part"]).repartition(*pairs).sortWithinPartitions(*pairs)
            .select(*pairs, "side", "set_key", "shingles"))
    exact = written(sets.mapInPandas(_exact(threshold), "a binary, b binary, links long"), "links")
    links = exact.filter("b is null").groupBy(F.col("a").alias("set_key")).agg(F.sum("links").alias("links"))
    roots = components(exact.filter("b is not null").select("a", "b"))
    facts = links.join(roots.select(F.col("node").alias("set_key"), "root"), "set_key")
    return (sketched.select("doc_id", "row_key", "set_key").join(facts, "set_key", "left")
            .withColumn("root", F.coalesce("root", "set_key")).withColumn("links", F.coalesce("links", F.lit(0))))


def similarity_join(docs: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """doc_id, class_id, text_id, n_links of every document.

    ``class_id`` is the smallest doc_id of the documents linked directly or over
    others by a Jaccard index of ``threshold`` or more on five-word shingles;
    ``text_id`` the smallest doc_id with the same words; ``n_links`` the number of
    other word sequences linked directly.  A text of fewer than five words is one
    shingle; one without words (or null) is linked to nothing and its own class.
    Repeated rows get equal results; a class of null ids has class_id null; other columns are
    ignored; an empty table gives no rows."""
    check_columns(docs, doc_id="any", text="string")
    rows = similarity_labels(docs, threshold, **options)
    texts = rows.filter("set_key is not null").groupBy("set_key", "root").agg(F.min("doc_id").alias("text_id"))
    classes = texts.groupBy("root").agg(F.min("text_id").alias("class_id"))
    named = texts.join(classes, "root").select("set_key", "text_id", "class_id")
    return rows.join(named, "set_key", "left").select(
        "doc_id", F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("text_id")).alias("text_id"),
        F.col("links").cast("long").alias("n_links"))


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """``docs`` with one row of each class: the smallest doc_id's (then the smallest
    digest's).  Rows without words stay; copies of one row count as one."""
    check_columns(docs, doc_id="any", text="string")
    rows = similarity_labels(docs, threshold, **options)
    group = F.coalesce(F.concat(F.lit("s"), F.hex("root")), F.col("row_key"))
    best = rows.groupBy(group.alias("g")).agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("best"))
    d, own = hidden(docs, row_key=_row_key(docs))
    kept = d.join(best.select(F.col("best.row_key").alias("row_key")).distinct(), "row_key")
    return kept.dropDuplicates(["row_key"]).select(*shown(own))
