"""Alignment of two tokenizers' tokens by the bytes they cover, with corpus-wide counts of linked ids.

Tokens of both sides are intervals of bytes.  Sorted by start, with the running
maximum of their ends, a group breaks where a start reaches that maximum; there both
tokenizers end a token.  Inside the groups the overlapping pairs are expanded; those that end
together are the links.  Neither tokenizer joins a letter with a blank behind it, so texts
are cut before such blanks and every distinct cut is encoded and aligned once per task.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import check_columns, written
from .tokens import Remembered, byte_letters, load_pieces, load_tokenizer

TOKENIZER_A = "byte_bpe_50k.json"
TOKENIZER_B = "piece_bpe_32k.model"
BATCH_LETTERS = 2_000_000
REMEMBERED = 150_000  # aligned cuts that a worker holds, up to twice as many
#: Pairs with at least the share 1 / this of all links; so there are never more of them.
FREQUENT_PAIRS = 400_000

_ROWS = ("doc_id {id_type}, uid long, n_a long, n_b long, n_groups long, n_links long, n_overlaps long, "
         "groups_sha256 string, codes array<long>, times array<long>")


class SideA:
    """Ids and byte lengths under a byte-level tokenizer.  Where its ids number the merges in their order, as
    ranks do, the vocabulary is handed to the faster encoder for ranks; else the tokenizer itself encodes."""

    def __init__(self, name: str):
        letters = byte_letters()
        self.tokenizer = load_tokenizer(name, True)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.bytes = {i: bytes(letters[c] for c in w) for w, i in vocabulary.items() if w not in special}
        self.size = max(self.tokenizer.get_vocab(with_added_tokens=True).values()) + 1
        self.ranks = None
        merges = json.loads(self.tokenizer.to_str())["model"]["merges"]
        if all(vocabulary.get("".join(m if isinstance(m, list) else m.split(" "))) == 256 + k for k, m in enumerate(merges)):
            import public_tokenizers
            import tiktoken
            self.ranks = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, special_tokens={},
                                           mergeable_ranks={w: i for i, w in self.bytes.items()})

    def __call__(self, cuts: list[str]) -> list[list[int]]:
        if self.ranks:
            return [self.ranks.encode_ordinary(" " + c) for c in cuts]
        return [e.ids for e in self.tokenizer.encode_batch_fast([" " + c for c in cuts], add_special_tokens=False)]


class SideB:
    """The same under a piece tokenizer, which puts the blank itself."""

    def __init__(self, name: str):
        self.pieces = p = load_pieces(name)
        self.size = p.get_piece_size()
        self.bytes = {i: bytes([int(w[3:5], 16)]) if p.is_byte(i) else w.replace("▁", " ").encode()
                      for i, w in ((i, p.id_to_piece(i)) for i in range(p.get_piece_size()))}

    def __call__(self, cuts: list[str]) -> list[list[int]]:
        return self.pieces.encode(cuts, num_threads=1)


def coalesce(start: np.ndarray, end: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, group of each token in that order) of intervals that tile the same bytes on either side."""
    order = np.lexsort((side, start))
    reach = np.maximum.accumulate(end[order])
    breaks = np.ones(len(order), bool)
    breaks[1:] = start[order][1:] >= reach[:-1]
    return order, np.cumsum(breaks) - 1


def overlaps(start_a: np.ndarray, end_a: np.ndarray, start_b: np.ndarray, end_b: np.ndarray):
    """All pairs (index in A, index in B) of sorted tokens that share bytes."""
    low, high = np.searchsorted(end_b, start_a, "right"), np.searchsorted(start_b, end_a, "left")
    n = high - low
    a = np.repeat(np.arange(len(n)), n)
    return a, np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)


class Aligned:
    """Alignment of cuts: (n_a, n_b, n_groups, n_overlaps, groups as text, link codes); None where
    the bytes of either side are not the cut's.  A link code is A's id * 2^32 + B's."""

    def __init__(self, name_a: str, name_b: str):
        self.a, self.b = SideA(name_a), SideB(name_b)
        self.words, self.first_b, self.parts, self.sizes = [], 0, [], []
        for side, last in ((self.a, "|"), (self.b, ";")):
            parts = [side.bytes.get(i, b"") for i in range(max(side.bytes) + 1)]
            parts.extend([b""] * (side.size - len(parts)))  # special tokens
            self.first_b = len(self.words) if side is self.b else 0
            # an id's text inside its group, and as the last of its side there
            self.words += [w for i in range(len(parts)) for w in (f"{i},", f"{i}{last}")]
            self.parts.append(parts)
            self.sizes.append(np.array([len(x) for x in parts], np.int64))

    def __call__(self, cuts: list[str]) -> list:
        out = [None] * len(cuts)
        wants = [(" " + c).encode() for c in cuts]
        length = np.fromiter(map(len, wants), np.int64, len(cuts))
        ids, n, good = [], [], np.ones(len(cuts), bool)
        for side, sizes in zip((self.a, self.b), self.sizes):
            own = side(cuts)
            n.append(np.fromiter(map(len, own), np.int64, len(cuts)))
            ids.append(np.fromiter(chain.from_iterable(own), np.int64, int(n[-1].sum())))
            reach, last = np.concatenate([[0], np.cumsum(sizes[ids[-1]])]), np.cumsum(n[-1])
            good &= reach[last] - reach[last - n[-1]] == length
        for known, parts, count in zip(ids, self.parts, n):
            got = b"".join(map(parts.__getitem__, known[np.repeat(good, count)].tolist()))
            if got != b"".join([wants[k] for k in np.flatnonzero(good)]):
                at = 0
                for k in np.flatnonzero(good).tolist():
                    good[k], at = got[at:at + len(wants[k])] == wants[k], at + len(wants[k])
        if not good.any():
            return out
        id_a, id_b = (x[np.repeat(good, count)] for x, count in zip(ids, n))
        n_a, n_b = (x[good] for x in n)
        base = np.concatenate([[0], np.cumsum(length[good])])
        end_a, end_b = np.cumsum(self.sizes[0][id_a]), np.cumsum(self.sizes[1][id_b])
        start_a, start_b = (np.concatenate([[0], x[:-1]]) for x in (end_a, end_b))
        side = np.repeat([0, 1], [len(id_a), len(id_b)])
        order, group = coalesce(np.concatenate([start_a, start_b]), np.concatenate([end_a, end_b]), side)
        of = np.empty(len(order), np.int64)
        of[order] = group
        last_a = np.append(np.diff(of[:len(id_a)]) > 0, True)  # A's last token of a group, B's last
        last_b = np.append(np.diff(of[len(id_a):]) > 0, True)
        pair_a, pair_b = overlaps(start_a, end_a, start_b, end_b)
        linked = end_a[pair_a] == end_b[pair_b]
        codes = ((id_a[pair_a[linked]] << 32) | id_b[pair_b[linked]]).tolist()
        link_at = np.searchsorted(end_a[pair_a[linked]], base, "right").tolist()
        n_pairs = np.diff(np.searchsorted(end_a[pair_a], base, "right")).tolist()
        n_groups = np.diff(np.searchsorted(end_a[last_a], base, "right")).tolist()
        word = np.concatenate([id_a * 2 + last_a, self.first_b + id_b * 2 + last_b])
        words = list(map(self.words.__getitem__, word[np.argsort(of * 2 + side, kind="stable")].tolist()))
        word_at = np.concatenate([[0], np.cumsum(n_a + n_b)]).tolist()
        for j, (k, a, b) in enumerate(zip(np.flatnonzero(good).tolist(), n_a.tolist(), n_b.tolist())):
            out[k] = (a, b, n_groups[j], n_pairs[j], "".join(words[word_at[j]:word_at[j + 1]])[:-1],
                      tuple(codes[link_at[j]:link_at[j + 1]]))
        return out


def cuts_of(text: str) -> list[str]:
    """The text cut at the blanks behind a letter that is no white space; the blank itself is left out."""
    cuts = text.split(" ")
    odd = {c for c in set(cuts) if not c or c[-1].isspace()}
    if not odd:
        return cuts
    out, open_ = [cuts[0]], cuts[0] in odd
    for c in cuts[1:]:
        if open_ or not c:
            out[-1] += " " + c
        else:
            out.append(c)
        open_ = c in odd
    return out


def _lists(values: np.ndarray, owner: np.ndarray, n: int) -> pa.ListArray:
    """Lists by owner of values sorted by it."""
    ends = np.searchsorted(owner, np.arange(n + 1))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int64()))


def _documents(cut: list[list[str]], known: dict, distinct: set[str]) -> list:
    """Columns n_a, n_b, n_groups, n_links, n_overlaps, groups_sha256, codes, times of documents."""
    place = {c: i for i, c in enumerate(distinct)}
    found = [known[c] for c in place]
    nothing = (0, 0, 0, 0, "", ())
    odd = np.array([x is None for x in found], bool)
    *numbers, texts, links = zip(*[x or nothing for x in found]) if found else [()] * 6
    size = np.array([len(c) for c in cut], np.int64)
    at = np.fromiter(map(place.__getitem__, chain.from_iterable(cut)), np.int64, int(size.sum()))
    doc = np.repeat(np.arange(len(cut)), size)
    whole = np.bincount(doc[odd[at]], minlength=len(cut)) == 0
    at, doc = at[whole[doc]], doc[whole[doc]]
    ends = np.searchsorted(doc, np.arange(len(cut) + 1))
    sums = []
    for number in numbers:
        added = np.concatenate([[0], np.cumsum(np.array(number, np.int64)[at])])
        sums.append(added[ends[1:]] - added[ends[:-1]])
    n_codes = np.fromiter(map(len, links), np.int64, len(links))
    codes = np.fromiter(chain.from_iterable(links), np.int64, int(n_codes.sum()))
    n = n_codes[at]
    link = codes[np.repeat((np.cumsum(n_codes) - n_codes)[at] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
    owner = np.repeat(doc, n)
    order = np.lexsort((link, owner))
    link, owner = link[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], (link[1:] != link[:-1]) | (owner[1:] != owner[:-1])])) if len(link) else link
    times = np.diff(np.append(first, len(link)))
    sha = [hashlib.sha256(";".join(map(texts.__getitem__, at[lo:hi].tolist())).encode()).hexdigest() if hi > lo else ""
           for lo, hi in zip(ends[:-1].tolist(), ends[1:].tolist())]
    return [pa.array(sums[0]), pa.array(sums[1]), pa.array(sums[2]), pa.array(np.bincount(owner, minlength=len(cut)), pa.int64()),
            pa.array(sums[3]), pa.array(sha, pa.string()), _lists(link[first], owner[first], len(cut)),
            _lists(times, owner[first], len(cut))]


@lru_cache(maxsize=1)
def _remembered(name_a: str, name_b: str) -> Remembered:
    """One memory for all tasks of a worker process."""
    return Remembered(Aligned(name_a, name_b), REMEMBERED)


def _aligned_rows(name_a: str, name_b: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembered, made = _remembered(name_a, name_b), TaskContext.get().partitionId() << 40
        for batch in batches:
            texts, at = batch.column("text").to_pylist(), 0
            while at < len(texts):
                stop, letters = at, 0
                while stop < len(texts) and (stop == at or letters + len(texts[stop] or "") <= BATCH_LETTERS):
                    letters += len(texts[stop] or "")
                    stop += 1
                cut = [cuts_of(t) if t else [] for t in texts[at:stop]]
                distinct = set().union(*cut)
                n = stop - at
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, n), pa.array(range(made, made + n), pa.int64()),
                     *_documents(cut, remembered(distinct), distinct)],
                    ["doc_id", "uid", "n_a", "n_b", "n_groups", "n_links", "n_overlaps", "groups_sha256", "codes", "times"])
                made += n
                at = stop
    return rows


def aligned_documents(docs: DataFrame, name_a: str = TOKENIZER_A, name_b: str = TOKENIZER_B) -> DataFrame:
    """One row per document with its numbers of tokens, groups, links and overlaps, the digest of its groups, and
    its distinct links (``codes``) with their ``times``."""
    return docs.select("doc_id", "text").mapInArrow(
        _aligned_rows(name_a, name_b), _ROWS.format(id_type=dict(docs.dtypes)["doc_id"]))


def _id_b(code: Column) -> Column:
    return code.bitwiseAND(F.lit(0xFFFFFFFF))


def link_counts(aligned: DataFrame) -> DataFrame:
    """(code, count, best): how often each id pair is linked in all documents, and whether no
    other pair of its B id is linked more often.  B ids are bounded by the vocabulary."""
    links = aligned.select(F.explode(F.arrays_zip("codes", "times")).alias("l"))
    counts = links.groupBy(F.col("l.codes").alias("code")).agg(F.sum("l.times").alias("count"))
    counts = written(counts, "link-counts")
    most = counts.groupBy(_id_b(F.col("code")).alias("b")).agg(F.max("count").alias("most"))
    return counts.join(F.broadcast(most), _id_b(F.col("code")) == F.col("b")).select(
        "code", "count", (F.col("count") == F.col("most")).alias("best"))


def align_tokenizers(docs: DataFrame, name_a: str = TOKENIZER_A, name_b: str = TOKENIZER_B,
                     frequent_pairs: int = FREQUENT_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_overlaps of every document.

    A sees a blank and the text, B the text (it puts the blank); special tokens' strings are plain text.  Null and empty
    texts, and texts that the bytes of A's or B's tokens do not give back, have no tokens: zeros and ''.
    ``n_links`` counts the pairs of an A and a B token that end at the same byte, ``count_sum`` adds how often
    each one's id pair is linked in all documents, ``n_best`` counts those whose pair is the most frequent of its B id
    (ties included), ``n_overlaps`` the pairs that share bytes.  Repeated rows count each time, null ids are documents
    like others, an empty table gives no rows, other columns are ignored."""
    check_columns(docs, doc_id="any", text="string")
    aligned = written(aligned_documents(docs, name_a, name_b), "aligned")
    counts = written(link_counts(aligned), "link-best")
    # frequent pairs are few by their share and would be hot keys; the others are not hot
    links = aligned.agg(F.sum("n_links")).first()[0] or 0
    is_frequent = F.col("count") * F.lit(frequent_pairs) >= F.lit(links)
    frequent, rest = counts.filter(is_frequent), counts.filter(~is_frequent)
    each = aligned.select("uid", F.explode(F.arrays_zip("codes", "times")).alias("l")).select(
        "uid", F.col("l.codes").alias("code"), F.col("l.times").alias("m"))
    counted = each.join(F.broadcast(frequent), "code").select("uid", "m", "count", "best").union(
        each.join(F.broadcast(frequent.select("code")), "code", "left_anti").join(rest.hint("merge"), "code")
        .select("uid", "m", "count", "best"))
    sums = counted.groupBy("uid").agg(F.sum(F.when(F.col("best"), F.col("m")).otherwise(0)).alias("n_best"),
                                      F.sum(F.col("m") * F.col("count")).alias("count_sum"))
    zero = F.lit(0).cast("long")
    return aligned.drop("codes", "times").join(sums, "uid", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256", "n_overlaps")
