"""Grouping of spelling variants: frequent words one edit apart, found over an index
of variable-length grams.

Words are counted over all documents.  A gram dictionary is built from them: a gram
that more than a threshold of positions hold is extended by one letter, so frequent
grams are long and rare ones short.  A word falls into the gram that each position
yields, without those inside an earlier one.  An edit at one place affects only the grams
over it and a few behind it: this bounds, for each word and place, which grams a near word
must share, namely all others.  The lists of the last survivor before the place and of the first behind it are
merged to the words that both hold; one edit leaves everything on a survivor's far side alone, so
each counts with the letters there.  Words that meet are verified.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import check_columns, written

MIN_LETTERS = 6
MIN_COUNT = 5
FORM_RATIO = 5
SLIP = 199  # one checksum in so many drops a letter
QMIN, QMAX = 2, 3
#: A gram is frequent if its share of all gram positions is above 1 / this: at most this
#: many grams of each length are frequent, however many words there are.
DICTIONARY = 25_000
LEAST_FREQUENT = 8
HELD_WORDS = 400_000  # distinct words that a task counts before it passes them on
LONG_TEXT = 4_000_000

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def _runs(text: str) -> Counter:
    """Runs of letters with A-Z lowered, counted."""
    if len(text) > LONG_TEXT:
        raw = Counter(m.group() for m in _RUN.finditer(text) if m.end() - m.start() >= MIN_LETTERS)
    else:
        raw = Counter(w for w in _RUN.findall(text) if len(w) >= MIN_LETTERS)
    out = Counter()
    for w, n in raw.items():
        out[w.lower() if w.isascii() else w.translate(_LOWER)] += n
    return out


def _count_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: Counter = Counter()
    rows = lambda: pd.DataFrame({"word": list(held), "n": np.fromiter(held.values(), np.int64, len(held))})
    for pdf in batches:
        for doc_id, text in zip(pdf["id"], pdf["text"]):
            start = zlib.crc32(f"{doc_id}:".encode())
            for w, n in _runs(text).items():
                h = zlib.crc32(w.encode(), start)
                if h % SLIP == 0:
                    at = h % len(w)
                    w = w[:at] + w[at + 1:]
                    if len(w) < MIN_LETTERS:
                        continue
                held[w] += n
        if len(held) > HELD_WORDS:
            yield rows()
            held.clear()
    if held:
        yield rows()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): the words of all texts, a letter lost where the checksum of id and word says so."""
    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("id"), "text").filter("text <> ''")
    return (texts.mapInPandas(_count_rows, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= MIN_COUNT))


def gram_dictionary(words: DataFrame, size: int = DICTIONARY) -> set[str]:
    """The frequent grams of QMIN to QMAX - 1 letters (``^`` and ``$`` stand before and after a word),
    those that are extended by a letter.  At most ``size`` of each length."""
    marked = words.select(F.concat(F.lit("^"), "word", F.lit("$")).alias("w"))
    positions = marked.agg(F.sum(F.length("w"))).first()[0] or 0
    least = max(LEAST_FREQUENT, -(-positions // size))
    at = F.explode(F.sequence(F.lit(1), F.length("w") - F.lit(QMIN - 1)))
    cut = F.explode(F.sequence(F.lit(QMIN), F.least(F.lit(QMAX - 1), F.length("w") - F.col("at") + 1)))
    grams = (marked.select("w", at.alias("at")).select("w", "at", cut.alias("q"))
             .select(F.col("w").substr(F.col("at"), F.col("q")).alias("gram")))
    often = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > least)
    return {r["gram"] for r in often.collect()}


def decompose(marked: str, frequent: set[str]) -> list[tuple[int, int]]:
    """Places (start, end) of the grams of a word between its marks."""
    out, reach, n = [], 0, len(marked)
    for p in range(n - QMIN + 1):
        e = p + QMIN
        while e < n and e - p < QMAX and marked[p:e] in frequent:
            e += 1
        if e > reach:
            out.append((p, e))
            reach = e
    return out


def survivors(grams: list[tuple[int, int]], length: int) -> Iterator[tuple[int, int]]:
    """For every place of an edit the reach of the grams that it can't affect: letters up to the end of
    the last one before the place, letters from the start of the first one behind it (0: none).
    Affected are the grams over the place, and those behind it that a gram over it could then hold inside."""
    starts, ends = [p for p, _ in grams], [e for _, e in grams]
    for i in range(1, length):
        left = bisect_right(ends, i)
        before = ends[left - 1] if left else 0
        for last in (i,) if i == length - 1 else (i, i + 1):  # a letter put before place i; the letter there replaced or deleted
            right = max(bisect_left(starts, last), bisect_right(ends, last - 1 + QMAX))
            yield before, length - starts[right] if right < len(grams) else 0


def postings(word: str, frequent: set[str]) -> set[str]:
    """Keys of a word: it shares one of them with every near word, for both lose the same grams to the edit
    and keep the same ones."""
    s = f"^{word}$"
    n, keys = len(s), set()
    for before, behind in survivors(decompose(s, frequent), n):
        if before or behind:
            keys.add(f"{s[:before]}|{s[n - behind:]}")
        else:  # no gram need survive here: one half of the word does
            for k in {len(word) // 2, (len(word) - 1) // 2}:
                keys.add(s[:k + 1])
                keys.add(s[n - k - 1:])
    return keys


def _posting_rows(frequent: set[str]):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            key, word = [], []
            for w in pdf["word"]:
                own = postings(w, frequent)
                key += own
                word += [w] * len(own)
            yield pd.DataFrame({"key": key, "word": word})
    return rows


def near_pairs(words: DataFrame, size: int = DICTIONARY) -> DataFrame:
    """(a, b): the words that differ by one inserted, deleted or replaced code point, a < b."""
    frequent = gram_dictionary(words, size)
    posted = (words.select("word").mapInPandas(_posting_rows(frequent), "key string, word string")
              .select(F.xxhash64("key").alias("key"), "word", F.length("word").alias("len")))
    posted = written(posted, "gram-lists")
    met = posted.alias("x").join(posted.alias("y"), (F.col("x.key") == F.col("y.key"))
                                 & (F.col("x.word") < F.col("y.word"))
                                 & (F.abs(F.col("x.len") - F.col("y.len")) <= 1)
                                 & (F.levenshtein(F.col("x.word"), F.col("y.word"), 1) == 1))
    return met.select(F.col("x.word").alias("a"), F.col("y.word").alias("b")).distinct()


def last_forms(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the last word that the forms lead to.  Every round
    doubles the steps taken; a form is FORM_RATIO times as frequent as its word, so 27 steps are never exceeded."""
    up = written(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "forms")
    while not up.filter("moved").isEmpty():
        on = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        up = written(up.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                        F.col("next").isNotNull().alias("moved")), "forms")
    return up.select("word", "root")


def spelling_groups(docs: DataFrame, size: int = DICTIONARY) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``documents``.

    Words are the runs of A-Z, a-z and U+00C0 to U+00FF with A-Z lowered, of
    six letters and five occurrences at least; where 199 divides the checksum of ``<doc_id>:<word>``
    the occurrences lose one letter first.  ``n_near`` counts the words one edit apart; ``form`` is the
    most frequent of them (ties: the first in code-point order) if it is five times as frequent, ``form_n`` its
    frequency; ``root`` is where the forms lead.  Null and empty texts hold no words, a null doc_id counts as
    the text ``null``, repeated rows count each time, an empty table gives no rows, other columns are ignored."""
    check_columns(docs, doc_id="any", text="string")
    words = written(word_counts(docs), "words")
    pairs = near_pairs(words, size)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other")).union(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other")))
    other = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    best = both.join(other, "other").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("n"), "other")).alias("best"))
    chosen = F.col("best.n") * -1 >= F.col("n") * FORM_RATIO
    named = written(words.join(best, "word", "left").select(
        "word", F.when(chosen, F.col("best.other")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(chosen, -F.col("best.n")).alias("form_n")), "named")
    roots = last_forms(named.filter("form is not null"))
    return named.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), F.col("n").cast("long").alias("n"),
        F.col("n_near").cast("long").alias("n_near"), F.col("form_n").cast("long").alias("form_n"))


def spelling_sql() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
with recursive t as materialized (
  select list(list_reduce(list_prepend(i::bigint, range(8)), lambda c, j:
         case when c % 2 = 1 then xor(3988292384, c >> 1) else c >> 1 end) order by i) as crc_table
  from (select unnest(range(256)) as i)),
runs as (
  select id, run, count(*) as n
  from (select coalesce(doc_id::varchar, 'null') as id,
               unnest(regexp_extract_all(translate(text, '{upper}', '{lower}'), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) as run
        from documents)
  where length(run) >= {MIN_LETTERS} group by 1, 2),
checked as materialized (
  select run, n, xor(4294967295, list_reduce(list_prepend(4294967295::bigint,
           list_transform(regexp_extract_all(hex(encode(id || ':' || run)), '..'), lambda b: ('0x' || b)::bigint)),
           lambda c, b: xor(c >> 8, list_extract(t.crc_table, (xor(c, b) & 255) + 1)))) as h
  from runs, t),
words as materialized (
  select word, sum(n)::bigint as n
  from (select n, case when h % {SLIP} = 0
                       then substr(run, 1, (h % length(run))::bigint) || substr(run, (h % length(run))::bigint + 2)
                       else run end as word from checked)
  where length(word) >= {MIN_LETTERS} group by word having sum(n) >= {MIN_COUNT}),
cut as materialized (
  select word, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest
  from (select word, unnest(range(1, length(word) + 1)) as i from words)),
near as (
  select x.word, y.word as other from cut x join cut y on x.i = y.i and x.rest = y.rest and x.word <> y.word
  union select w.word, c.word from words w join cut c on c.rest = w.word
  union select c.word, w.word from words w join cut c on c.rest = w.word),
best as (
  select near.word, count(*) as n_near, first(near.other order by o.n desc, near.other) as other, max(o.n) as other_n
  from near join words o on o.word = near.other group by near.word),
named as materialized (
  select w.word, case when b.other_n >= {FORM_RATIO} * w.n then b.other end as form, w.n, coalesce(b.n_near, 0) as n_near,
         case when b.other_n >= {FORM_RATIO} * w.n then b.other_n end as form_n
  from words w left join best b on b.word = w.word),
chain as (
  select word, word as cur, 0 as step from named
  union all select c.word, m.form, c.step + 1 from chain c join named m on m.word = c.cur where m.form is not null)
select m.word, m.form, r.root, m.n, m.n_near::bigint as n_near, m.form_n
from named m join (select word, arg_max(cur, step) as root from chain group by word) r on r.word = m.word
"""
