"""Benchmark decontamination: a broadcast hash set of normalised benchmark windows.

Each benchmark item gives its windows of ten consecutive words (an item of fewer
words is one window).  Every window position of every document is hashed inside
the scan, looked up in the broadcast set, and a hit is verified word for word.
Only hits leave the scan.  Only DataFrame functions are used.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import check_columns, hidden, shown

WINDOW = 10
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Above this many bytes of windows the set is joined by a shuffle instead of a broadcast.
MAX_BROADCAST_BYTES = 256 << 20


def words(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def _window_hash(word_hashes: str, pos: Column, length: int) -> Column:
    """Hash of ``length`` consecutive words from their hashes."""
    return F.xxhash64(*[F.get(F.col(word_hashes), pos + F.lit(k)) for k in range(length)])


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(h, win, item_id): the distinct windows of the benchmark with their items."""
    check_columns(benchmark, item_id="any", text="string")
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("w"))
    n = F.size("w")
    starts = F.when(n > 0, F.sequence(F.lit(0), F.greatest(n - F.lit(window), F.lit(0))))
    cut = items.withColumn("at", F.explode(starts)).withColumn("win", F.slice("w", F.col("at") + F.lit(1), F.lit(window)))
    hashed = cut.withColumn("wh", F.transform("win", lambda w: F.xxhash64(w)))
    h = F.coalesce(*[F.when(F.size("win") == k, _window_hash("wh", F.lit(0), k)) for k in range(1, window + 1)])
    return hashed.select(h.alias("h"), "win", "item_id").distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """One row per document: doc_id, text_md5, n_words, n_hit, n_items,
    items_sha256, contaminated, hits (the hit word ranges as (pos, len)).

    A null or empty text has no words and no hits; an empty benchmark hits
    nothing.  An item without an id hits like others but is in no list of items.  Rows equal in doc_id and text are
    counted, not repeated, before the shuffle and come out as often as they came
    in.  Extra columns of either table are ignored.
    """
    check_columns(docs, doc_id="any", text="string")
    bench = benchmark_windows(benchmark, window)
    # the set is small or not: one row with its bytes and window lengths (at most `window` of them)
    facts = bench.agg(F.sum(F.length(F.array_join("win", " ")) + F.lit(64)).alias("bytes"),
                      F.collect_set(F.size("win")).alias("lengths")).first()
    lengths = sorted(facts["lengths"]) if facts["lengths"] else []

    text = F.col("text")
    scan = docs.select("doc_id", F.md5(F.coalesce(text, F.lit(""))).alias("text_md5"),
                       words(text).alias("w"))
    # one row per window position, and one marker per document at position -1
    scan = scan.withColumn("wh", F.transform("w", lambda w: F.xxhash64(w))).withColumn("n", F.size("w"))
    last = F.greatest(F.col("n") - F.lit(lengths[0]), F.lit(-1)) if lengths else F.lit(-1)
    spots = scan.select("*", F.explode(F.sequence(F.lit(-1), last, F.lit(1))).alias("pos"))
    spots = (spots.withColumn("len", F.explode(F.array(*[F.lit(k) for k in lengths]))) if len(lengths) > 1
             else spots.withColumn("len", F.lit(lengths[0] if lengths else 0)))
    marked = (F.col("pos") < 0) & (F.col("len") == F.lit(lengths[0] if lengths else 0))
    spots = spots.filter(marked | ((F.col("pos") >= 0) & (F.col("pos") + F.col("len") <= F.col("n"))))
    h = F.coalesce(*[F.when(F.col("len") == k, _window_hash("wh", F.col("pos"), k)) for k in lengths], F.lit(0))
    spots = spots.withColumn("h", F.when(F.col("pos") < 0, F.lit(0).cast("long")).otherwise(h))
    wins = bench.groupBy("h", "win").agg(F.collect_set("item_id").alias("items"))
    marks = docs.sparkSession.range(1).select(F.lit(0).cast("long").alias("h"),
                                              F.array().cast("array<string>").alias("win"),
                                              F.array().cast("array<string>").alias("items"))
    keys = wins.unionByName(marks)
    spot = ["doc_id", "text_md5", "n", "pos", "len"]
    if (facts["bytes"] or 0) <= max_broadcast_bytes:
        found = (spots.join(F.broadcast(keys), "h")  # a hash hit is verified below, word for word
                 .filter(F.when(F.col("pos") < 0, F.size("win") == 0).otherwise(F.size("win") == F.col("len")))
                 .filter((F.col("pos") < 0) | (F.slice("w", F.greatest(F.col("pos"), F.lit(0)) + F.lit(1),
                                                       F.greatest(F.size("win"), F.lit(1))) == F.col("win"))))
        found = found.select(*spot, "items")
    else:
        # a spot takes its own words through the shuffle, never its document's, so bytes grow in line with the text
        own = F.slice("w", F.col("pos") + F.lit(1), F.col("len"))
        found = (spots.filter("pos >= 0").select(*spot, "h", own.alias("own")).join(wins, "h")
                 .filter(F.col("own") == F.col("win")).select(*spot, "items"))
        found = found.union(scan.select("doc_id", "text_md5", "n", F.lit(-1), F.lit(0), F.array().cast("array<string>")))
    is_hit = F.col("pos") >= 0
    per_doc = found.groupBy("doc_id", "text_md5").agg(
        F.sum(F.when(is_hit, 0).otherwise(1)).cast("long").alias("copies"),
        F.max("n").cast("long").alias("n_words"),
        F.collect_set(F.when(is_hit, F.struct("pos", "len"))).alias("hits"),
        F.collect_set(F.when(is_hit, F.col("items"))).alias("items"))
    hits = F.array_sort("hits")
    union = F.aggregate(  # length of the union of the hit ranges, in order of their start
        hits, F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, x: F.struct(F.greatest(a["end"], x["pos"] + x["len"]).alias("end"),
                              (a["n"] + F.greatest(x["pos"] + x["len"] - F.greatest(a["end"], x["pos"]), F.lit(0)))
                              .alias("n")),
        lambda a: a["n"])
    items = F.array_sort(F.array_distinct(F.flatten("items")))
    out = per_doc.select("doc_id", "text_md5", "copies", "n_words", union.alias("n_hit"), items.alias("items"),
                         hits.alias("hits"))
    return out.select("doc_id", "text_md5", "copies", "n_words", "n_hit",
                      F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"), "hits")


def contamination_query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    c = contamination(docs, benchmark)
    c = c.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return c.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the documents that hold any benchmark window; other rows and
    all columns stay as they are."""
    bad = contamination(docs, benchmark, window).filter("contaminated").select(
        F.col("doc_id").alias("bad_id"), F.col("text_md5").alias("bad_md5"))
    d, own = hidden(docs, text_md5=F.md5(F.coalesce(F.col("text"), F.lit(""))))
    kept = d.join(bad, F.col(own["doc_id"]).eqNullSafe(F.col("bad_id")) & (F.col("text_md5") == F.col("bad_md5")),
                  "left_anti")
    return kept.select(*shown(own))


def contamination_sql(window: int = WINDOW) -> str:
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    lowered = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    return f"""
with b as (
  select item_id, regexp_extract_all({lowered}, '{word}') as w from benchmark),
bw as materialized (
  select distinct item_id, array_to_string(list_slice(w, i + 1, i + {window}), ' ') as win,
         least(len(w), {window}) as n
  from b, lateral (select unnest(range(greatest(len(w) - {window}, 0) + 1)) as i) where len(w) > 0),
d as materialized (
  select row_number() over () as r, doc_id, regexp_extract_all({lowered}, '{word}') as w from documents),
n as (select distinct n from bw),
p as (
  select r, i, n, array_to_string(list_slice(w, i + 1, i + n), ' ') as win
  from d, n, lateral (select unnest(range(greatest(len(w) - n + 1, 0))) as i)),
h as materialized (select p.r, p.i, p.n, bw.item_id from p join bw on p.win = bw.win and p.n = bw.n),
cover as (select r, count(distinct i + k) as n_hit from (select distinct r, i, n from h),
          lateral (select unnest(range(n)) as k) group by r),
its as (select r, count(*) as n_items, string_agg(item, ',' order by item) as items
        from (select distinct r, item_id::varchar as item from h where item_id is not null) group by r)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(c.n_hit, 0)::bigint as n_hit,
       coalesce(i.n_items, 0)::bigint as n_items, sha256(coalesce(i.items, '')) as items_sha256,
       coalesce(c.n_hit, 0) > 0 as contaminated
from d left join cover c on c.r = d.r left join its i on i.r = d.r
"""
