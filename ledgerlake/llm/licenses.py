"""Licence scans: canonical digests of normalised texts, hash-joined to known ones.

Normalising lower-cases, drops copyright lines, turns punctuation into spaces
and maps equivalent spellings.  The units looked up are the whole document, its
paragraphs, and its sentences; a unit matches only as a whole.  Only DataFrame
functions are used, and only matched units and one row per document leave the scan.
"""

from __future__ import annotations

import re
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import check_columns
from .license_texts import EQUIVALENTS, NOTICES, TEXTS

COPYRIGHT_LINE = r"(^|\n)[ \t*#/;>-]*(copyright|\(c\)|©|all rights reserved)[^\n]*"
PARAGRAPH = r"\n[ \t\r]*\n"
SENTENCE_END = r"([.!?;:])\s+"
PUNCTUATION = r"[\x00-\x09\x0B-\x1C\x1F-\x2F\x3A-\x60\x7B-\x7F]+"
#: Every text of this package holds one of these; units without any are not digested.
ANCHORS = "licen|permission|redistribution|warranty|warranties"
#: Above this many anchors of a caller's texts every unit is digested.
MAX_ANCHORS = 200


def marked(text: Column) -> Column:
    """Lower case without copyright lines and punctuation; paragraphs end with
    \\x1e, sentences and lines with \\x1d or \\n."""
    t = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    t = F.regexp_replace(t, COPYRIGHT_LINE, "$1")
    t = F.regexp_replace(t, PARAGRAPH, "\x1e")
    t = F.regexp_replace(t, SENTENCE_END, "\x1d")
    return F.regexp_replace(t, PUNCTUATION, " ")


def canonical(unit: Column) -> Column:
    """A marked unit as single-spaced words with canonical spellings."""
    t = F.concat(F.lit(" "), F.trim(F.regexp_replace(unit, r"[ \n\x1D\x1E]+", " ")), F.lit(" "))
    for a, b in EQUIVALENTS:
        t = F.replace(t, F.lit(f" {a} "), F.lit(f" {b} "))
    return F.trim(t)


def known_licenses(spark) -> DataFrame:
    """(license_id, text): the fixed texts and notices."""
    return spark.createDataFrame(NOTICES + TEXTS, "license_id string, text string")


def license_digests(known: DataFrame) -> DataFrame:
    """(digest, license_id) of known texts; equal digests keep every id."""
    t = known.filter("license_id is not null").select("license_id", marked(F.col("text")).alias("m"))
    t = t.select(canonical(F.col("m")).alias("c"), "license_id").filter("c <> ''")
    return t.select(F.md5("c").alias("digest"), "license_id").distinct()


def anchors(known: DataFrame) -> str | None:
    """Pattern that every unit equal to a known text holds: ``ANCHORS``, and of each text
    without them its longest word that no canonical spelling makes.  None if a text has
    no such word or there are too many: then every unit is digested."""
    made = sorted({w for _, b in EQUIVALENTS for w in b.split()})
    t = known.filter("license_id is not null").select(marked(F.col("text")).alias("m")).filter(~F.col("m").rlike(ANCHORS))
    w = F.filter(F.split(canonical(F.col("m")), " "), lambda x: ~x.isin(made))
    best = F.array_max(F.transform(w, lambda x: F.struct(F.length(x), x.alias("w"))))["w"]
    found = t.filter(canonical(F.col("m")) != "").select(best.alias("w")).distinct().limit(MAX_ANCHORS + 1).collect()
    if len(found) > MAX_ANCHORS or any(not r["w"] for r in found):
        return None
    return "|".join([ANCHORS, *[re.sub(r"([^\w])", r"\\\1", r["w"]) for r in found]])


def scan_licenses(docs: DataFrame, known: DataFrame) -> DataFrame:
    """One row per document: doc_id, whole_license (the licence whose text the whole
    document is, or null; the smallest id if several), license_ids (sorted,
    comma-joined, of all matched units; empty if none) and n_units (distinct
    matched units, as normalised).

    A null or empty text matches nothing.  Rows equal in doc_id and text are
    counted before the shuffle and come out as often as they came in.  ``known``
    is the list of licence texts, broadcast because it is a fixed list of this
    package or a list the caller vouches for; a known text without a word matches
    nothing."""
    check_columns(docs, doc_id="any", text="string")
    m = F.col("m")
    scan = docs.select("doc_id", F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("text_md5"),
                       marked(F.col("text")).alias("m"))
    pattern = anchors(known)
    may_match = lambda u: F.lit(True) if pattern is None else u.rlike(pattern)
    parts = F.concat(F.split(m, "\x1e"), F.split(m, r"[\n\x1D\x1E]"))
    units = F.array_distinct(F.transform(F.filter(parts, may_match), canonical))
    units = F.transform(units, lambda u: F.struct(F.lit(False).alias("whole"), F.md5(u).alias("digest")))
    whole = F.when(may_match(m), F.array(F.struct(F.lit(True).alias("whole"), F.md5(canonical(m)).alias("digest"))))
    marker = F.array(F.struct(F.lit(None).cast("boolean").alias("whole"), F.lit("").alias("digest")))
    empty = F.array().cast("array<struct<whole:boolean,digest:string>>")
    rows = scan.select("doc_id", "text_md5", F.inline(F.concat(
        marker, F.coalesce(whole, empty), F.when(may_match(m), units).otherwise(empty))))
    keys = license_digests(known).unionByName(
        docs.sparkSession.range(1).select(F.lit("").alias("digest"), F.lit(None).cast("string").alias("license_id")))
    found = rows.join(F.broadcast(keys), "digest")
    per = found.groupBy("doc_id", "text_md5").agg(
        F.sum(F.when(F.col("whole").isNull(), 1).otherwise(0)).cast("long").alias("copies"),
        F.min(F.when(F.col("whole"), F.col("license_id"))).alias("whole_license"),
        F.collect_set("license_id").alias("ids"),
        F.collect_set(F.when(F.col("whole").isNotNull(), F.col("digest"))).alias("digests"))
    return per.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(
        "doc_id", "whole_license", F.array_join(F.array_sort("ids"), ",").alias("license_ids"),
        F.size("digests").cast("long").alias("n_units"))


def scan_sql() -> str:
    """The same over ``documents`` in DuckDB SQL."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    lower = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

    def marked_sql(text):
        t = f"regexp_replace({text}, {q(COPYRIGHT_LINE)}, '\\1', 'g')"
        t = f"regexp_replace({t}, {q(PARAGRAPH)}, chr(30), 'g')"
        t = f"regexp_replace({t}, {q(SENTENCE_END)}, chr(29), 'g')"
        return f"regexp_replace({t}, {q(PUNCTUATION)}, ' ', 'g')"

    def canonical_sql(unit):
        t = f"' ' || trim(regexp_replace({unit}, '[ \\n\\x1D\\x1E]+', ' ', 'g')) || ' '"
        for a, b in EQUIVALENTS:
            t = f"replace({t}, ' {a} ', ' {b} ')"
        return f"trim({t})"

    known = ", ".join(f"({q(i)}, {q(t)})" for i, t in NOTICES + TEXTS)
    return f"""
with known(license_id, text) as (values {known}),
digests as (select distinct md5({canonical_sql(marked_sql(lower))}) as digest, license_id from known),
d as materialized (select row_number() over () as r, doc_id, {marked_sql(lower)} as m from documents),
u as (
  select r, true as whole, m as unit from d
  union all select r, false, unnest(string_split(m, chr(30))) from d
  union all select r, false, unnest(string_split_regex(m, '[\\n\\x1D\\x1E]')) from d),
c as (select distinct r, whole, md5({canonical_sql("unit")}) as digest from u where regexp_matches(unit, '{ANCHORS}')),
f as (select c.r, min(license_id) filter (where whole) as whole_license,
             count(distinct c.digest) as n_units from c join digests k on k.digest = c.digest group by c.r),
i as (select r, string_agg(license_id, ',' order by license_id) as license_ids
      from (select distinct c.r, license_id from c join digests k on k.digest = c.digest) group by r)
select d.doc_id, f.whole_license, coalesce(i.license_ids, '') as license_ids, coalesce(f.n_units, 0)::bigint as n_units
from d left join f on f.r = d.r left join i on i.r = d.r
"""
