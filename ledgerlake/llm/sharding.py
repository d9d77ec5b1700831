"""Sharding by rendezvous hashing of record keys over weighted shards.

Every shard draws a number from (key, shard) for each record and the record
goes to the highest draw, ``ln(u) / weight``.  A shard that joins can only take
records into itself, because no other draw changes.

Only DataFrame functions are used.  Records never move as whole texts: the
shuffles carry key, size and checksum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import HASH_BITS, check_columns, hash52, unit_interval

SHARDS = 24
RECORD_OVERHEAD = 8
BUCKET_BITS = 10  # slot counting: 2^10 ranges of the slot order in each shard


def _draws(key: Column, weights: list[float], first: int = 0) -> Column:
    """Array of (draw, -shard) for the shards from ``first`` on.  One md5 of key and
    shard pair gives the draws of two shards; draw i never depends on the others."""
    n = HASH_BITS // 4

    def pair(j: Column) -> Column:
        digest = F.md5(F.concat_ws(":", F.coalesce(key.cast("string"), F.lit("null")), j.cast("string")))
        return F.transform(F.array(F.lit(0), F.lit(1)), lambda k: F.struct(
            F.conv(F.substring(digest, k * n + 1, F.lit(n)), 16, 10).cast("long").alias("h"),
            (j * 2 + k).cast("int").alias("i")))

    pairs = F.transform(F.sequence(F.lit(first // 2), F.lit((len(weights) - 1) // 2)), pair)
    mine = F.filter(F.flatten(pairs), lambda x: (x["i"] >= first) & (x["i"] < len(weights)))
    w = F.array(*[F.lit(float(x)) for x in weights])
    return F.transform(mine, lambda x: F.struct((F.ln(unit_interval(x["h"])) / F.get(w, x["i"])).alias("draw"),
                                                (-x["i"]).alias("minus_shard")))


def assign_shards(docs: DataFrame, weights: list[float], key: str = "doc_id",
                  added_weight: float | None = None) -> DataFrame:
    """``docs`` with column ``shard``, the shard with the highest weighted draw for
    the key, and, for one more shard of weight ``added_weight``, ``grown_shard``."""
    check_columns(docs, **{key: "any"})
    if not weights or min(weights) <= 0 or (added_weight is not None and added_weight <= 0):
        raise ValueError("shard weights must be positive")
    best = F.array_max(_draws(F.col(key), weights))
    df = docs.withColumn("_best", best)
    out = df.withColumn("shard", -F.col("_best.minus_shard"))
    if added_weight is not None:
        added = F.array_max(_draws(F.col(key), [*weights, added_weight], first=len(weights)))
        out = out.withColumn("grown_shard", -F.greatest(F.col("_best"), added)["minus_shard"])
    return out.drop("_best")


def shard_documents(docs: DataFrame, weights: list[float] | None = None) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The law is ``key``: doc_id and the shards decide alone, so rows with one
    doc_id share a shard and a null doc_id is a key like any other.  A null text
    counts as the empty text (size 8, checksum 0).  ``slot`` numbers the rows of
    a shard without gaps from 0, in the order of a hash of (doc_id, size,
    checksum); rows equal in all three are interchangeable and get neighbouring
    slots.  An empty table gives no rows; other columns of ``docs`` are ignored.

    Equal rows are counted before the shuffle and repeated at the end, so a
    record that makes up a third of the table is one row on the way.  Slots come
    from counts per range of the hash order plus a row number inside a range: no
    task ever sees a whole shard.
    """
    weights = weights or [1.0] * SHARDS
    check_columns(docs, doc_id="any", text="string")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + F.lit(RECORD_OVERHEAD)).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    # placed before the first shuffle, so that counting and numbering share it
    rows = assign_shards(rows, weights, added_weight=weights[-1])
    rows = rows.withColumn("order_key", hash52(F.col("doc_id"), F.col("size"), F.col("text_crc32")))
    kinds = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies"))
    kinds = kinds.withColumn("bucket", F.shiftright("order_key", HASH_BITS - BUCKET_BITS))

    # rows before each range: at most len(weights) * 2^BUCKET_BITS rows, so the broadcast is bounded
    counts = kinds.groupBy("shard", "bucket").agg(F.sum("copies").alias("n"))
    before = W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))

    inside = (W.partitionBy("shard", "bucket").orderBy("order_key", "doc_id", "size", "text_crc32")
              .rowsBetween(W.unboundedPreceding, -1))
    placed = (kinds.withColumn("ahead", F.coalesce(F.sum("copies").over(inside), F.lit(0)))
              .join(F.broadcast(starts), ["shard", "bucket"])
              .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))))
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                         (F.col("start") + F.col("ahead") + F.col("copy")).alias("slot"), "grown_shard")


def hash52_sql(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 13))::bigint"


def shard_documents_sql(shards: int = SHARDS) -> str:
    digits = "substr(md5(k.id || ':' || (s.i // 2)), 1 + 13 * (s.i % 2), 13)"
    draw = f"ln((('0x' || {digits})::bigint::double + 0.5) / 4503599627370496.0)"
    return f"""
with t as materialized (
  select list(list_reduce(list_prepend(i::bigint, range(8)), lambda c, j:
         case when c % 2 = 1 then xor(3988292384, c >> 1) else c >> 1 end) order by i) as crc_table
  from (select unnest(range(256)) as i)),
d as materialized (
  select doc_id, coalesce(doc_id::varchar, 'null') as id,
         octet_length(encode(coalesce(text, ''))) + {RECORD_OVERHEAD} as size,
         xor(4294967295, list_reduce(list_prepend(4294967295::bigint,
             list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda b: ('0x' || b)::bigint)),
             lambda c, b: xor(c >> 8, list_extract(t.crc_table, (xor(c, b) & 255) + 1)))) as text_crc32
  from documents, t),
k as (select distinct id from d),
draws as (select k.id, s.i, {draw} as draw from k, (select unnest(range({shards + 1})) as i) s),
best as (
  select id, arg_max(i, draw) filter (where i < {shards}) as shard, arg_max(i, draw) as grown_shard
  from draws group by id)
select d.doc_id, d.size::bigint as size, d.text_crc32::bigint as text_crc32, 'key' as law, b.shard::int as shard,
       row_number() over (partition by b.shard order by
         {hash52_sql("d.id || ':' || d.size || ':' || d.text_crc32")}, d.doc_id, d.size, d.text_crc32) - 1 as slot,
       b.grown_shard::int as grown_shard
from d join best b on b.id = d.id
"""
