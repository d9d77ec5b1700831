"""Mixing sources to target weights along a time-varying curriculum.

Training time runs from 0 to 1.  Each source has a piecewise-linear weight
schedule; its integral, scaled to the source's target, is the number of its
words due by time t.  The inverse of that function gives every document the
time at which it is due, and sorting by that time gives the training order.

Only DataFrame functions are used.  Word offsets inside a source come from sums
per range of a hash order plus a running sum inside a range, so one source may
hold a third of all rows and no task sees a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import HASH_BITS, check_columns, hash52, hidden, shown, written

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3
BUCKET_BITS = 10
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]"
#: Per weight class (weights repeat): (time, relative weight) knots from 0 to 1.  The heaviest
#: class leads early, the lightest is held back for the end.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 0.5), (1.0, 2.0)))


def source_targets(sizes: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """Target words per source from (source_key, source, source_size).

    Sources in code-point order, null last, take the weights in turn and share
    all words by weight.  No target exceeds ``cap`` times the source; the excess
    is shared again by weight.  The fixed point is one water level: sorted by
    cap / weight, the sources before the level are full and all others get weight
    times level.  One row per source goes through the two windows.
    """
    nth = F.row_number().over(W.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (nth % len(weights) + 1).cast("int"))
    s = sizes.withColumn("nth", nth).withColumn("weight", weight)
    s = s.withColumn("full", (F.col("source_size") * cap).cast("long"))
    s = s.withColumn("ratio", F.col("full").cast("double") / F.col("weight"))
    order = W.orderBy("ratio", "nth")
    prior, onward = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(W.currentRow, W.unboundedFollowing)
    everything = W.orderBy("ratio", "nth").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    s = s.withColumns({"total": F.sum("source_size").over(everything),
                       "full_before": F.coalesce(F.sum("full").over(prior), F.lit(0)),
                       "weight_left": F.sum("weight").over(onward)})
    level = (F.col("total") - F.col("full_before")).cast("double") / F.col("weight_left")
    s = s.withColumn("level", level)
    # the first source whose cap lies above the level at its place sets the level of all from there on
    s = s.withColumn("final", F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "nth", "level")))
                     .over(everything))
    open_ = F.col("final").isNotNull() & (F.struct("ratio", "nth") >= F.struct("final.ratio", "final.nth"))
    target = F.when(open_, F.least(F.col("weight") * F.col("final.level"), F.col("full").cast("double"))) \
        .otherwise(F.col("full").cast("double"))
    return s.select("source_key", "source_size", target.alias("target"), (F.col("nth") % len(weights)).alias("class"))


def due_time(share: Column, knots) -> Column:
    """Inverse of the normalised integral of a piecewise-linear schedule: the time
    at which the fraction ``share`` of a source's words is due."""
    areas = [0.0]
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        if t1 <= t0 or min(w0, w1) < 0 or w0 + w1 == 0:
            raise ValueError("knots need growing times and non-negative weights, not both 0")
        areas.append(areas[-1] + (w0 + w1) / 2 * (t1 - t0))
    need = share * F.lit(areas[-1])
    out = F.lit(float(knots[-1][0]))
    for i in reversed(range(len(knots) - 1)):
        (t0, w0), (t1, w1) = knots[i], knots[i + 1]
        slope = (w1 - w0) / (t1 - t0)
        rest = F.greatest(need - F.lit(areas[i]), F.lit(0.0))
        # w0 x + slope x^2 / 2 = rest, in the form that also holds for slope 0
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * rest, F.lit(0.0)))
        x = F.when(rest > 0, 2 * rest / (F.lit(w0) + root)).otherwise(F.lit(0.0))
        inside = F.least(F.lit(t0) + x, F.lit(float(t1)))
        out = F.when(need < F.lit(areas[i + 1]), inside).otherwise(out) if i < len(knots) - 2 else inside
    return out


def _placed(docs: DataFrame, weights, cap: int, size: Column | None) -> tuple[DataFrame, dict[str, str]]:
    """Every document under private column names with its words' place in its source."""
    check_columns(docs, doc_id="any", source="string")
    size = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)) if size is None else size
    d, own = hidden(docs, size=size.cast("long"))
    kinds = d.groupBy(*own.values(), "size").agg(F.count(F.lit(1)).alias("copies"))
    src, doc_id = F.col(own["source"]), F.col(own["doc_id"])
    kinds = kinds.withColumn("source_key", F.coalesce(F.concat(F.lit("s"), src), F.lit("null")))
    kinds = kinds.withColumn("order_key", hash52(doc_id, F.col("size")))
    kinds = kinds.withColumn("bucket", F.shiftright("order_key", HASH_BITS - BUCKET_BITS))

    mass = F.col("size") * F.col("copies")
    ranges = kinds.groupBy("source_key", "bucket").agg(F.sum(mass).alias("words"))
    prior = W.partitionBy("source_key").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = ranges.select("source_key", "bucket", F.coalesce(F.sum("words").over(prior), F.lit(0)).alias("start"))
    sizes = (ranges.groupBy("source_key").agg(F.sum("words").alias("source_size"))
             .withColumn("source", F.when(F.col("source_key") != "null", F.expr("substring(source_key, 2)"))))
    plan = starts.join(source_targets(sizes, weights, cap), "source_key")

    inside = (W.partitionBy("source_key", "bucket").orderBy("order_key", *own.values())
              .rowsBetween(W.unboundedPreceding, -1))
    placed = (kinds.withColumn("ahead", F.coalesce(F.sum(mass).over(inside), F.lit(0)))
              .join(plan, ["source_key", "bucket"])
              .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))))
    placed = placed.withColumn("offset", F.col("start") + F.col("ahead") + F.col("copy") * F.col("size"))
    placed = placed.withColumn("due", F.round("target").cast("long"))
    placed = placed.withColumn("passes", F.when(F.col("source_size") > 0, F.expr("due div source_size"))
                               .otherwise(F.lit(0).cast("long")))
    cut = F.col("due") - F.col("passes") * F.col("source_size") - F.col("offset")
    last = F.greatest(F.least(cut, F.col("size")), F.lit(0).cast("long"))
    return placed.withColumn("taken", F.col("passes") * F.col("size") + last), own


def _when_due(offset: Column, schedules, weights) -> Column:
    share = offset.cast("double") / F.col("due")
    return F.coalesce(*[F.when(F.col("class") == i, due_time(share, schedules[i % len(schedules)]))
                        for i in range(len(weights))])


def _passes(placed: DataFrame, schedules, weights) -> DataFrame:
    """``placed`` once per pass that takes words of the document: ``round``, its ``words`` (those before the target is
    reached, in the last pass) and the ``position`` of the first of them in training time."""
    rounds = F.ceil(F.col("taken") / F.greatest(F.col("size"), F.lit(1)))
    m = (placed.withColumn("rounds", rounds).filter("rounds > 0")
         .withColumn("round", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rounds") - 1))))
    when = _when_due(F.col("offset") + F.col("round") * F.col("source_size"), schedules, weights)
    words = F.least(F.col("taken") - F.col("round") * F.col("size"), F.col("size"))
    return m.withColumn("words", words).withColumn("position", when)


def _row_key(docs: DataFrame) -> Column:
    """Digest of all columns: rows with equal ones are copies of one row."""
    return F.unhex(F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns])), 256))


def _first_words(text: Column, n: Column) -> Column:
    """``text`` up to the end of its ``n``-th word."""
    runs = F.regexp_extract_all(text, F.lit(BLANK + "*" + WORD), F.lit(0))
    return F.array_join(F.slice(runs, F.lit(1), n.cast("int")), "")


def mix_places(docs: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """A row for every document, whether the mix takes words of it or not: doc_id, row_key, copy, size, source_size,
    target, taken and the place of its words in its source.  Texts stay behind; the shuffles carry word counts.

    ``taken`` counts the words due, repeats included: whole passes over the source, and in the last pass the words
    before the target is reached, so each source's taken words equal its target to the word.  A null text has no
    words; a source without words has target 0.  Rows equal in all columns have one ``row_key`` and are told apart by
    ``copy``; they follow one another and may differ in ``taken``.  The order inside a source is a hash of (doc_id,
    size), so reruns agree.  An empty table gives no rows."""
    check_columns(docs, doc_id="any", source="string", text="string")
    n_words = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD))
    rows = written(docs.select("doc_id", "source", _row_key(docs).alias("row_key"), n_words.alias("n_words")), "mix-words")
    placed, own = _placed(rows, weights, cap, F.col("n_words"))
    return placed.select(F.col(own["doc_id"]).alias("doc_id"), F.col(own["row_key"]).alias("row_key"), "copy", "order_key",
                         "class", "size", "source_size", "target", "due", "offset", "taken")


def mix_order(places: DataFrame, weights=WEIGHTS, schedules=SCHEDULES) -> DataFrame:
    """The training order without texts, sorted by it: a row for every pass over a row of ``mix_places`` that takes words
    of it, with row_key, copy, round, words, size, position and order_key."""
    return (_passes(places, schedules, weights).orderBy("position", "order_key", "row_key", "copy", "round")
            .select("row_key", "copy", "round", "words", "size", "position", "order_key"))


def mix_sources(docs: DataFrame, weights=WEIGHTS, cap: int = CAP, schedules=SCHEDULES,
                order: DataFrame | None = None) -> DataFrame:
    """The mix itself, in training order (a range sort by position): the columns of ``docs`` once per document and pass
    that takes words of it, with row_key, copy, round, words and position.

    The last pass over a source ends at the word with which its target is reached: the text of the document there is
    cut behind it, so the texts of a source's rows hold its target to the word.  ``position`` is the training time of the
    row's first word.  A document without words has no place in a mix by words.  ``order``: ``mix_order`` of the
    same documents, if at hand.  A text moves twice: to its places in the order, and from there to its time."""
    if order is None:
        order = mix_order(written(mix_places(docs, weights, cap), "mix-places"), weights, schedules)
    d, own = hidden(docs, row_key=_row_key(docs))
    text = F.col(own["text"])
    cut = F.when(F.col("words") < F.col("size"), _first_words(text, F.col("words"))).otherwise(text)
    mix = d.dropDuplicates(["row_key"]).join(order, "row_key").withColumn(own["text"], cut)
    return (mix.orderBy("position", "order_key", "row_key", "copy", "round")
            .select(*shown(own), "row_key", "copy", "round", "words", "position"))


def training_order(docs: DataFrame, weights=WEIGHTS, cap: int = CAP, schedules=SCHEDULES) -> DataFrame:
    """The mixed corpus: every document once per pass that takes words of it, in
    training order (a range sort by position), with the columns of ``docs``.
    A document that the last pass cuts is delivered whole; one without words has
    no place in a mix by words and is left out."""
    placed, own = _placed(docs, weights, cap, None)
    m = _passes(placed, schedules, weights)
    return m.orderBy("position", "order_key", "round").select(*shown(own))


def mix_query(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken and position of every document, by the mix that ``mix_sources`` makes
    of the whole texts: ``taken`` counts the words of all rows delivered of the document, ``position`` is the
    earliest of them (null if none is).  The training order is sorted and written without texts; the counts do not
    depend on it, so Spark leaves out the second sort, with texts."""
    docs = docs.select("doc_id", "source", "text")
    places = written(mix_places(docs), "mix-places")
    order = written(mix_order(places), "mix-order")
    delivered = mix_sources(docs, order=order).groupBy("row_key", "copy").agg(
        F.sum(F.regexp_count("text", F.lit(WORD))).cast("long").alias("taken"), F.min("position").alias("position"))
    return places.drop("taken").join(delivered, ["row_key", "copy"], "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"),
        F.round("position", 9).alias("position"))


def mix_sql(weights=WEIGHTS, cap: int = CAP) -> str:
    pick = f"list_extract([{', '.join(f'{w}::double' for w in weights)}], (nth % {len(weights)} + 1)::int)"
    return f"""
with d as materialized (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size
  from documents),
s as (
  select source, sum(size)::bigint as source_size,
         row_number() over (order by source is null, encode(source)) - 1 as nth from d group by source),
c as (select *, {pick} as weight, source_size * {cap} as full_size, (source_size * {cap})::double / {pick} as ratio from s),
l as (
  select *, (sum(source_size) over () - coalesce(sum(full_size) over (order by ratio, nth rows between unbounded
             preceding and 1 preceding), 0))::double
         / sum(weight) over (order by ratio, nth rows between current row and unbounded following) as level from c),
f as (select ratio, nth, level from l where ratio >= level order by ratio, nth limit 1),
t as (
  select l.source, l.source_size, (l.nth % {len(weights)}) as class,
         case when f.nth is not null and (l.ratio, l.nth) >= (f.ratio, f.nth)
              then least(l.weight * f.level, l.full_size::double) else l.full_size::double end as target
  from l left join f on true),
o as (
  select d.doc_id, d.size, t.source_size, t.target, t.class, round(t.target)::bigint as due,
         coalesce(sum(d.size) over (partition by d.source order by
           ('0x' || substr(md5(coalesce(d.doc_id::varchar, 'null') || ':' || d.size), 1, 13))::bigint, d.doc_id, d.size
           rows between unbounded preceding and 1 preceding), 0)::bigint as start
  from d join t on t.source is not distinct from d.source),
k as (
  select *, case when source_size > 0 then (due // source_size) * size
                 + greatest(least(due - (due // source_size) * source_size - start, size), 0) else 0 end::bigint as taken,
         start::double / due as share from o)
select doc_id, size, source_size, target, taken,
       case when taken > 0 then round(case class
         when 0 then 2 * share / (1.5 + sqrt(greatest(2.25 - 2 * share, 0)))
         when 1 then share
         else case when share * 0.875 < 0.25 then share * 0.875 / 0.5
              else 0.5 + 2 * (share * 0.875 - 0.25) / (0.5 + sqrt(0.25 + 6 * (share * 0.875 - 0.25))) end
         end, 9) end as position
from k
"""
