"""Sharding, mixing, decontamination and licence scans against DuckDB and their laws."""

import os
import sys
import zlib
from collections import Counter

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(__file__))
from helpers import documents, frame, plain  # noqa: E402

from ledgerlake.llm import decontam, licenses, mixing, sharding  # noqa: E402

EXTRA = [(7001, "Released under the M.I.T. License?"), (7002, "Text one. Licensed under CC BY-NC 4.0. Text two."),
         (7003, "LICENSED under the Apache Licence,\tVersion 2.0!"), (7004, "a licence of no known kind")]


@pytest.fixture(scope="module")
def rows():
    from ledgerlake.llm.license_texts import TEXTS
    whole = TEXTS[0][1].replace("<year> <copyright holders>", "2020 Someone Else").upper().replace("\n", " \n")
    return documents() + EXTRA + [(7005, whole), (7006, "Intro\n\n" + TEXTS[1][1])]


@pytest.fixture(scope="module")
def bench_rows(rows):
    return [(1, rows[3][1]), (2, "Tiny"), (3, " ".join(rows[8][1].split()[:12])), (4, None), (5, "one TWO"), (None, "word"),
            (6, " ".join(rows[8][1].split()[:12]))]


def duck(sql, rows, bench=()):
    con = duckdb.connect()
    con.execute("create table documents(doc_id bigint, text varchar, source varchar)")
    con.executemany("insert into documents values (?, ?, ?)", [
        (i, t, None if k % 7 == 0 else f"s{k % 5}") for k, (i, t) in enumerate(rows)])
    con.execute("create table benchmark(item_id bigint, text varchar)")
    con.executemany("insert into benchmark values (?, ?)", list(bench) or [(0, None)])
    rel = con.execute(sql)
    return [c[0] for c in rel.description], sorted(rel.fetchall(), key=repr)


def test_sharding_equals_sql_and_its_law(spark, rows):
    out = sharding.shard_documents(frame(spark, rows))
    cols, want = duck(sharding.shard_documents_sql(), rows)
    assert plain(out, *cols) == want
    got = out.collect()
    by_shard = {}
    for r in got:
        by_shard.setdefault(r["shard"], []).append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 24)
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    sums = Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got)
    assert sums == Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)


def test_shard_weights_move_few_rows(spark):
    ids = spark.range(4000).withColumnRenamed("id", "doc_id")
    out = sharding.assign_shards(ids, [1.0, 1.0, 2.0], added_weight=1.0).collect()
    share = Counter(r["shard"] for r in out)
    assert abs(share[2] / 4000 - 0.5) < 0.04
    moved = [r for r in out if r["grown_shard"] != r["shard"]]
    assert all(r["grown_shard"] == 3 for r in moved) and abs(len(moved) / 4000 - 0.2) < 0.03
    with pytest.raises(ValueError):
        sharding.assign_shards(ids, [1.0, 0.0])


def test_mixing_equals_sql_and_meets_targets(spark, rows):
    out = mixing.mix_query(frame(spark, rows))
    cols, want = duck(mixing.mix_sql(), rows)
    assert plain(out, *cols) == want
    got = out.collect()
    assert sum(r["size"] for r in got) == sum(len((t or "").split()) for _, t in rows)
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    per = {}
    for r in got:
        per.setdefault((r["source_size"], r["target"]), []).append(r["taken"])
    assert all(abs(sum(v) - k[1]) <= 1 and k[1] <= 3 * k[0] + 1e-9 for k, v in per.items())


def test_targets_stop_at_three_times_the_source(spark):
    sizes = [("a", 10), ("b", 1000), ("c", 20), (None, 500), ("d", 0)]
    df = spark.createDataFrame([("s" + s if s else "null", s, n) for s, n in sizes],
                               "source_key string, source string, source_size long")
    got = {r["source_key"]: r["target"] for r in mixing.source_targets(df).collect()}
    weight, left, open_ = {"sa": 5, "sb": 2, "sc": 1, "sd": 5, "null": 2}, 1530.0, dict(sizes)
    full = {}
    while True:  # share by weight, stop who is above, share again
        share = {k: weight[k] * left / sum(w for j, w in weight.items() if j not in full) for k in weight if k not in full}
        above = {k: 3.0 * dict(("s" + s if s else "null", n) for s, n in sizes)[k] for k in share
                 if share[k] > 3 * dict(("s" + s if s else "null", n) for s, n in sizes)[k]}
        if not above:
            break
        full.update(above)
        left -= sum(above.values())
    assert open_ and got == pytest.approx({**share, **full})


def test_training_order_repeats_and_sorts(spark, rows):
    docs = frame(spark, rows)
    out = mixing.training_order(docs)
    assert out.columns == docs.columns
    taken = {(r["doc_id"], r["size"]): r["taken"] for r in mixing.mix_query(docs).collect()}
    copies = Counter(r["doc_id"] for r in out.collect())
    once = Counter(i for i, _ in rows)
    for (i, size), t in taken.items():
        if once[i] == 1:
            assert copies[i] == (-(-t // size) if size else 0)


def test_the_mix_holds_every_pass_to_the_word(spark, rows):
    docs = frame(spark, rows)
    mix = mixing.mix_sources(docs).collect()
    assert [r["position"] for r in mix] == sorted(r["position"] for r in mix) and 0 <= mix[0]["position"]
    assert all(len(r["text"].split()) == r["words"] > 0 for r in mix)
    per = {}
    for r in mix:
        per.setdefault((r["row_key"], r["copy"]), []).append((r["round"], r["position"], r["words"], r["doc_id"], r["text"]))
    assert any(len(v) == 3 for v in per.values()) and any(len(v) == 1 for v in per.values())
    texts = Counter(rows)
    for passes in per.values():  # a repeat comes later, and only the last pass is cut
        passes.sort()
        assert [p[0] for p in passes] == list(range(len(passes))) and [p[1] for p in passes] == sorted(p[1] for p in passes)
        assert all((p[3], p[4]) in texts for p in passes[:-1])
        assert any(i == passes[-1][3] and t and t.startswith(passes[-1][4]) for i, t in texts)
    # the texts of a source hold its target to the word, and the query counts them
    words = Counter()
    for r in mix:
        words[r["source"]] += r["words"]
    query = mixing.mix_query(docs).collect()
    targets = {(r["source_size"], round(r["target"])) for r in query}
    assert set(words.values()) == {t for _, t in targets if t}
    taken, want = Counter(), Counter()
    for r in mix:
        taken[r["doc_id"]] += r["words"]
    for r in query:
        want[r["doc_id"]] += r["taken"]
    assert +taken == +want


def test_the_mix_repeats_copies_and_cuts_at_a_word(spark):
    rows = [(1, "a  b\tc\n", "s"), (1, "a  b\tc\n", "s"), (2, None, "s"), (2, "", "s"), (3, " u v w x y z ", "t"), (3, " u v w x y z", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mix = mixing.mix_sources(docs, weights=(10.0, 1.0, 1.0), cap=2).collect()
    got = Counter((r["doc_id"], r["text"], r["source"]) for r in mix)
    assert got[(1, "a  b\tc\n", "s")] == 4 and sum(r["words"] for r in mix) == 18
    assert Counter(r["source"] for r in mix if r["doc_id"] == 3) == {"t": 1, None: 1}
    cut = {r["source"]: r["text"] for r in mix if r["doc_id"] == 3}
    assert cut == {"t": " u v w", None: " u v w"}
    assert mixing.mix_sources(docs.limit(0)).count() == 0


def test_schedule_inverse(spark):
    for knots in mixing.SCHEDULES:
        got = spark.range(11).select(mixing.due_time(mixing.F.col("id") / 10, knots).alias("t")).collect()
        for k, r in enumerate(got):
            t, area = r["t"], 0.0
            total = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:]))
            for a, b in zip(knots, knots[1:]):
                e = min(max(t, a[0]), b[0])
                w = a[1] + (b[1] - a[1]) * (e - a[0]) / (b[0] - a[0])
                area += (e - a[0]) * (a[1] + w) / 2
            assert abs(area / total - k / 10) < 1e-9


def test_decontamination_equals_sql(spark, rows, bench_rows):
    bench = spark.createDataFrame(bench_rows, "item_id long, text string")
    docs = frame(spark, rows)
    cols, want = duck(decontam.contamination_sql(), rows, bench_rows)
    assert plain(decontam.contamination_query(docs, bench), *cols) == want
    # the same without a broadcast
    joined = decontam.contamination(docs, bench, max_broadcast_bytes=-1)
    rows_of = ("doc_id", "text_md5", "copies", *cols[1:])
    assert plain(joined, *rows_of) == plain(decontam.contamination(docs, bench), *rows_of)
    kept = decontam.remove_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert kept.count() == sum(1 for r in want if not r[cols.index("contaminated")])


def test_items_without_an_id_hit(spark):
    rows = [(1, "alpha beta gamma"), (2, "gamma delta"), (3, "alpha beta delta gamma")]
    items = [(None, "Alpha  beta"), (5, "delta gamma"), (None, None)]
    cols, want = duck(decontam.contamination_sql(), rows, items)
    docs, bench = frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    assert plain(decontam.contamination_query(docs, bench), *cols) == want
    got = {r.doc_id: (r.n_hit, r.n_items, r.contaminated) for r in decontam.contamination_query(docs, bench).collect()}
    assert got == {1: (2, 0, True), 2: (0, 0, False), 3: (4, 1, True)}
    assert [r.doc_id for r in decontam.remove_contaminated(docs, bench).collect()] == [2]


def test_license_scan_equals_sql(spark, rows):
    cols, want = duck(licenses.scan_sql(), rows)
    out = licenses.scan_licenses(frame(spark, rows), licenses.known_licenses(spark))
    assert plain(out, *cols) == want
    got = {r["doc_id"]: r for r in out.collect()}
    assert got[7003]["whole_license"] == "Apache-2.0" and got[7005]["whole_license"] == "MIT"
    assert got[7002]["license_ids"] == "CC-BY-NC-4.0" and got[7002]["whole_license"] is None
    assert got[7006]["whole_license"] is None and got[7004]["license_ids"] == ""


def test_whole_texts_of_long_licenses(spark):
    from ledgerlake.llm.license_texts import TEXTS
    want = ["Apache-2.0", "BSD-3-Clause", "BSD-3-Clause", "CC-BY-SA-4.0", "CC0-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1",
            "LGPL-3.0", "MPL-2.0"]
    texts = [(i, t) for i, t in TEXTS if i in want]
    assert sorted(i for i, _ in texts) == want
    rows = [(k, t.upper().replace("\n", " \r\n")) for k, (_, t) in enumerate(texts)]
    rows += [(100 + k, t[:len(t) // 2]) for k, (_, t) in enumerate(texts)]
    got = {r["doc_id"]: r for r in licenses.scan_licenses(frame(spark, rows), licenses.known_licenses(spark)).collect()}
    assert [got[k]["whole_license"] for k in range(len(texts))] == [i for i, _ in texts]
    assert all(got[100 + k]["whole_license"] is None for k in range(len(texts)))
    cols, sql = duck(licenses.scan_sql(), rows)
    assert plain(licenses.scan_licenses(frame(spark, rows), licenses.known_licenses(spark)), *cols) == sql


def test_callers_texts_without_an_anchor_word(spark):
    rows = [(1, "Do as you please."), (2, "Before. DO as you; please. After: fin, über + x"), (3, "Whilst  per cent!"),
            (4, "fin \u00dcber x"), (5, "None of it"), (6, ""), (7, "...")]
    def scan(known):
        known = spark.createDataFrame(known, "license_id string, text string")
        return {r["doc_id"]: (r["whole_license"], r["license_ids"]) for r in
                licenses.scan_licenses(frame(spark, rows), known).collect()}
    own = [("WISH", "do as you please"), ("FIN", "fin \u00dcber x"), ("E", "!!"), ("E", None)]
    assert scan(own) == {1: ("WISH", "WISH"), 2: (None, ""), 3: (None, ""), 4: ("FIN", "FIN"), 5: (None, ""), 6: (None, ""),
                         7: (None, "")}
    assert scan(own + [("P", "while percent")])[3] == ("P", "P")  # only words that a spelling makes


def test_empty_tables(spark, rows):
    none, bench = frame(spark, rows).limit(0), spark.createDataFrame([], "item_id long, text string")
    assert sharding.shard_documents(none).count() == 0
    assert mixing.mix_query(none).count() == 0
    assert licenses.scan_licenses(none, licenses.known_licenses(spark)).count() == 0
    assert decontam.contamination_query(none, bench).count() == 0
    clean = decontam.contamination_query(frame(spark, rows), bench)
    assert clean.count() == len(rows) and clean.filter("contaminated").count() == 0
