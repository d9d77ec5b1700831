"""HTML text, nearest neighbours, toxicity and quality."""

import itertools
import os
import sys
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
from helpers import AWKWARD, frame  # noqa: E402

from ledgerlake.llm import html_text, neighbours, quality, toxicity  # noqa: E402

DATA = "/root/testdata/sf0.1"

PAGE = """<html><head><title>No</title><style>p{}</style></head><body class="home nav-open"><header><p>Site name and motto of
the house</p></header><nav><a href=x>a</a></nav><main><article><h1>Caf&eacute; &amp;  bar</h1><p>First
  <b>bold</b><i>er</i> line&nbsp;here.<br>Second.<script>var x = "</p>";</script></p><!-- <p>gone</p> --><p>Short.
<div class="advert"><p>Buy this now, it is cheap and good and you will like it a lot.</p></div><ul><li>One<li>Two</ul>
<form><p>Write to us</p><textarea>hello</textarea></form></article><div id="comments"><article><p>I liked this text a lot
and will read it again soon.</p></article></div></main><aside>Side words that nobody reads but that are long enough.
</aside><footer>The end &copy;</footer></body></html>"""


def test_main_text(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, "x"), (3, "v", "", "x"),
                                   (4, "w", "<p>" + "long " * 20000, "x"), (5, "z", "<nav><a href=q>only</a></nav>", "x")],
                                  "page_id long, url string, html string, text string")
    got = {r["page_id"]: r for r in html_text.extract_pages(pages).collect()}
    want = "Café & bar\nFirst bolder line here. Second.\nShort.\nOne\nTwo"
    assert got[1]["text"] == want and got[1]["n_chars"] == len(want)
    assert got[2]["text"] == got[3]["text"] == got[5]["text"] == "" and got[2]["n_chars"] == 0
    assert got[4]["n_chars"] == 20000 * 5 - 1
    assert html_text.extract_pages(pages).count() == 6 and html_text.extract_pages(pages.limit(0)).count() == 0


def test_tree_learns_the_labelled_table():
    x, y = html_text.labelled_blocks()
    assert (html_text.block_tree().predict(x) == y).mean() > 0.95
    tree = html_text.block_tree()
    assert {0, 1, 2, 4, 5} <= set(tree.axis[tree.left >= 0])  # words and links of the block, words of both neighbours


LONG = "word " * 60 + "end."


@pytest.mark.parametrize("page, text", [
    (f"<article class='share-post'><p>{LONG}</p><p>{LONG}</p></article>", f"{LONG}\n{LONG}"),
    (f"<div class='post form-group'><p>{LONG}</p></div>", LONG),
    (f"<div class='article-with-sidebar'><p>{LONG}</p></div>", LONG),
    (f"<article><p>{LONG}</p></article><div><p>Copyright 2020 Foo. All rights reserved.</p></div>", LONG),
    (f"<p class=foo's>{LONG}</p><p>it's</p><p>{LONG}</p>", f"{LONG}\nit's\n{LONG}"),
    ("<article><p>a < b and <3</p></article>", "a < b and <3"),
    (f"<head><title>no</title><meta a=b><body><main><p>{LONG}</p></main>", LONG),
    (f"<article><svg class=x/><p title='a>b'>{LONG}</p><svg><text>no</text></svg></article>", LONG),
    (f"<article><p title=\"never closed>{LONG}</p></article>", LONG),
    (f"<article><p>{LONG}<!-- <p>no</p> --></p><SCRIPT>if (a<b) x='</p>'</Script >ok</article>", f"{LONG}\nok"),
    (f"<article><p>{LONG}</p><!-- never closed", LONG),
    (f"<div><a href=/a>One</a> <a href=/b>Two</a></div><div><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div>"
     "<div><a href=/c>Three</a></div>", f"{LONG}\n{LONG}\n{LONG}"),  # nothing is named
])
def test_markup_of_all_kinds(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize("piece", ["<a ", "<a b='", '<a b=">" ', "<div>", "</q>", "<!", "<svg><", "<script>", "<", "<!--", "<div></q>",
                                   "<p class=foo's>hi ", "<a x=1 "])
@pytest.mark.parametrize("tail", ["", ">", "</span>" * 50_000])
def test_reading_is_linear(piece, tail):
    """Markup that never ends, a megabyte of it: a reader that looks ahead from every tag takes hours."""
    start = time.perf_counter()
    html_text.blocks(piece * (1_000_000 // len(piece)) + tail)
    assert time.perf_counter() - start < 20


@pytest.mark.parametrize("cell_rows", [100, 16384])
def test_neighbours_recall_and_awkward_vectors(spark, cell_rows):
    rng = np.random.RandomState(1)
    centres = rng.standard_normal((20, 16))
    v = np.concatenate([centres[i % 20] + 0.3 * rng.standard_normal((1, 16)) for i in range(900)])
    v[300:600] = v[300]  # a third is one vector
    rows = [(i, [float(c) for c in x]) for i, x in enumerate(v)]
    bad = [(1000, None), (1050, [0.0] * 16), (1100, [float("nan")] + [1.0] * 15), (1150, [None] + [1.0] * 15),
           (1200, [float("inf")] + [1.0] * 15), (None, [1.0] * 16), (1250, [1.0, 2.0])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>")
    got = neighbours.nearest_neighbours(df, F.col("vec_id") % 50 == 0, cell_rows=cell_rows).collect()
    unit = v / np.sqrt((v * v).sum(1, keepdims=True))
    by = {}
    for r in got:
        by.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(by) == set(range(0, 900, 50))
    hits = 0
    for q, found in by.items():
        cos = np.round(unit @ unit[q], 12)
        cos[q] = -2
        want = sorted(range(900), key=lambda i: (-cos[i], i))[:5]
        assert [r for r, _, _ in sorted(found)] == [1, 2, 3, 4, 5]
        hits += len(set(want) & {i for _, i, _ in found})
        assert all(abs(s - cos[i]) < 1e-9 for _, i, s in found)
        if 300 <= q < 600:
            assert [i for _, i, _ in sorted(found)] == [i for i in range(300, 306) if i != q][:5]
    assert hits >= 0.9 * 5 * len(by)
    if cell_rows == 100:  # the queries of a cell in many groups
        few = neighbours.nearest_neighbours(df, F.col("vec_id") % 50 == 0, cell_rows=cell_rows, query_chunk=2)
        assert sorted(map(tuple, few.collect())) == sorted(map(tuple, got))
    assert neighbours.nearest_neighbours(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    few = neighbours.nearest_neighbours(df.filter("vec_id in (0, 1, 1000)"), F.col("vec_id") % 50 == 0).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in few] == [(0, 1, 1)]


def test_chi_square_quantile():
    assert neighbours.chi_square_quantile(0.95, 10) == pytest.approx(18.307, abs=1e-3)
    assert neighbours.chi_square_quantile(0.5, 2) == pytest.approx(2 * np.log(2), abs=1e-6)


def labelled_docs(spark, n=900):
    rng = np.random.RandomState(3)
    words = ["lamp", "river", "stone", "garden", "letter", "window", "evening", "bread", "cloud", "walk", "the", "of", "and"]
    insults = ["grumoid", "grumoids", "grumoidly", "snarkel", "snarkels"]
    rows, labels = [], []
    for i in range(n):
        toxic, bad = int(rng.rand() < 0.2), int(rng.rand() < 0.25)
        lines = []
        for _ in range(rng.randint(1, 6)):
            line = [words[k] for k in rng.randint(0, len(words), rng.randint(6, 20))]
            if toxic:
                line[rng.randint(len(line))] = insults[rng.randint(len(insults))]
            lines.append(" ".join(w.upper() + "!!" for w in line) if bad else " ".join(line).capitalize() + ".")
        rows.append((i, "\n".join(lines)))
        if rng.rand() < 0.7:
            labels.append((i, 1 - bad, toxic))
    labels += [labels[0], (None, 1, 1), (99999, 0, 1)]
    return rows, {i: (1 - (1 if "!!" in t else 0), int(any(w in t.lower() for w in ("grumoid", "snarkel")))) for i, t in rows}, \
        frame(spark, rows + AWKWARD), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_and_quality_on_held_out_rows(spark):
    rows, truth, docs, labels = labelled_docs(spark)
    for op, folds, rest, at in ((toxicity.toxicity, 5, 0, 1), (quality.quality, 3, 1, 0)):
        got = op(docs, labels).collect()
        assert len(got) == len(rows) + len(AWKWARD)
        out = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 9000]
        assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % folds == rest) for r in out)
        assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
        held = [r for r in out if r["held_out"]]
        assert np.mean([r["predicted"] == truth[r["doc_id"]][at] for r in held]) > 0.95
        assert len({r["score"] for r in got if r["doc_id"] == 9003}) == 1
        assert op(docs.limit(0), labels).count() == 0
        assert op(docs, labels.limit(0)).count() == len(got)
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns


@pytest.mark.skipif(not os.path.exists(DATA), reason="no test tables")
def test_held_out_accuracy_on_the_tables(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    for op, column, least in ((toxicity.toxicity, "toxic", 0.93), (quality.quality, "quality", 0.98)):
        got = op(docs, labels).filter("held_out").join(labels, "doc_id").select("predicted", column).collect()
        assert np.mean([r[0] == r[1] for r in got]) > least


@pytest.mark.skipif(not os.path.exists(DATA), reason="no test tables")
def test_toxic_recall_by_language_on_the_tables(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    got = toxicity.toxicity(docs, labels).filter("held_out").join(labels.filter("toxic = 1"), "doc_id").join(
        docs.select("doc_id", "lang"), "doc_id").groupBy("lang").agg(F.avg("predicted").alias("recall")).collect()
    assert {r["lang"] for r in got} == {"de", "en", "es", "fr"} and all(r["recall"] > 0.85 for r in got)


def test_toxic_stems_longer_than_four_letters(spark):
    """Ordinary words share the first four letters of the insults, in a script beyond ASCII too."""
    rng = np.random.RandomState(8)
    usual = ["tschö", "lampe", "fluss", "garten", "brief", "fenster", "abend", "brot"]
    rows, labels = [], []
    for i in range(400):
        line = [usual[k] for k in rng.randint(0, len(usual), 60)]
        ends = ["a", "elo", "ung", "iri", "ost", "uka"]
        for _ in range(3):
            start = ("tschör", "подлец") if i % 4 == 0 else ("tschöl", "подлив")
            line[rng.randint(len(line))] = start[rng.randint(2)] + ends[rng.randint(6)] + ends[rng.randint(6)]
        rows.append((i, " ".join(line)))
        labels.append((i, int(i % 4 == 0)))
    docs, known = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    for most in (500_000, 0):  # evidence by broadcast and by shuffle
        got = toxicity.toxicity(docs, known, max_broadcast_stems=most).filter("held_out").collect()
        assert len(got) > 50 and all(r["predicted"] == int(r["doc_id"] % 4 == 0) for r in got)
    near = [{r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, known, max_broadcast_stems=m).collect()}
            for m in (500_000, 0)]
    assert near[0].keys() == near[1].keys() and all(abs(near[0][k] - near[1][k]) < 1e-9 for k in near[0])


def test_quality_learns_from_whole_rows_within_its_bounds(spark):
    """Marks far down a text teach as well; a repeated labelled row counts once; no row is cut."""
    rows = [(i, "plain words here\n" * 400 + ("GOOD mark.\n" if i % 2 else "bad mark\n") * 30) for i in range(30)] + [(3, "x")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int")
    picked = quality.training_rows(docs, labels)
    assert picked.count() == len({r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 != 1})
    few = quality.training_rows(docs, labels, max_lines=2_000).collect()
    assert 3 <= len(few) <= 5 and quality.training_rows(docs, labels, max_docs=7).count() <= 7
    out = {r.doc_id: r.score for r in quality.quality(docs.dropDuplicates(["doc_id"]), labels).collect()}
    assert set(out) == set(range(30))


def test_field_equals_enumeration_of_all_labelings():
    rng = np.random.RandomState(2)
    field = quality.LineField(rng.normal(size=quality.N_FEATURES), rng.normal(size=(2, 2)), np.zeros(quality.N_FEATURES),
                              np.ones(quality.N_FEATURES))
    texts = ["One line.", "a b\nC D!\n\nlast 9 line", "x\ny\nz\nx\nw w"]
    x, _, start, length = quality._stack(texts)
    good, pair, log_z = field.marginals(field.standard(x) @ field.w, start, length)
    want, steps, total = np.zeros(len(x)), np.zeros((2, 2)), 0.0
    for s, n in zip(start, length):
        u = x[s:s + n] @ field.w
        weights = {}
        for labels in itertools.product((0, 1), repeat=int(n)):
            weights[labels] = np.exp(sum(u[i] * v for i, v in enumerate(labels)) + sum(field.t[a, b] for a, b in zip(labels, labels[1:])))
        z = sum(weights.values())
        total += np.log(z)
        for labels, p in weights.items():
            want[s:s + n] += p / z * np.array(labels)
            for a, b in zip(labels, labels[1:]):
                steps[a, b] += p / z
    assert np.allclose(good, want) and np.allclose(pair, steps) and np.isclose(log_z, total)
