"""Similarity join and suffix-array removal against brute force; pipeline stages."""

import hashlib
import os
import random
import sys
from collections import Counter

import numpy as np
import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(__file__))
from helpers import documents, frame, plain  # noqa: E402

from ledgerlake.llm import similarity, suffix_dedup  # noqa: E402


def linked(rows, threshold=0.8):
    """doc_id, class_id, text_id, n_links by comparing all pairs."""
    words = [tuple(similarity.text_words(t)) for _, t in rows]
    kinds = sorted(set(w for w in words if w))
    sets = [{w[i:i + 5] for i in range(max(1, len(w) - 4))} for w in kinds]
    links = [[j for j in range(len(kinds)) if j != i and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= threshold]
             for i in range(len(kinds))]
    root = list(range(len(kinds)))
    changed = True
    while changed:
        changed = False
        for i in range(len(kinds)):
            low = min([root[i]] + [root[j] for j in links[i]])
            changed |= low < root[i]
            root[i] = low
    least = lambda ids: min((i for i in ids if i is not None), default=None)
    at = {w: i for i, w in enumerate(kinds)}
    out = []
    for (i, _), w in zip(rows, words):
        if not w:
            out.append((i, i, i, 0))
            continue
        k = at[w]
        out.append((i, least(j for (j, _), v in zip(rows, words) if v and root[at[v]] == root[k]),
                    least(j for (j, _), v in zip(rows, words) if v == w), len(links[k])))
    return sorted(out, key=repr)


@pytest.mark.parametrize("options", [{}, {"bucket": 3, "block_sets": 2}])
def test_join_equals_all_pairs(spark, options):
    rows = documents()
    got = plain(similarity.similarity_join(frame(spark, rows), **options), "doc_id", "class_id", "text_id", "n_links")
    want = linked(rows)
    assert got == want and sum(r[3] > 0 for r in want) > 20


def near_copy_rows(groups, size, seed):
    """Groups of texts, each a few random words away from its group's text; pairs lie on both sides of 0.8."""
    rng, rows = random.Random(seed), []
    for g in range(groups):
        base = [f"g{g}w{i}" for i in range(120)]
        for _ in range(size):
            words = list(base)
            for _ in range(rng.choice([1, 1, 1, 2, 3])):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10 ** 6)}"
            rows.append((len(rows), " ".join(words)))
    return rows


@pytest.mark.parametrize("bucket", [20, 150, 5_000])
def test_classes_of_large_groups_whatever_the_bucket(spark, bucket):
    rows = near_copy_rows(3, 250, seed=bucket)
    got = plain(similarity.similarity_join(frame(spark, rows), bucket=bucket), "doc_id", "class_id", "text_id", "n_links")
    assert got == linked(rows)


def test_pivots_keep_rows_per_set_flat():
    """Sets of one large group leave their node with the pivot: hardly any is split again, at every size."""
    hashes, per_set = similarity.WordHashes(), []
    for size in (300, 3_000):
        tokens = np.stack([similarity.sketch(similarity.shingles(t.split(), hashes)) for _, t in near_copy_rows(1, size, 7)])
        batch = pd.DataFrame({"set_key": [bytes([i % 256, i // 256]) for i in range(size)], "path": np.arange(size, dtype=np.int64),
                              "tokens": [x.tobytes() for x in tokens]})
        batch["pivot"], batch["pivot_tokens"] = batch["set_key"][0], batch["tokens"][0]
        out = pd.concat(list(similarity._settle(0.8, True)([batch])))
        per_set.append(len(out) / size)
        assert out["pivot"].notna().mean() > 0.6
    assert max(per_set) < 2.2 and abs(per_set[0] - per_set[1]) < 0.3


def test_large_group_of_near_copies(spark):
    base = [f"w{i}" for i in range(200)]
    rows = [(k, " ".join(base[:10 + k % 150] + [f"x{k}"] + base[11 + k % 150:])) for k in range(400)]
    got = similarity.similarity_join(frame(spark, rows), bucket=50, block_sets=64).collect()
    assert {r["class_id"] for r in got} == {0}
    assert all(r["n_links"] == len({x[1] for x in rows}) - 1 for r in got)


def test_copies_of_a_row_are_one_set(spark, monkeypatch):
    words = [f"w{i}" for i in range(120)]
    rows = [(1, " ".join(words))] * 300 + [(2, " ".join(words[:-1]))] * 2 + [(3, None), (4, "Else.")]
    exact = similarity._exact

    def once(threshold):
        inner = exact(threshold)

        def check(batches):
            def looked():
                for pdf in batches:
                    assert not pdf[["part", "left", "right", "set_key"]].duplicated().any()
                    yield pdf
            return inner(looked())
        return check
    monkeypatch.setattr(similarity, "_exact", once)
    got = plain(similarity.similarity_join(frame(spark, rows)), "doc_id", "class_id", "text_id", "n_links")
    assert got == linked(rows) and len(got) == len(rows)


def test_keep_one(spark):
    rows = documents()
    docs = frame(spark, rows)
    kept = similarity.keep_one(docs)
    assert kept.columns == docs.columns
    classes = {r[1] for r in linked(rows) if r[1] is not None}
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert set(ids) == classes | {None} and all(n == 1 for n in ids.values())
    assert similarity.keep_one(docs.limit(0)).count() == 0
    assert similarity.similarity_join(docs.limit(0)).count() == 0


def removed(rows, length):
    raws = [(t or "").encode() for _, t in rows]
    seen = Counter(r[i:i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for (i, _), r in zip(rows, raws):
        gone = np.zeros(len(r), bool)
        for k in range(len(r) - length + 1):
            if seen[r[k:k + length]] > 1:
                gone[k:k + length] = True
        kept = bytes(np.frombuffer(r, np.uint8)[~gone])
        out.append((i, len(r), int(gone.sum()), int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()),
                    hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("shard", [4000, 1])
def test_repeats_equal_brute_force(spark, shard):
    rows = documents(60) + [(8000, "ab" * 400), (8001, "ébc" * 300), (8002, "q" * 199), (8003, "q" * 199)]
    out = suffix_dedup.repeats_query(frame(spark, rows), shard_contexts=shard)
    assert plain(out, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == removed(rows, 200)
    assert suffix_dedup.repeats_query(frame(spark, rows).limit(0)).count() == 0


def test_suffix_array_and_common_prefixes():
    rng = np.random.RandomState(0)
    for n in (1, 2, 9, 500):
        text = rng.randint(97, 99, n).astype(np.uint8)
        raw = bytes(text)
        sa = suffix_dedup.suffix_array(text, 4 * n)
        assert sa.tolist() == sorted(range(n), key=lambda i: raw[i:])
        got = suffix_dedup.common_prefixes(text, sa, np.array([0]), np.array([n]), 50)
        for a, b, k in zip(sa, sa[1:], got[1:]):
            assert k == min(50, len(os.path.commonprefix([raw[a:], raw[b:]])))


def test_contexts_do_not_depend_on_pieces(monkeypatch):
    raw = " ".join(t or "" for _, t in documents(30)).encode()
    owner = lambda: {raw[p:p + 200]: h for h, s, e in zip(*suffix_dedup.contexts(raw)) for p in range(s, e)}
    whole = owner()
    monkeypatch.setattr(suffix_dedup, "PIECE", 777)
    assert owner() == whole


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline
    rows = documents()
    sf = str(tmp_path)
    labels = [(i, 1, int(i % 9 == 0)) for i, _ in rows if i is not None and i < 9000]
    marked = [(i, (t or "") + " vile scum" if i is not None and i < 9000 and i % 9 == 0 else t) for i, t in rows]
    frame(spark, marked).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, rows[4][1])], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_copies", "decontamination", "mixing", "sharding"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf).columns == docs.columns
        assert stage(spark, docs.limit(0), sf).count() == 0
    out = corpus_pipeline.run(spark, sf)
    assert {"shard", "grown_shard"} <= set(out.columns) and out.count() > 0
    assert not out.filter("doc_id = 4").count()
