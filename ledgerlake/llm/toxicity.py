"""Toxicity by class-conditional Kneser-Ney models over the stems of words.

The units are word-initial character runs (4 to 7 letters, as Unicode writes them)
and whole words.  Spark counts them in all labelled training texts per class.  Per
length, each class has a modified Kneser-Ney model whose lower order is shared: the
number of distinct words of both classes that begin with the stem.  A stem is toxic
evidence where the log ratio of the two models is large and the counts behind it are
significant (Dunning's G2); the evidence of a word is that of its longest such stem,
so an inflected insult is known in forms that training never showed.

Counts, discounts and ratios are groupBys and joins over the stem table, which grows
with the corpus; only the stems with evidence reach the scorer, by broadcast below a
size limit and by a shuffle above it.  The document score is a logistic function of
the share of words with evidence.  Its weights are fitted on a bounded sample of
training rows, each scored by a model that did not count it (two halves).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import check_columns, hash52, hidden, shown, written
from .labels import id_fold, label_sample, label_table

STEMS = (4, 5, 6, 7)
FOLDS = 5  # a fifth of the ids is held out
CALIBRATION_ROWS = 8000
EXCESS = (1.5, 3.0, 5.0)  # nats over which a word counts as toxic evidence
SIGNIFICANT = 10.83  # G2 of a stem's counts, one in a thousand
N_FEATURES = len(EXCESS) + 3
#: Above this many stems with evidence they are joined by a shuffle instead of a broadcast.
MAX_BROADCAST_STEMS = 500_000
HELD_WORDS = 200_000  # distinct words that a counting task holds

_WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> list[str]:
    """Lower-cased runs of letters."""
    return _WORD.findall((text or "").lower())


def stems(word: str) -> list[str]:
    """Units of a word, longest first; the whole word is marked by a space."""
    return [word + " "] + [word[:k] for k in reversed(STEMS) if k <= len(word)]


def count_words(rows: DataFrame) -> DataFrame:
    """(word, n00, n01, n10, n11) from (text, half, label): all training texts,
    occurrences by half and label."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = Counter()

        def drain():
            return pd.DataFrame([(w, h, c, n) for (w, h, c), n in seen.items()], columns=["word", "half", "label", "n"])
        for pdf in batches:
            for text, half, label in zip(pdf["text"], pdf["half"], pdf["label"]):
                for w, n in Counter(words(text)).items():
                    seen[w, half, label] += n
                if len(seen) > HELD_WORDS:
                    yield drain()
                    seen.clear()
        yield drain()

    n = {f"n{h}{c}": F.sum(F.when((F.col("half") == h) & (F.col("label") == c), F.col("n")).otherwise(0))
         for h in (0, 1) for c in (0, 1)}
    return (rows.select("text", "half", "label").mapInPandas(count, "word string, half int, label int, n long")
            .groupBy("word").agg(*[v.alias(k) for k, v in n.items()]))


def count_stems(counted: DataFrame) -> DataFrame:
    """(stem, kind, n00, n01, n10, n11, follows): ``kind`` is the stem's length (0: whole
    word), ``follows`` the number of distinct words that begin with it."""
    unit = lambda kind, stem: F.struct(F.lit(kind).alias("kind"), stem.alias("stem"))
    w = F.col("word")
    units = F.array(unit(0, F.concat(w, F.lit(" "))),
                    *[F.when(F.length(w) >= k, unit(k, F.substring(w, 1, k))) for k in STEMS])
    cells = ["n00", "n01", "n10", "n11"]
    return (counted.select(F.explode(F.filter(units, lambda u: u.isNotNull())).alias("u"), *cells)
            .groupBy(F.col("u.stem").alias("stem"), F.col("u.kind").alias("kind"))
            .agg(*[F.sum(c).alias(c) for c in cells], F.count(F.lit(1)).alias("follows")))


def _discounts(ones: int, twos: int, threes: int, fours: int) -> list[float]:
    """Modified Kneser-Ney discounts for counts 0, 1, 2 and 3 or more."""
    if not ones or not twos:
        return [0.0, 0.5, 0.5, 0.5]
    y = ones / (ones + 2 * twos)
    d = [0.0, 1 - 2 * y * twos / ones, 2 - 3 * y * threes / twos, 3 - 4 * y * fours / threes if threes else 1.0]
    return np.clip(d, [0, 0.1, 0.1, 0.1], [0, 0.95, 1.9, 2.9]).tolist()


#: Training sets: each half alone (to score the other), and both.
SETS = {"e0": ("n00", "n01"), "e1": ("n10", "n11"), "e2": None}


def _class_counts(table: DataFrame) -> DataFrame:
    for name, cells in SETS.items():
        for c in (0, 1):
            n = F.col(cells[c]) if cells else F.col(f"n0{c}") + F.col(f"n1{c}")
            table = table.withColumn(f"{name}_{c}", n)
    return table


def evidence_stems(table: DataFrame) -> DataFrame:
    """(stem, e0, e1, e2): log P(toxic) - log P(ordinary) of the stems that are toxic
    evidence in a training set of ``SETS`` (null in a set where they are not)."""
    table = _class_counts(table)
    facts = [F.sum("follows").alias("follows_all")]
    for s in SETS:
        for c in (0, 1):
            n = F.col(f"{s}_{c}")
            facts += [F.sum(n).alias(f"{s}_{c}_all")] + [F.count(F.when(n == i, 1)).alias(f"{s}_{c}_{i}") for i in (1, 2, 3, 4)]
            facts += [F.count(F.when(n >= 3, 1)).alias(f"{s}_{c}_many")]
    # one row per kind of stem
    known = {r["kind"]: r for r in table.groupBy("kind").agg(*facts).collect()}

    def by_kind(value) -> Column:
        out = F.lit(None).cast("double")
        for kind, r in known.items():
            out = F.when(F.col("kind") == kind, F.lit(float(value(r)))).otherwise(out)
        return out

    for s in SETS:
        p = []
        for c in (0, 1):
            at = f"{s}_{c}"
            d = {k: _discounts(*[r[f"{at}_{i}"] for i in (1, 2, 3, 4)]) for k, r in known.items()}
            n, total = F.col(at), by_kind(lambda r: max(r[f"{at}_all"], 1))
            off = F.lit(0.0)
            for i in (1, 2, 3):
                off = F.when(n >= i, by_kind(lambda r: d[r["kind"]][i])).otherwise(off)
            back = by_kind(lambda r: sum(d[r["kind"]][i] * r[f"{at}_{i if i < 3 else 'many'}"] for i in (1, 2, 3))
                           / r[f"{at}_all"] if r[f"{at}_all"] else 1.0)
            p.append((n - off) / total + back * F.col("follows") / by_kind(lambda r: r["follows_all"]))
        o, t = F.col(f"{s}_0"), F.col(f"{s}_1")
        rate = by_kind(lambda r: r[f"{s}_1_all"] / max(r[f"{s}_0_all"] + r[f"{s}_1_all"], 1))
        part = lambda n, q: F.when(n > 0, n * F.log(n / ((o + t) * q))).otherwise(0.0)
        g2 = 2 * (part(t, rate) + part(o, 1 - rate))
        ratio = F.log(p[1] / p[0])
        table = table.withColumn(s, F.when((ratio > EXCESS[0]) & (g2 > SIGNIFICANT), ratio))
    return table.filter(F.coalesce(*SETS).isNotNull()).select("stem", *SETS)


def word_features(n: np.ndarray, over: np.ndarray, excess: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Features of documents from their words, the words over each level of ``EXCESS``, the
    sum of the evidence and the largest: shares on a log scale, and log words."""
    share = lambda a: np.log1p(200 * a / np.maximum(n, 1))
    return np.column_stack([*[share(over[:, i]) for i in range(len(EXCESS))], share(excess), most, np.log1p(n)])


class Scorer:
    """Features of texts by a dictionary of evidence; remembers a bounded number of words."""

    def __init__(self, evidence: dict[str, float]):
        self.evidence, self.known = evidence, {}

    def word(self, w: str) -> float:
        got = self.known.get(w)
        if got is None:
            if len(self.known) > HELD_WORDS:
                self.known.clear()
            got = self.known[w] = next((self.evidence[s] for s in stems(w) if s in self.evidence), 0.0)
        return got

    def __call__(self, texts) -> np.ndarray:
        n, over, excess, most = [], [], [], []
        for text in texts:
            found = words(text)
            e = np.array([v for v in map(self.word, found) if v])
            n.append(len(found))
            over.append([(e > x).sum() for x in EXCESS])
            excess.append(e.sum())
            most.append(e.max() if len(e) else 0.0)
        k = len(n)
        return word_features(np.array(n, float), np.array(over, float).reshape(k, len(EXCESS)), np.array(excess, float),
                             np.array(most, float))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Weights (last: intercept) of a ridge logistic regression by Newton steps."""
    if len(y) == 0 or y.min() == y.max():
        rate = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.0
        return np.concatenate([np.zeros(x.shape[1]), [np.log(rate / (1 - rate)) if 0 < rate < 1 else -10.0]])
    mean, scale = x.mean(0), x.std(0) + 1e-6
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w, keep = np.zeros(z.shape[1]), np.diag([ridge] * x.shape[1] + [1e-6])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + keep, z.T @ (y - p) - keep @ w)
        size = np.abs(step).max()
        w += step * min(1.0, 4 / size) if size > 4 else step
        if size < 1e-7:
            break
    return np.concatenate([w[:-1] / scale, [w[-1] - (w[:-1] * mean / scale).sum()]])


def logistic(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30)))


def _text_key() -> Column:
    return F.md5(F.coalesce(F.col("text"), F.lit("")))


def shuffled_features(texts: DataFrame, evidence: DataFrame, column: str) -> DataFrame:
    """(text_key, n, over, excess, most) of each distinct text of (text_key, text): the
    words are joined with the evidence by a shuffle."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for key, text in zip(pdf["text_key"], pdf["text"]):
                found = Counter(words(text))
                total = sum(found.values())
                rows = [(key, total, None, 0, 0, "")]
                for w, n in found.items():
                    rows += [(key, total, w, n, len(s), s) for s in stems(w)]
                yield pd.DataFrame(rows, columns=["text_key", "n", "word", "times", "size", "stem"])

    spots = texts.dropDuplicates(["text_key"]).mapInPandas(
        cut, "text_key string, n long, word string, times long, size int, stem string")
    known = evidence.filter(F.col(column).isNotNull()).select("stem", F.col(column).alias("e"))
    # the marker of each text has no word; of a word only the longest stem counts
    hits = spots.filter("word is not null").join(known.hint("merge"), "stem").groupBy("text_key", "word").agg(
        F.max("times").alias("times"), F.max_by("e", "size").alias("e"))
    per = hits.groupBy("text_key").agg(
        F.array(*[F.sum(F.when(F.col("e") > x, F.col("times")).otherwise(0)).cast("double") for x in EXCESS]).alias("over"),
        F.sum(F.col("e") * F.col("times")).alias("excess"), F.max("e").alias("most"))
    return (spots.filter("word is null").select("text_key", "n").join(per, "text_key", "left")
            .withColumn("over", F.coalesce("over", F.array(*[F.lit(0.0)] * len(EXCESS))))
            .na.fill(0.0, ["excess", "most"]))


class ToxicityModel:
    """Stems with evidence (a table that grows with the corpus) and the logistic weights."""

    def __init__(self, evidence: DataFrame, small: bool, weights: np.ndarray | None = None):
        self.evidence, self.small, self.weights = evidence, small, weights

    def dictionary(self, column: str) -> dict[str, float]:
        """Evidence of one training set, for a broadcast."""
        rows = self.evidence.filter(F.col(column).isNotNull()).select("stem", column).toPandas()
        return dict(zip(rows["stem"], rows[column]))


def train(docs: DataFrame, labels: DataFrame, calibration_rows: int = CALIBRATION_ROWS,
          max_broadcast_stems: int = MAX_BROADCAST_STEMS) -> ToxicityModel:
    """Counts over every labelled row outside the held-out fifth; logistic weights
    from about ``calibration_rows`` of them.  A null text is an empty text."""
    spark = docs.sparkSession
    known = label_table(labels, "toxic").filter(id_fold(F.col("doc_id"), FOLDS) != 0)
    known = known.withColumn("half", (hash52(F.lit("half"), F.col("doc_id")) % 2).cast("int"))
    texts = docs.select("doc_id", "text").filter(id_fold(F.col("doc_id"), FOLDS) != 0)
    # both sides grow with the corpus: joined by a shuffle at every size
    table = written(count_stems(count_words(texts.join(known.hint("merge"), "doc_id"))), "stems")
    evidence = written(evidence_stems(table), "evidence")
    model = ToxicityModel(evidence, evidence.count() <= max_broadcast_stems)

    sample = label_sample(known, calibration_rows)  # bounded by its parameter
    rows = texts.join(F.broadcast(sample), "doc_id").select("text", "half", "label")
    if model.small:
        other = spark.sparkContext.broadcast([model.dictionary("e1"), model.dictionary("e0")])

        def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            scorers = [Scorer(e) for e in other.value]
            for pdf in batches:
                for h in (0, 1):
                    part = pdf[pdf["half"] == h]
                    yield pd.DataFrame({"x": list(scorers[h](part["text"])), "label": part["label"].to_numpy()})

        got = rows.mapInPandas(score, "x array<double>, label int").toPandas()
        other.unpersist()
        x = np.array(got["x"].tolist()).reshape(len(got), N_FEATURES)
    else:
        rows = rows.withColumn("text_key", _text_key())
        both = [rows.filter(F.col("half") == h) for h in (0, 1)]
        got = both[0].join(shuffled_features(both[0], evidence, "e1"), "text_key").unionByName(
            both[1].join(shuffled_features(both[1], evidence, "e0"), "text_key")).drop("text").toPandas()
        x = _table_features(got)
    model.weights = fit_logistic(x, got["label"].to_numpy().astype(float))
    return model


def _table_features(pdf: pd.DataFrame) -> np.ndarray:
    over = np.array(pdf["over"].tolist(), float).reshape(len(pdf), len(EXCESS))
    return word_features(pdf["n"].to_numpy(float), over, pdf["excess"].to_numpy(float), pdf["most"].to_numpy(float))


def with_score(docs: DataFrame, model: ToxicityModel) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` under private names (see ``hidden``) with ``score``."""
    weights = model.weights
    d, own = hidden(docs, text_key=_text_key())
    text = F.col(own["text"])
    if model.small:
        shared = docs.sparkSession.sparkContext.broadcast(model.dictionary("e2"))

        @F.pandas_udf("double")
        def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            scorer = Scorer(shared.value)
            for texts in batches:
                yield pd.Series(logistic(scorer(texts), weights))

        return d.withColumn("score", score(text)), own

    @F.pandas_udf("double")
    def of_facts(n: pd.Series, over: pd.Series, excess: pd.Series, most: pd.Series) -> pd.Series:
        return pd.Series(logistic(_table_features(pd.DataFrame({"n": n, "over": over, "excess": excess, "most": most})),
                                  weights))

    per = shuffled_features(d.select("text_key", text.alias("text")), model.evidence, "e2")
    return d.join(per.select("text_key", of_facts("n", "over", "excess", "most").alias("score")), "text_key"), own


def toxicity(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Repeated rows get equal scores; a null or empty text is scored as an empty
    text; a null doc_id is never labelled and not held out.  Without usable
    labels every score is low (nothing was learnt to be toxic).  Other columns of
    either table are ignored."""
    check_columns(docs, doc_id="any", text="string")
    scored, own = with_score(docs.select("doc_id", "text"), train(docs, labels, **options))
    doc_id = F.col(own["doc_id"])
    d = scored.select(doc_id.alias("doc_id"), F.coalesce(id_fold(doc_id, FOLDS) == 0, F.lit(False)).alias("held_out"),
                      "score")
    return d.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **options) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more."""
    check_columns(docs, doc_id="any", text="string")
    scored, own = with_score(docs, train(docs, labels, **options))
    return scored.filter(F.col("score") < threshold).select(*shown(own))
