"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad.  Its features are those of the line and of its two
neighbours; the chain adds weights for the change from one line to the next.
Forward-backward gives each line's probability of being good, and their mean
weighted by line length is the document's quality.

The labels are on documents, so in training all lines of a document carry its
label.  The field is fitted on a bounded sample of whole texts: labelled rows in the order of a
digest, at most ``TRAIN_DOCS`` of them and ``TRAIN_LINES`` lines in all.  Scoring reads every line of every document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import check_columns
from .labels import id_fold, label_sample, label_table

FOLDS, HELD_OUT = 3, 1
TRAIN_DOCS = 6000
TRAIN_LINES = 200_000
BATCH_LETTERS = 1_000_000  # letters that are scored at once
STEPS = 150
RIDGE = 1e-3

# byte classes: lower, upper, digit, space, end of sentence, other joining marks, symbols, other scripts
_CLASS = np.full(256, 6, np.uint8)
_CLASS[ord("a"):ord("z") + 1] = 0
_CLASS[ord("A"):ord("Z") + 1] = 1
_CLASS[ord("0"):ord("9") + 1] = 2
_CLASS[[9, 11, 12, 13, 32]] = 3
_CLASS[[ord(c) for c in ".!?"]] = 4
_CLASS[[ord(c) for c in ",;:'\"()-"]] = 5
_CLASS[128:] = 7
N_CLASSES = 8
N_LINE = N_CLASSES + 8
N_FEATURES = 3 * N_LINE + 1


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(lines, N_FEATURES) matrix and the lengths in bytes.  A text has at least
    one line; an empty line has all features 0 but for the intercept."""
    lines = (text or "").split("\n")
    own = np.zeros((len(lines), N_LINE))
    raw = [x.encode("utf-8", "replace") for x in lines]
    size = np.array([len(x) for x in raw])
    at = np.repeat(np.arange(len(lines)), size)
    cls = _CLASS[np.frombuffer(b"".join(raw), np.uint8)]
    n = np.bincount(at * N_CLASSES + cls, minlength=len(lines) * N_CLASSES).reshape(len(lines), N_CLASSES)
    own[:, :N_CLASSES] = n / np.maximum(size, 1)[:, None]
    seen_words: set = set()
    seen_lines: set = set()
    for i, line in enumerate(lines):
        words = line.split()
        k = len(words)
        if not k:
            continue
        kinds = set(words)
        own[i, N_CLASSES:] = (np.log1p(k), min(size[i] / k, 20) / 10, len(kinds) / k,
                              len(kinds & seen_words) / len(kinds), line in seen_lines,
                              raw[i][-1] in b".!?", n[i, 1] / max(n[i, 0] + n[i, 1], 1),
                              min((n[i, 6] + raw[i].count(b"!")) / k, 4))
        seen_words |= kinds
        seen_lines.add(line)
    full = np.zeros((len(lines), N_FEATURES))
    full[:, :N_LINE] = own
    full[1:, N_LINE:2 * N_LINE] = own[:-1]
    full[:-1, 2 * N_LINE:3 * N_LINE] = own[1:]
    full[:, -1] = 1
    return full, size


class LineField:
    """Weights of the field: ``w`` scores good against bad, ``t[a, b]`` the step a -> b."""

    def __init__(self, w: np.ndarray, t: np.ndarray, mean: np.ndarray, scale: np.ndarray):
        self.w, self.t, self.mean, self.scale = w, t, mean, scale

    def standard(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.scale

    def marginals(self, u: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Forward-backward over many documents at once, line number by line number.
        ``u``: score of good per line.  Returns P(good) per line, the summed
        probabilities of the steps, and the log partition function."""
        node = np.zeros((len(u), 2))
        node[:, 1] = u
        a, b = np.empty((len(u), 2)), np.zeros((len(u), 2))
        order = np.argsort(-length, kind="stable")
        start, length = start[order], length[order]
        longest = int(length[0]) if len(length) else 0
        live = [int(np.searchsorted(-length, -i, side="left")) for i in range(longest + 1)]  # documents longer than i
        a[start] = node[start]
        for i in range(1, longest):
            at = start[:live[i]] + i
            m = a[at - 1][:, :, None] + self.t
            a[at] = np.logaddexp(m[:, 0], m[:, 1]) + node[at]
        for i in range(longest - 2, -1, -1):
            at = start[:live[i + 1]] + i
            m = self.t + (node[at + 1] + b[at + 1])[:, None, :]
            b[at] = np.logaddexp(m[:, :, 0], m[:, :, 1])
        z = a + b
        norm = np.logaddexp(z[:, 0], z[:, 1])
        good = np.exp(z[:, 1] - norm)
        inner = np.ones(len(u), bool)
        inner[start] = False
        at = np.flatnonzero(inner)
        pair = np.exp(a[at - 1][:, :, None] + self.t + (node[at] + b[at])[:, None, :] - norm[at][:, None, None])
        return good, pair.sum(0), float(norm[start].sum())


def _stack(texts):
    parts = [line_features(t) for t in texts]
    length = np.array([len(x) for x, _ in parts], np.int64)
    start = np.cumsum(length) - length
    x = np.concatenate([x for x, _ in parts]) if parts else np.zeros((0, N_FEATURES))
    size = np.concatenate([s for _, s in parts]) if parts else np.zeros(0)
    return x, size, start, length


def fit_field(x: np.ndarray, start: np.ndarray, length: np.ndarray, label: np.ndarray, steps: int = STEPS) -> LineField:
    """Maximum conditional likelihood (each document weighs 1) by Adam steps."""
    mean, scale = (x.mean(0), x.std(0) + 1e-3) if len(x) else (np.zeros(N_FEATURES), np.ones(N_FEATURES))
    mean[-1], scale[-1] = 0, 1
    field = LineField(np.zeros(N_FEATURES), np.zeros((2, 2)), mean, scale)
    if not len(label):
        return field
    z = field.standard(x)
    y = np.repeat(label, length)
    seen = np.zeros((2, 2))
    for c in (0, 1):
        seen[c, c] = np.maximum(length[label == c] - 1, 0).sum()
    theta, m, v = np.zeros(N_FEATURES + 4), np.zeros(N_FEATURES + 4), np.zeros(N_FEATURES + 4)
    for k in range(1, steps + 1):
        field.w, field.t = theta[:N_FEATURES], theta[N_FEATURES:].reshape(2, 2)
        good, pair, _ = field.marginals(z @ field.w, start, length)
        g = np.concatenate([z.T @ (y - good), (seen - pair).ravel()]) / len(z) - RIDGE * theta
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta + 0.1 * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.999 ** k)) + 1e-8)
    field.w, field.t = theta[:N_FEATURES], theta[N_FEATURES:].reshape(2, 2)
    return field


def score_texts(texts, field: LineField) -> np.ndarray:
    """Length-weighted mean of the lines' probabilities of being good."""
    x, size, start, length = _stack(texts)
    if not len(length):
        return np.zeros(0)
    good, _, _ = field.marginals(field.standard(x) @ field.w, start, length)
    weight = np.maximum(size, 1e-3)  # a text of empty lines only weighs them alike
    return np.clip(np.add.reduceat(good * weight, start) / np.add.reduceat(weight, start), 0, 1)


def training_rows(docs: DataFrame, labels: DataFrame, max_docs: int = TRAIN_DOCS, max_lines: int = TRAIN_LINES) -> DataFrame:
    """(doc_id, digest, label) of the distinct labelled rows to learn from: in the order of a digest of id and text the first
    ``max_docs``, without those that would bring the sum of lines above ``max_lines``.  No row is cut."""
    known = label_table(labels, "quality").filter(id_fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    ids = label_sample(known, max_docs)  # bounded by its parameter; one id may have many rows
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.md5(F.concat_ws(":", F.col("doc_id").cast("string"), text)).alias("digest"),
                       (F.length(text) - F.length(F.replace(text, F.lit("\n"))) + 1).alias("lines"))
    rows = rows.join(F.broadcast(ids), "doc_id").dropDuplicates(["digest"]).orderBy("digest").limit(max_docs)
    got, lines, kept = rows.collect(), 0, []
    for r in got:
        if lines + r["lines"] <= max_lines:
            lines += r["lines"]
            kept.append((r["doc_id"], r["digest"], r["label"]))
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, digest string, label int"
    return docs.sparkSession.createDataFrame(kept, schema)


def train(docs: DataFrame, labels: DataFrame, max_docs: int = TRAIN_DOCS, max_lines: int = TRAIN_LINES) -> LineField:
    sample = training_rows(docs, labels, max_docs, max_lines)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = [line_features(t)[0].astype(np.float32) for t in pdf["text"]]
            yield pd.DataFrame({"digest": pdf["digest"], "x": [v.tobytes() for v in x], "label": pdf["label"]})

    text = F.coalesce(F.col("text"), F.lit(""))
    own = docs.select("text", F.md5(F.concat_ws(":", F.col("doc_id").cast("string"), text)).alias("digest"))
    got = (own.join(F.broadcast(sample.select("digest", "label")), "digest").dropDuplicates(["digest"])
           .select("text", "digest", "label").mapInPandas(read, "digest string, x binary, label int").toPandas())
    got = got.sort_values("digest")  # the sums then do not depend on the partitioning
    xs = [np.frombuffer(v, np.float32).reshape(-1, N_FEATURES) for v in got["x"]]
    length = np.array([len(v) for v in xs], np.int64)
    x = np.concatenate(xs).astype(float) if xs else np.zeros((0, N_FEATURES))
    return fit_field(x, np.cumsum(length) - length, length, got["label"].to_numpy().astype(float))


def quality_score(field: LineField, text: Column | None = None) -> Column:
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            size = texts.str.len().fillna(0).to_numpy(float)
            part = (np.cumsum(size) // BATCH_LETTERS) if len(size) else size
            out = [score_texts(own, field) for _, own in texts.groupby(part, sort=True)]
            yield pd.Series(np.concatenate(out) if out else np.zeros(0))

    return score(F.col("text") if text is None else text)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    A null or empty text is one empty line; repeated rows get equal scores; a
    null doc_id is never labelled and not held out.  Without usable labels every
    score is 0.5.  Other columns of either table are ignored."""
    check_columns(docs, doc_id="any", text="string")
    field = train(docs, labels)
    d = docs.select("doc_id", F.coalesce(id_fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
                    quality_score(field).alias("score"))
    return d.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
