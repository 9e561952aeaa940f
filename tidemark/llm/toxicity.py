"""Toxicity by non-negative positive-unlabelled learning."""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import prepare, residue

# Bounds of the training sample: confirmed toxic and unlabelled documents, taken in hash order.
POSITIVES = 2500
UNLABELLED = 6000
# Hashed features: each distinct word, and its beginnings.
FEATURES = 1 << 18
BEGINNINGS = (4, 5, 6)
# A feature needs this many confirmed documents to be learned from.
SUPPORT = 4
# Features whose log frequency ratio stays below this do not count.
LEAST_RATIO = 0.5
EPOCHS = 60
BATCH = 500
RATE = 0.02
DECAY = 1e-3
SEED = 7
TOXIC_FROM = 0.7
HELD_OUT = (3, 1)
REMEMBERED_WORDS = 300_000

_TOKEN = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> list[int]:
    out = [crc32(word.encode("utf-8", "surrogatepass")) % FEATURES]
    for k in BEGINNINGS:
        if len(word) > k:
            out.append(crc32(("^" + word[:k]).encode("utf-8", "surrogatepass")) % FEATURES)
    return out


def text_features(text: str | None) -> np.ndarray:
    """Sorted distinct features of one whole text."""
    found = {f for w in set(_TOKEN.findall((text or "").lower())) for f in word_features(w)}
    return np.sort(np.fromiter(found, np.int32, len(found)))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = [text_features(x.as_py()).tolist() for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lists, pa.list_(pa.int32()))], names=["toxic", "features"])


class _Sparse:
    """Rows of feature numbers."""

    def __init__(self, rows: list[np.ndarray]):
        self.size = np.fromiter(map(len, rows), np.int64, len(rows))
        self.at = np.concatenate([[0], np.cumsum(self.size)])
        self.columns = np.concatenate([*rows, np.empty(0, np.int32)]).astype(np.int64)

    def batch(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = self.size[rows]
        owner = np.repeat(np.arange(len(rows)), size)
        inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        return self.columns[np.repeat(self.at[rows], size) + inside], owner


def train(
    positive: list[np.ndarray],
    unlabelled: list[np.ndarray],
    prior: float,
    epochs: int = EPOCHS,
    seed: int = SEED,
) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear classifier under the non-negative risk estimator.

    With the sigmoid loss, the risk is prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)): unlabelled
    text stands for the negatives after the share that positives have in it is taken out. Where that
    difference falls below zero, the step goes against it instead, so the classifier cannot fit it away.
    """
    weights, bias = np.zeros(FEATURES), 0.0
    if not positive or not unlabelled:
        return weights, -10.0  # nothing is known to be toxic
    # a feature counts by how much more often confirmed documents have it than unlabelled ones
    in_p = np.bincount(np.concatenate(positive), minlength=FEATURES)
    in_u = np.bincount(np.concatenate(unlabelled), minlength=FEATURES)
    support = in_p >= min(SUPPORT, len(positive))
    scale = np.log(((in_p + 1) / (len(positive) + 2)) / ((in_u + 1) / (len(unlabelled) + 2)))
    scale = np.where(support, np.sign(scale) * np.maximum(0, np.abs(scale) - LEAST_RATIO), 0.0)
    support &= scale != 0
    p, u = (_Sparse([x[support[x]] for x in rows]) for rows in (positive, unlabelled))
    rng = np.random.default_rng(seed)
    first, second, m_b, v_b, step = np.zeros(FEATURES), np.zeros(FEATURES), 0.0, 0.0, 0
    rounds = max(1, -(-len(unlabelled) // BATCH))
    take_p = max(1, -(-len(positive) // rounds))

    bias = float(np.log(prior / (1 - prior)))

    def sigmoid(x):
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))

    for _ in range(epochs):
        order_p, order_u = rng.permutation(len(positive)), rng.permutation(len(unlabelled))
        for r in range(rounds):
            rows_p = order_p[np.arange(r * take_p, (r + 1) * take_p) % len(positive)]
            rows_u = order_u[r * BATCH : (r + 1) * BATCH]
            cols_p, own_p = p.batch(rows_p)
            cols_u, own_u = u.batch(rows_u)
            f_p = sigmoid(np.bincount(own_p, (weights * scale)[cols_p], len(rows_p)) + bias)
            f_u = sigmoid(np.bincount(own_u, (weights * scale)[cols_u], len(rows_u)) + bias)
            slope_p, slope_u = f_p * (1 - f_p) / len(rows_p), f_u * (1 - f_u) / len(rows_u)
            negative = f_u.mean() - prior * f_p.mean()
            if negative >= 0:
                g_p, g_u = -2 * prior * slope_p, slope_u  # d/df of the whole risk
            else:
                g_p, g_u = prior * slope_p, -slope_u  # back to a risk that can be
            grad = scale * (np.bincount(cols_p, g_p[own_p], FEATURES) + np.bincount(cols_u, g_u[own_u], FEATURES)) + DECAY * prior * weights
            grad_b = g_p.sum() + g_u.sum()
            step += 1
            first = 0.9 * first + 0.1 * grad
            second = 0.99 * second + 0.01 * grad * grad
            m_b, v_b = 0.9 * m_b + 0.1 * grad_b, 0.99 * v_b + 0.01 * grad_b * grad_b
            c1, c2 = 1 - 0.9**step, 1 - 0.99**step
            weights -= RATE * (first / c1) / (np.sqrt(second / c2) + 1e-8)
            bias -= RATE * (m_b / c1) / (np.sqrt(v_b / c2) + 1e-8)
    return weights * scale, float(bias)


def score_text(text: str | None, weights: np.ndarray, bias: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(weights[text_features(text)].sum() + bias, -30, 30))))


def _scores(weights: np.ndarray, bias: float):
    import math

    active = np.flatnonzero(weights)
    value = dict(zip(active.tolist(), weights[active].tolist(), strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            scores = np.empty(batch.num_rows)
            for i, text in enumerate(batch.column(2)):
                found: set[int] = set()
                for word in set(_TOKEN.findall((text.as_py() or "").lower())):
                    own = known.get(word)
                    if own is None:
                        own = known[word] = tuple(f for f in word_features(word) if f in value)
                    if own:
                        found.update(own)
                scores[i] = 1 / (1 + math.exp(-max(-30.0, min(30.0, math.fsum([bias, *(value[f] for f in found)])))))
            if len(known) > REMEMBERED_WORDS:
                known.clear()
            scores = np.round(scores, 6)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= TOXIC_FROM).astype(np.int32)),
            ], names=["doc_id", "held_out", "score", "predicted"])

    return run


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        held_out: tuple[int, int] = HELD_OUT) -> tuple[np.ndarray, float]:
    """Weights and bias, learned from bounded samples of the rows that are not held out.

    Up to ``POSITIVES`` documents with a toxic label, and ``UNLABELLED`` documents whatever their label, in
    the order of a hash of the identifier: the estimator takes the positives' share out of the second
    sample, so that sample must hold it. A document may be in both. The class prior is the share of
    toxic labels among all labelled rows that are not held out; other labels are not used. Of several
    texts under one identifier the smallest is learned from.
    """
    prepare(docs.sparkSession)
    learnable = residue(id_col, held_out[0]) != held_out[1]
    marks = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).where(learnable)
    marks = marks.groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).alias("_toxic"))
    known = marks.agg(F.avg((F.col("_toxic") == 1).cast("double")).alias("prior")).first()["prior"]
    if not known:
        return train([], [], 0.0)
    ids = docs.where(F.col(id_col).isNotNull()).where(learnable).select(F.col(id_col).alias("_id")).distinct()
    ordered = [F.xxhash64("_id"), "_id"]
    confirmed = ids.join(marks.where("_toxic = 1"), "_id", "left_semi").orderBy(*ordered).limit(POSITIVES)
    drawn = ids.orderBy(*ordered).limit(UNLABELLED)
    chosen = confirmed.withColumn("_toxic", F.lit(1)).unionByName(drawn.withColumn("_toxic", F.lit(0)))
    # at most POSITIVES + UNLABELLED rows
    sample = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(chosen), "_id")
    one = sample.groupBy("_toxic", "_id").agg(F.min("_text").alias("_text"))
    rows = one.orderBy("_toxic", *ordered).select("_toxic", "_text").mapInArrow(
        _features, "toxic int, features array<int>").collect()
    positive = [np.array(r["features"], np.int32) for r in rows if r["toxic"] == 1]
    other = [np.array(r["features"], np.int32) for r in rows if r["toxic"] != 1]
    return train(positive, other, min(max(known, 0.001), 0.999))


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic", held_out: tuple[int, int] = HELD_OUT) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Null and empty text has no feature and gets the bias alone. A table without any toxic label
    scores near 0. Null identifiers hash as the text 'null' and are not learned from; repeated rows
    get the same score; an empty table gives an empty result; other columns are not read.
    """
    weights, bias = fit(docs, labels, id_col, text_col, label_col, held_out)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (residue(id_col, held_out[0]) == held_out[1]).alias("held_out"),
                       F.col(text_col).alias("text"))
    return rows.mapInArrow(_scores(weights, bias), "doc_id long, held_out boolean, score double, predicted int")
