"""Quality by ordinal cumulative-link regression on graded ratings.

P(grade > k) = sigmoid(w.x - threshold_k) with one weight vector w on hashed character n-grams and text statistics and
ordered thresholds. The expected grade ranks texts, a tail probability selects them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import store, textvec

STATS = 8


@dataclass
class QualityModel:
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one fewer than the grades
    bits: int


def vector(text: str | None, bits: int) -> np.ndarray:
    """Hashed n-grams (case kept, digits alike), scaled to length 1, and statistics of words and characters."""
    x = np.zeros((1 << bits) + STATS, np.float32)
    if not text:
        x[-1] = 1
        return x
    x[: 1 << bits] = textvec.unit(textvec.hashed_ngrams(text, bits, (1, 2, 3), fold=False))
    words = text.split()
    n = max(1, len(words))
    cp = textvec.codepoints(text)
    kinds = np.bincount(textvec.classes_of(cp), minlength=3) / cp.size
    keys = np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words), np.int64, len(words))
    same = float((keys[1:] == keys[:-1]).mean()) if len(keys) > 1 else 0.0
    run = 0.0
    if len(keys) > 8:
        run = max(float((keys[1:] == keys[:-1])[i : i + 8].mean()) for i in range(0, len(keys) - 8, 8))
    upper = sum(map(str.isupper, words)) / n
    x[1 << bits :] = [same, run, upper, kinds[0], kinds[2], len(np.unique(keys)) / n, min(1.0, 1 / n), 0]
    return x


def fit_ordinal(x: np.ndarray, y: np.ndarray, grades: int, l2: float = 1e-5, steps: int = 200, rate: float = 0.5) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by Adam on the mean log-likelihood of y in 0..grades-1."""
    w = np.zeros(x.shape[1], np.float64)
    tail = np.array([np.clip((y > k).mean() if len(y) else 0.5, 0.01, 0.99) for k in range(grades - 1)])
    first = -np.log(tail / (1 - tail))
    p = np.concatenate([first[:1], np.log(np.maximum(np.diff(first), 1e-2))])
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(p), np.zeros_like(p)]
    for t in range(1, steps + 1):
        th = p[0] + np.concatenate([[0], np.cumsum(np.exp(p[1:]))])
        z = (x @ w.astype(np.float32)).astype(np.float64)
        edge = np.concatenate([[-np.inf], th, [np.inf]])
        above, below = textvec.sigmoid(z - edge[y]), textvec.sigmoid(z - edge[y + 1])  # P(grade >= y), P(grade > y)
        above, below = np.where(y == 0, 1, above), np.where(y == grades - 1, 0, below)
        prob = np.maximum(above - below, 1e-9)
        da, db = above * (1 - above) / prob / len(y), below * (1 - below) / prob / len(y)
        gw = -(x.T @ (da - db).astype(np.float32)) + l2 * w
        gth = np.array([da[y == k + 1].sum() - db[y == k].sum() for k in range(grades - 1)])
        gp = np.array([gth.sum(), *(np.exp(p[j]) * gth[j:].sum() for j in range(1, grades - 1))])
        lr = rate * (1 - t / (steps + 1))
        for i, (v, g) in enumerate(((w, gw), (p, gp))):
            a, b = state[2 * i], state[2 * i + 1]
            a[:], b[:] = 0.9 * a + 0.1 * g, 0.999 * b + 0.001 * g * g
            v -= lr * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.999**t)) + 1e-8)
    return w.astype(np.float32), p[0] + np.concatenate([[0], np.cumsum(np.exp(p[1:]))])


def fit(docs: DataFrame, ratings: DataFrame, grades: int, text: str = "text", key: str = "doc_id", grade: str = "grade", per_grade: int = 900, bits: int = 12) -> QualityModel:
    """ratings: key and a grade from 0 to grades-1, small next to docs; other and null grades take no part.

    Fits on a bounded sample, about per_grade rows of each grade (whole texts), chosen by a hash of the key and weighed
    back by nothing: thresholds refer to grades in equal shares. A key rated more than once counts with its least grade.
    """
    store.small_batches(docs.sparkSession)
    marks = ratings.where(F.col(grade).between(0, grades - 1)).groupBy(key).agg(F.min(grade).cast("int").alias("__y"))
    marks = store.pinned(marks)
    size = {r[0]: r[1] for r in marks.groupBy("__y").count().collect()}
    part = F.lit(0.0)
    for g, n in size.items():
        part = F.when(F.col("__y") == g, min(1.0, per_grade / n)).otherwise(part)

    def vectors(batches: Iterator) -> Iterator:
        for b in batches:
            x = [vector(t, bits) for t in b["text"]]
            at = [np.flatnonzero(v).astype(np.int32) for v in x]
            yield pd.DataFrame({"y": b["y"], "i": at, "v": [v[i] for v, i in zip(x, at, strict=True)]})

    chosen = F.broadcast(marks.where(store.share(F.col(key), part)))
    rows = docs.select(key, F.col(text).alias("text")).join(chosen, key)
    got = rows.select("text", F.col("__y").alias("y")).mapInPandas(vectors, "y int, i array<int>, v array<float>").toPandas().sort_values("y", kind="stable")
    if got.empty:
        return QualityModel(np.zeros((1 << bits) + STATS, np.float32), np.arange(grades - 1, dtype=float) - 1, bits)
    x = np.zeros((len(got), (1 << bits) + STATS), np.float32)
    for row, (i, v) in enumerate(zip(got["i"], got["v"], strict=True)):
        x[row, np.asarray(i)] = v
    return QualityModel(*fit_ordinal(x, got["y"].to_numpy(), grades), bits)


def rate(docs: DataFrame, model: QualityModel, text: str = "text") -> Column:
    """Struct (expected, tail): the expected grade and P(grade > k) for each k. Null and empty texts: a vector of their own."""
    store.small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("expected double, tail array<double>")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for texts in batches:
            z = np.empty(len(texts))
            for at in range(0, len(texts), 256):
                z[at : at + 256] = np.stack([vector(t, m.bits) for t in texts.iloc[at : at + 256]]) @ m.weights
            tail = textvec.sigmoid(z[:, None] - m.thresholds)
            yield pd.DataFrame({"expected": tail.sum(1), "tail": list(tail)})

    return judge(F.col(text))
