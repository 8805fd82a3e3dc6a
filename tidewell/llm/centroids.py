"""Centroid clustering with Ptolemaic pivots.

For any four points, d(x, c) d(p, q) >= |d(x, p) d(c, q) - d(x, q) d(c, p)| (Ptolemy's inequality). The distances of every
vector to some pivots are computed once and kept beside it; in each round a centroid's distances to the same pivots give a
lower bound for every vector and centroid from fixed pairs of pivots. The centroid with the least bound is measured first;
the others are measured, in integers, only where the bound, lowered by more than its rounding error, does not exceed the best
distance so far.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import maxscore, store

#: Largest magnitude of a component: squared distances of 64 components then fit in a long.
LARGEST = 1 << 27
#: Relative slack of the bounds; the rounding error of one is below 1e-14 of the products it is made of.
SLACK = 1e-12
#: Pivots; each is paired with the next and with the one farthest from it.
PIVOTS = 16


def kept_vectors(df: DataFrame, vector: str = "embedding", key: str = "vec_id", size: int = 64, scale: int = 64) -> DataFrame:
    """(key, v): floor(scale * x) of the vectors of this size without null or non-finite components.

    Components beyond +-2**27 are set to that limit, since squared distances would not fit a long. Repeated rows stay, as do
    rows with a null key.
    """
    got = df.select(F.col(key).alias("key"), maxscore.quantized(F.col(vector), scale).alias("v")).where(F.col("v").isNotNull() & (F.size("v") == size))
    return got.select("key", F.transform("v", lambda x: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), x)).cast("int")).alias("v"))


def starts(vectors: DataFrame, k: int = 16, salt: str = "1:") -> np.ndarray:
    """The k vectors with the smallest hexadecimal SHA-256 of salt and key; ties by components, null keys last."""
    h = F.sha2(F.concat(F.lit(salt), F.col("key").cast("string")), 256)
    rows = vectors.select(h.alias("h"), "v").orderBy(F.asc_nulls_last("h"), "v").limit(k).collect()
    return np.array([r.v for r in rows] or np.zeros((0, 0)), np.int64)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows, pair by pair."""
    d = a - b
    return np.einsum("ij,ij->i", d, d)


def to_all(v: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Distances (square roots, as floats) of every vector to every point."""
    return np.sqrt(np.stack([squared(v, p) for p in points], 1).astype(np.float64)) if len(points) else np.zeros((len(v), 0))


@dataclass
class Pivots:
    """points: the pivots; pairs of them with their distance, none of it 0. measured and bounded count exact distances and
    bounds, per task."""

    points: np.ndarray
    pairs: list[tuple[int, int, float]] = field(init=False)
    measured: int = 0
    bounded: int = 0

    def __post_init__(self) -> None:
        d = to_all(self.points, self.points)
        n = len(self.points)
        chosen = {tuple(sorted((i, j))) for i in range(n) for j in ((i + 1) % n, int(d[i].argmax()))}
        self.pairs = [(i, j, float(d[i, j])) for i, j in sorted(chosen) if d[i, j] > 0]

    def lower(self, near: np.ndarray, centre_near: np.ndarray) -> np.ndarray:
        """Bounds (vectors x centroids) from both sides' distances to the pivots, lowered by the slack."""
        out = np.zeros((len(near), len(centre_near)))
        for i, j, d in self.pairs:
            a, b = np.outer(near[:, i], centre_near[:, j]), np.outer(near[:, j], centre_near[:, i])
            np.maximum(out, (np.abs(a - b) - SLACK * (a + b)) / d, out=out)
        return out

    def assign(self, v: np.ndarray, near: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of each vector's nearest centroid; ties go to the smaller number."""
        bound = self.lower(near, to_all(centres, self.points))
        self.bounded += bound.size
        cluster = bound.argmin(1)
        best = squared(v, centres[cluster])
        self.measured += len(v)
        first = cluster.copy()
        for c in range(len(centres)):
            open_ = np.flatnonzero((first != c) & (bound[:, c] <= np.sqrt(best.astype(np.float64)) * (1 + SLACK)))
            if open_.size:
                d = squared(v[open_], centres[c])
                self.measured += open_.size
                better = (d < best[open_]) | ((d == best[open_]) & (c < cluster[open_]))
                at = open_[better]
                best[at], cluster[at] = d[better], c
        return cluster, best


def _matrix(column: pa.ListArray, kind: type) -> np.ndarray:
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(n, -1) if n else np.zeros((0, 0), kind)


def with_distances(vectors: DataFrame, pivots: Pivots) -> DataFrame:
    """The vectors with their distances to the pivots, as a table in the shared folder."""
    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                d = to_all(_matrix(b.column("v"), np.int64), pivots.points)
                yield pa.record_batch([b.column("key"), b.column("v"), pa.array(list(d), pa.list_(pa.float64()))], names=["key", "v", "near"])

    kind = dict(vectors.dtypes)["key"]
    return store.table(vectors.mapInArrow(near, f"key {kind}, v array<int>, near array<double>"))


def moved(rows: DataFrame, pivots: Pivots, centres: np.ndarray) -> np.ndarray:
    """The centroids after one round: exact floors of the means; a centroid without vectors stays.

    Each task adds up its own vectors, so at most one row a centroid and task is shuffled.
    """
    k, size = centres.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(k, np.int64), np.zeros((k, size), np.int64)
        for b in batches:
            if b.num_rows:
                v = _matrix(b.column("v"), np.int64)
                cluster, _ = pivots.assign(v, _matrix(b.column("near"), np.float64), centres)
                n += np.bincount(cluster, minlength=k)
                for c in np.unique(cluster):
                    total[c] += v[cluster == c].sum(0)
        met = np.flatnonzero(n)
        yield pa.record_batch([pa.array(met.astype(np.int32)), pa.array(n[met]), pa.array(list(total[met]), pa.list_(pa.int64()))], names=["cluster", "n", "total"])

    parts = rows.mapInArrow(add, "cluster int, n long, total array<long>")
    sums = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.col("total")[i]).alias(f"t{i}") for i in range(size)]).collect()  # k rows
    out = centres.copy()
    for r in sums:
        out[r["cluster"]] = [r[f"t{i}"] // r["n"] for i in range(size)]
    return out


def assigned(rows: DataFrame, pivots: Pivots, centres: np.ndarray) -> DataFrame:
    """(key, cluster, distance) of every vector: its nearest centroid and their squared distance."""
    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                cluster, d = pivots.assign(_matrix(b.column("v"), np.int64), _matrix(b.column("near"), np.float64), centres)
                yield pa.record_batch([b.column("key"), pa.array(cluster.astype(np.int32)), pa.array(d)], names=["key", "cluster", "distance"])

    return rows.mapInArrow(nearest, f"key {dict(rows.dtypes)['key']}, cluster int, distance long")


def clusters(vectors: DataFrame, k: int = 16, rounds: int = 3) -> tuple[DataFrame, np.ndarray]:
    """Lloyd's rounds over (key, v) from starts(), and the last assignment (key, cluster, distance) with the centroids.

    Fewer vectors than k are as many centroids; equal centroids leave those with larger numbers empty. An empty table has no
    centroid and gives no rows. Centroids and pivots (k times the vector's size) are all that passes through the driver.
    """
    spark: SparkSession = vectors.sparkSession
    centres = starts(vectors, k)
    if not len(centres):
        return spark.createDataFrame([], f"key {dict(vectors.dtypes)['key']}, cluster int, distance long"), centres
    pivots = Pivots(centres[:PIVOTS].copy())
    rows = with_distances(vectors, pivots)
    for _ in range(rounds):
        centres = moved(rows, pivots, centres)
    return store.table(assigned(rows, pivots, centres)), centres


def with_inertia(found: DataFrame, centres: np.ndarray) -> DataFrame:
    """Adds cluster_inertia, inertia (sums of distance; null where no long holds them) and centroid_sha256."""
    per = found.groupBy("cluster").agg(F.try_sum("distance").alias("cluster_inertia"))
    sums = {r["cluster"]: r["cluster_inertia"] for r in per.collect()}  # one row a centroid
    total = None if None in sums.values() else sum(sums.values())
    total = total if total is None or total < 1 << 63 else None
    text = [",".join(map(str, c)) for c in centres.tolist()]
    side = found.sparkSession.createDataFrame([(c, s, total, text[c]) for c, s in sums.items()], "cluster int, cluster_inertia long, inertia long, components string")
    return found.join(F.broadcast(side), "cluster").withColumn("centroid_sha256", F.sha2("components", 256)).drop("components")  # k rows
