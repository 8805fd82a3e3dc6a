"""Exact top-k inner-product search by MaxScore over shards of integer vectors.

A component is a query term, its weight the query's value; its postings in a shard are that component of every vector,
counted from the least contribution the term makes in the shard, so that no contribution is negative. The extremes of
the shard bound what a term can add. For each query the terms are ordered by bound; the non-essential ones are the
largest set of small bounds whose sum stays below the query's threshold (its k-th best score so far, less the least
contributions): a vector must earn the rest from the essential terms. These are traversed for all vectors of the shard;
the others are probed, largest bound first, only for vectors that can still reach the threshold.

A task goes through its shards one after the other, each with the thresholds of those before. The table is searched in
levels of growing size, and each level starts with the thresholds that all tasks of the levels before found together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import store

#: Terms that are probed between two looks at what is still competitive.
PROBE = 8
#: Queries whose terms are traversed together; a term is passed over if none of them needs it.
QUERIES = 64
#: Share of competitive vectors above which the next terms are added for all vectors, since single probes would cost more.
DENSE = 0.05
#: Bytes of query vectors that are sent to every task at a time; more queries are searched in further blocks.
BLOCK_BYTES = 32_000_000


def quantized(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of each component (as double), as longs; null if the vector or a component is null or not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | F.abs(x.cast("double")).isin(float("inf")))
    return F.when(vector.isNull() | bad, None).otherwise(F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


class Search:
    """The k best vectors so far of each query of a block. q: queries x terms; floor: known lower bounds of k-th scores.

    Exact: integers are held in floats only where sums are sure to fit; else sums are of Python integers and nothing
    is skipped. products counts the terms of queries that were multiplied (without the zeros of joint traversals).
    """

    def __init__(self, q: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int):
        self.q, self.own, self.floor, self.k = q, own, floor.astype(np.float64), k
        self.ids = [np.zeros(0, np.int64)] * len(q)
        self.scores = [np.zeros(0, np.int64)] * len(q)
        self.products = 0

    def _keep(self, r: int, ids: np.ndarray, scores: np.ndarray) -> None:
        ids, scores = np.concatenate([self.ids[r], ids]), np.concatenate([self.scores[r], scores])
        if len(ids) > self.k:
            if len(ids) > 8 * self.k:
                at = scores >= np.partition(scores, -self.k)[-self.k]
                ids, scores = ids[at], scores[at]
            best = np.lexsort([ids, -scores])[: self.k]
            ids, scores = ids[best], scores[best]
        self.ids[r], self.scores[r] = ids, scores
        if len(ids) == self.k:
            self.floor[r] = max(self.floor[r], float(scores.min()))

    def shard(self, v: np.ndarray, ids: np.ndarray) -> None:
        """Looks for better vectors among the rows of v, whose ids may come in any order."""
        dims = self.q.shape[1]
        if not len(v) or not len(self.q):
            return
        most = float(np.abs(self.q.astype(float)).max(initial=0)) * float(np.abs(v.astype(float)).max(initial=0)) * max(dims, 1)
        if most >= 2**52:
            for r, one in enumerate(self.q):
                live = np.flatnonzero(ids != self.own[r])
                scores = np.array([sum(int(a) * int(b) for a, b in zip(one, v[i], strict=True)) for i in live], object)
                self.products += live.size * dims
                if scores.size and abs(scores).max() >= 2**63:
                    raise OverflowError("a score does not fit a long")
                self._keep(r, ids[live], scores.astype(np.int64))
            return
        kind = np.float32 if most < 2**23 else np.float64
        rows = v.astype(kind)
        low = rows.min(0)
        posts = np.ascontiguousarray((rows - low if most < 2**22 else rows.astype(np.float64) - low).T)
        span = posts.max(1).astype(np.float64)
        low, top = low.astype(np.float64), rows.max(0).astype(np.float64)
        for at in range(0, len(self.q), QUERIES):
            self._traverse(np.arange(at, min(at + QUERIES, len(self.q))), posts, low, top, span, ids)

    def _traverse(self, block: np.ndarray, posts: np.ndarray, low: np.ndarray, top: np.ndarray, span: np.ndarray, ids: np.ndarray) -> None:
        """One shard for a block of queries: each has its own essential terms, which are traversed together."""
        weight, dims = self.q[block].astype(np.float64), len(span)
        least = np.where(weight >= 0, weight * low, weight * top)  # each term's least contribution
        bound = np.abs(weight) * span
        order = np.argsort(-bound, axis=1, kind="stable")
        tail = lambda x: np.concatenate([np.cumsum(np.take_along_axis(x, order, 1)[:, ::-1], 1)[:, ::-1], np.zeros((len(block), 1))], 1)
        after = tail(bound)  # what the terms from here on can add to their least contributions
        reach = tail(np.maximum(weight, 0) * span)  # and to posts counted from low
        need = self.floor[block] - least.sum(1)
        first = np.where(need > 0, (after >= need[:, None]).sum(1), dims)  # the terms from first on sum to less than the need
        first = np.minimum(np.maximum(first, 1), dims)
        place = np.argsort(order, axis=1, kind="stable")
        alive = after[:, 0] >= need  # queries that a vector of this shard may still serve
        base = weight @ low  # posts are counted from low
        rest = self.floor[block] - base

        def together(start: np.ndarray, end: np.ndarray) -> np.ndarray:
            """Sums of each query's terms from start to end of its order, for all vectors."""
            mine = (place >= start[:, None]) & (place < end[:, None]) & alive[:, None]
            used = np.flatnonzero(mine.any(0))
            self.products += int(mine.sum()) * len(ids)
            return np.where(mine, weight, 0).astype(posts.dtype)[:, used] @ posts[used]

        partial = together(np.zeros_like(first), first)
        may = (partial >= (rest - reach[np.arange(len(block)), first])[:, None]) & (ids != self.own[block][:, None]) & alive[:, None]
        while may.mean() > DENSE and (first < dims).any():  # so many are competitive that probing goes over all vectors
            further = np.minimum(dims, first + np.maximum((dims - first) // 2, PROBE))
            partial += together(first, further)
            first = further
            may &= partial >= (rest - reach[np.arange(len(block)), first])[:, None]
        for j in np.flatnonzero(may.any(1)):
            live = np.flatnonzero(may[j])
            score = partial[j, live].astype(np.float64)
            for at in range(int(first[j]), dims, PROBE):
                more = order[j, at : at + PROBE]
                score += weight[j, more] @ posts[more[:, None], live]
                self.products += len(more) * live.size
                stay = score >= rest[j] - reach[j, min(at + PROBE, dims)]
                live, score = live[stay], score[stay]
            if live.size:
                self._keep(block[j], ids[live], np.rint(score + base[j]).astype(np.int64))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims) if dims else np.zeros((len(column), 0), np.int64)


def _searched(vectors: DataFrame, queries: pa.Table, floor: np.ndarray, dims: int, k: int, shard_rows: int) -> DataFrame:
    """(slot, query_id, vec_id, score): each task's best of its part of vectors for each query of a block."""
    block = vectors.sparkSession.sparkContext.broadcast((_matrix(queries["v"].combine_chunks(), dims), queries["vec_id"].to_numpy(), floor))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, own, start = block.value
        found = Search(q, own, start, k)
        for b in batches:
            for at in range(0, b.num_rows, shard_rows):
                part = b.slice(at, shard_rows)
                found.shard(_matrix(part.column(1), dims), part.column(0).to_numpy())
        slot = np.repeat(np.arange(len(q)), [len(x) for x in found.ids])
        if slot.size:
            yield pa.RecordBatch.from_pydict({"slot": slot.astype(np.int32), "query_id": own[slot], "vec_id": np.concatenate(found.ids), "score": np.concatenate(found.scores)})

    return vectors.select("vec_id", "v").mapInArrow(work, "slot int, query_id long, vec_id long, score long")


def _best(found: DataFrame, by: str, k: int) -> DataFrame:
    w = Window.partitionBy(by).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 20, first_rows: int = 4096, growth: int = 16, shard_rows: int = 4096, block_rows: int = 65536) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best vectors. Both inputs: (vec_id long, v array<long>).

    Queries are sent to the tasks in blocks of about block_rows and at most about BLOCK_BYTES; vectors are not shuffled.
    For each block, a first level of about first_rows vectors (by a hash of the id, in a few tasks), then levels that
    reach growth times as far, are searched. Only scores that reach the thresholds of the levels before leave a task, so
    about growth * k rows are shuffled for each query and level, whatever the number of vectors and tasks.

    Only vectors with as many components as the query are compared. Null ids and vectors take no part, nor do vectors
    with the query's own id. A repeated id is a candidate for each of its rows; of repeated queries, the k best of all
    their pairs are returned. Empty tables give no rows. Ties go to the smaller id. A score beyond a long raises an error.
    """
    usable = lambda df: df.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).select("vec_id", "v", F.size("v").alias("dims"))
    v, q = usable(vectors), usable(queries)
    asked = {r["dims"]: r["n"] for r in q.groupBy("dims").agg(F.count("*").alias("n")).collect()}
    there = {r["dims"]: r["n"] for r in v.groupBy("dims").agg(F.count("*").alias("n")).collect()}
    out = []
    for dims in sorted(set(asked) & set(there)):
        blocks = -(-asked[dims] // max(1, min(block_rows, BLOCK_BYTES // (8 * (dims + 1)))))
        levels = [0.0]
        reach = first_rows / there[dims]
        while levels[-1] < 1:
            levels.append(min(1.0, reach) if reach * growth**0.5 < 1 else 1.0)
            reach *= growth
        mine = v.where(F.col("dims") == dims).withColumn("at", F.pmod(F.xxhash64("vec_id", F.lit(11)), F.lit(1 << 30)) / (1 << 30))
        for block in range(blocks):
            rows = q.where((F.col("dims") == dims) & (F.pmod(F.xxhash64("vec_id", F.lit(5)), F.lit(blocks)) == block)).select("vec_id", "v").toArrow()
            if not rows.num_rows:
                continue
            floor = np.full(rows.num_rows, -np.inf)
            best = None
            for low, high in zip(levels, levels[1:], strict=False):
                level = mine.where((F.col("at") >= low) & (F.col("at") < high))
                found = _searched(level if low else level.repartition(4), rows, floor, dims, k, shard_rows)
                best = store.pinned(_best(best.unionByName(found) if best else found, "slot", k).select("slot", "query_id", "vec_id", "score"))
                if high < 1:
                    known = best.groupBy("slot").agg(F.min("score").alias("least"), F.count("*").alias("n")).where(F.col("n") == k).toPandas()
                    floor[known["slot"].to_numpy()] = known["least"].to_numpy()
            out.append(best)
    if not out:
        return v.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score")).where("false")
    every = out[0]
    for more in out[1:]:
        every = every.unionByName(more)
    return _best(every, "query_id", k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
