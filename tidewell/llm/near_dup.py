"""Near-duplicate classes: ProbMinHash signatures of shingles, banding, exact verification, components.

Signature. A shingle of weight w arrives in a Poisson process of rate w; each arrival falls on a random register, which
keeps the shingle of its earliest arrival. Arrivals later than the latest register are not generated (early
termination). Two texts agree in a register with the probability Jaccard similarity of their weighted shingles; all
weights are 1 here, however often a shingle is repeated, so this is the plain Jaccard similarity that verification
measures.

Links. Texts with the same set of shingles are one class at once. Of the others, each bucket of a band compares all
members with its hub (the least id). Members outside the hub's component are compared with each other, and, if their
similarity with the hub leaves it possible (Jaccard distance is a metric: it is at most 1 - threshold below the least
one of the bucket's members inside the component), with those inside; this happens in pairs of blocks of bounded size,
and each pair of blocks returns a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import store, textvec

BANDS, ROWS, SHINGLE = 24, 4, 5  # a pair of similarity 0.8 is missed with a chance of 3e-6
BLOCK = 256
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def prob_minhash(keys: np.ndarray, weights: np.ndarray, m: int) -> np.ndarray:
    """The ProbMinHash signature (m register values) of distinct keys with positive weights; not for an empty set.

    All registers are expected to be taken before a limit, so only arrivals before it are made; if one register is still
    free then, the limit is doubled. Later arrivals cannot change a register: the result does not depend on the limit.
    m: from 1 to 2**31.
    """
    if not 1 <= m <= 1 << 31:
        raise ValueError(f"no signature of {m} registers")
    limit = (np.log(m) + 4) * m / weights.sum()
    while True:
        whens, registers, owners = [], [], []
        live, clock, done = np.arange(keys.size), np.zeros(keys.size), 0
        each = limit * weights.sum() / keys.size
        step = int(np.ceil(each + 1.5 * np.sqrt(each)))
        while live.size:
            number = np.arange(done + 1, done + step + 1, dtype=np.uint64) * _GOLD
            h = textvec.mix64(keys[live][:, None] + number)
            gap = np.log(((h >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weights[live][:, None]
            when = clock[:, None] - np.cumsum(gap, 1)
            early = when < limit
            whens.append(when[early])
            registers.append((textvec.mix64(h[early]) >> np.uint64(32)) * np.uint64(m) >> np.uint64(32))
            owners.append(np.repeat(live, early.sum(1)))
            more = early[:, -1]
            live, clock, done = live[more], when[more, -1], done + step
        when, register, owner = np.concatenate(whens), np.concatenate(registers).astype(np.int64), np.concatenate(owners)
        last = np.full(m, -1)
        order = np.argsort(-when, kind="stable")
        last[register[order]] = owner[order]  # the earliest arrival is written last
        if last.min() >= 0:
            return keys[last]
        limit *= 2


def shingle_set(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, ascending, and their counts."""
    return np.unique(textvec.shingles(textvec.word_hashes(text), SHINGLE), return_counts=True)


def fingerprint(keys: np.ndarray) -> tuple[int, int]:
    """128 bits of a set of hashes."""
    return int(textvec.mix64(keys).sum().astype(np.int64)), int(textvec.mix64(keys ^ _GOLD).sum().astype(np.int64))


def signature(text: str | None) -> tuple[int, int, int, list[int]] | None:
    """Number of distinct shingles, a 128-bit fingerprint of their set, and a hash for each band; None without words."""
    keys = shingle_set(text)[0]
    if not keys.size:
        return None
    sig = prob_minhash(keys, np.ones(keys.size), BANDS * ROWS).reshape(BANDS, ROWS)
    bands = np.arange(1, BANDS + 1, dtype=np.uint64)
    for j in range(ROWS):
        bands = textvec.mix64(bands * _GOLD + sig[:, j])
    return int(keys.size), *fingerprint(keys), bands.astype(np.int64).tolist()


def _signatures(docs: DataFrame, key: str, text: str) -> DataFrame:
    def sign(batches: Iterator) -> Iterator:
        for b in batches:
            rows = [(k, *s) for k, s in zip(b["k"], map(signature, b["t"]), strict=True) if s is not None]
            yield pd.DataFrame(rows, columns=["id", "n", "fa", "fb", "bands"])

    rows = docs.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))
    return rows.mapInPandas(sign, "id long, n int, fa long, fb long, bands array<long>")


def _sets(docs: DataFrame, key: str, text: str, ids: DataFrame) -> DataFrame:
    """(id, s): the 64-bit shingle hashes of each id, ascending; of a repeated id, of the text with the least fingerprint."""

    def sets(batches: Iterator) -> Iterator:
        for b in batches:
            found = [shingle_set(t)[0] for t in b["t"]]
            prints = [fingerprint(s) for s in found]
            yield pd.DataFrame({"id": b["id"], "fa": [x for x, _ in prints], "fb": [y for _, y in prints], "s": [np.sort(s.view(np.int64)) for s in found]})

    rows = docs.where(F.col(text).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(text).alias("t")).join(store.sent(ids), "id", "left_semi")
    return rows.mapInPandas(sets, "id long, fa long, fb long, s array<long>").where(F.size("s") > 0).groupBy("id").agg(F.min(F.struct("fa", "fb", "s")).alias("x")).select("id", F.col("x.s").alias("s"))


def _one_text_each(signed: DataFrame) -> DataFrame:
    """Signatures with one row for each row of the table, but for ids with different texts only those of the least fingerprint."""
    spans = signed.groupBy("id").agg(F.min(F.struct("fa", "fb")).alias("first"), F.max(F.struct("fa", "fb")).alias("last"))
    mixed = store.pinned(spans.where("first <> last").select("id", "first"))
    if not mixed.limit(1).count():
        return signed
    return store.pinned(signed.join(mixed, "id", "left").where(F.col("first").isNull() | (F.struct("fa", "fb") == F.col("first"))).drop("first"))


def components(edges: DataFrame) -> DataFrame:
    """(id, root): the least id of the connected component of each id in edges (a, b).

    Each round, every vertex takes its least neighbour (or itself), then that one's choice, and the edges are drawn
    between the chosen vertices. Every component with an edge loses vertices by a constant factor, so the number of rounds is
    logarithmic for any shape, and edges inside settled components are gone. Rounds are written to the shared folder.
    """
    live = store.table(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct())
    levels = []
    while True:
        hook = store.table(live.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("root")).select("id", F.least("id", "root").alias("root")))
        if levels and not hook.limit(1).count():
            break
        above = hook.select(F.col("id").alias("root"), F.col("root").alias("top"))
        step = store.table(hook.join(above, "root").select("id", F.col("top").alias("root")))
        levels.append(step)
        of = lambda c: step.select(F.col("id").alias(c), F.col("root").alias(f"r{c}"))  # noqa: B023, E731
        live = store.table(live.join(of("a"), "a").join(of("b"), "b").select(F.col("ra").alias("a"), F.col("rb").alias("b")).where("a <> b").distinct())
    roots = levels.pop()
    for step in reversed(levels):
        above = roots.select(F.col("id").alias("root"), F.col("root").alias("top"))
        roots = store.table(step.join(above, "root", "left").select("id", F.coalesce("top", "root").alias("root")))
    return roots


def block_links(ids: np.ndarray, sets: list[np.ndarray], roots: np.ndarray, side: np.ndarray, ring: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """A spanning forest of the links in one pair of blocks.

    Rows of side 0 are compared with each other, and those in the ring with the rows of side 1; rows with the same root
    are linked already.
    """
    sizes = np.array([len(s) for s in sets])
    words, flat = np.unique(np.concatenate(sets), return_inverse=True)
    offsets = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    parent = list(range(len(sets)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out, known = [], {}
    for i, c in enumerate(roots.tolist()):
        parent[root(i)] = root(known.setdefault(c, i))
    for i in np.flatnonzero(side == 0):
        mark = np.zeros(len(words), bool)
        mark[flat[offsets[i] : offsets[i] + sizes[i]]] = True
        both = np.add.reduceat(mark[flat], offsets)
        good = (both >= threshold * (sizes[i] + sizes - both) - 1e-9) & np.where(side == 0, np.arange(len(sets)) > i, ring[i])
        for j in np.flatnonzero(good).tolist():
            if root(i) != root(j):
                parent[root(i)] = root(j)
                out.append((int(ids[i]), int(ids[j])))
    return out


def _packed_links(group: pa.Table, threshold: float) -> pa.Table:
    """The links of many pairs of blocks that were sent to one task."""
    group = group.sort_by([("bucket", "ascending"), ("i", "ascending"), ("j", "ascending"), ("cross", "ascending"), ("side", "ascending"), ("id", "ascending")])
    names = [group[c].to_numpy() for c in ("bucket", "i", "j", "cross")]
    ids, roots, side, ring = (group[c].to_numpy() for c in ("id", "root", "side", "ring"))
    column = group["s"].combine_chunks()
    values, at = column.values.to_numpy(), column.offsets.to_numpy()
    change = np.flatnonzero(np.any([n[1:] != n[:-1] for n in names], 0)) + 1
    out = []
    for a, b in zip([0, *change], [*change, group.num_rows], strict=True):
        if b - a > 1 and len(set(roots[a:b].tolist())) > 1:
            out += block_links(ids[a:b], [values[at[k] : at[k + 1]] for k in range(a, b)], roots[a:b], side[a:b], ring[a:b].astype(bool), threshold)
    return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})


def classes(docs: DataFrame, threshold: float = 0.8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, class_id (least key of its class), class_size, n_shingles for each row of docs with words.

    Texts are linked if the Jaccard similarity of their sets of 5-word shingles (lower-cased words of letters and
    digits; a text of one to four words is one shingle) is at least the threshold; classes are connected components.
    Null keys, null texts and texts without words are in no class and have no row. A repeated key is one document; if
    its texts differ, the one with the least fingerprint counts. An empty table gives no rows; columns of other names
    play no part.

    What a join deals out is written first (pinned), so that adaptive execution can split the partitions of hot keys: a
    bucket, hub, root or class that holds a large part of all rows.
    """
    store.small_batches(docs.sparkSession)
    signed = _one_text_each(store.pinned(_signatures(docs, key, text)))
    whole = store.pinned(signed.groupBy("fa", "fb", "n").agg(F.min("id").alias("rep"), F.min(F.struct("id", "bands")).alias("x")).select("fa", "fb", "n", "rep", F.col("x.bands").alias("bands")))
    member = whole.select("rep", F.posexplode("bands").alias("band", "h")).select("rep", F.xxhash64("band", "h").alias("bucket"))
    hubs = member.groupBy("bucket").agg(F.min("rep").alias("hub"), F.count("*").alias("size")).where("size > 1").select("bucket", "hub")
    hubs = store.pinned(hubs)
    star = store.pinned(member.join(hubs, "bucket").where("rep <> hub"))
    pairs = star.select("rep", "hub").distinct()
    ids = store.pinned(pairs.select(F.col("rep").alias("id")).union(pairs.select("hub")).distinct())
    sets = store.pinned(_sets(docs, key, text, ids))
    size = lambda c: F.size(c)
    seen = pairs.join(sets.withColumnsRenamed({"id": "rep", "s": "sr"}), "rep").join(sets.withColumnsRenamed({"id": "hub", "s": "sh"}), "hub")
    seen = seen.withColumn("both", size(F.array_intersect("sr", "sh"))).select("rep", "hub", (F.col("both") / (size("sr") + size("sh") - F.col("both"))).alias("sim"))
    seen = store.pinned(seen)
    links = seen.where(F.col("sim") >= threshold - 1e-9).select(F.col("rep").alias("a"), F.col("hub").alias("b"))
    roots = components(links)

    # what the hubs did not settle
    root = lambda c, name: roots.select(F.col("id").alias(c), F.col("root").alias(name))
    judged = star.join(seen, ["rep", "hub"]).join(root("rep", "root_r"), "rep", "left").join(root("hub", "root_h"), "hub", "left")
    judged = judged.select("bucket", "hub", "rep", "sim", F.coalesce("root_r", "rep").alias("root"), F.coalesce("root_h", "hub").alias("root_h"))
    judged = store.pinned(judged.withColumn("open", F.col("root") != F.col("root_h")))
    # members of the hub's component may be linked to it only through others: the bound is their least similarity with it
    least = judged.groupBy("bucket").agg(F.min(F.when(~F.col("open"), F.col("sim"))).alias("least"))
    judged = store.pinned(judged.join(store.pinned(least), "bucket").withColumn("ring", F.col("open") & F.coalesce(F.col("sim") >= F.col("least") - (1 - threshold) - 1e-9, F.lit(False))).drop("least"))
    count = lambda c: F.sum(c.cast("long"))
    left = judged.groupBy("bucket").agg(count(F.col("open")).alias("n_open"), F.countDistinct(F.when(F.col("open"), F.col("root"))).alias("roots"), count(F.col("ring")).alias("n_ring"), count(~F.col("open") & (F.col("sim") < 1)).alias("n_linked"), F.sum(F.xxhash64("rep").cast("decimal(20,0)")).alias("mark"), F.first("hub").alias("hub"))
    left = left.where("roots > 1 or (n_ring > 0 and n_linked > 0)").groupBy("hub", "mark", "n_open", "n_linked", "n_ring").agg(F.min("bucket").alias("bucket"))
    rest = judged.join(store.pinned(left).select("bucket", "n_open", "n_linked", "n_ring"), "bucket")
    blocks = lambda n: F.ceil(F.greatest(F.col(n), F.lit(1)) / BLOCK).cast("int")
    deal = lambda n: F.pmod(F.xxhash64("rep", F.lit(5)), blocks(n)).cast("int")
    span = lambda n: F.sequence(F.lit(0), blocks(n) - 1)
    rest = rest.withColumn("mine", F.when(F.col("open"), deal("n_open")).otherwise(deal("n_linked")))
    own = F.transform(span("n_open"), lambda j: F.struct(F.least("mine", j).alias("i"), F.greatest("mine", j).alias("j"), F.lit(False).alias("cross")))
    over = F.transform(span("n_linked"), lambda j: F.struct(F.col("mine").alias("i"), j.alias("j"), F.lit(True).alias("cross")))
    back = F.transform(span("n_open"), lambda j: F.struct(j.alias("i"), F.col("mine").alias("j"), F.lit(True).alias("cross")))
    none = F.array().cast("array<struct<i:int,j:int,cross:boolean>>")
    where = F.when(F.col("open"), F.concat(own, F.when(F.col("ring") & (F.col("n_linked") > 0), over).otherwise(none))).otherwise(F.when(F.col("n_ring") > 0, back).otherwise(none))
    rest = rest.select("bucket", "rep", "root", "ring", F.when(F.col("open"), 0).otherwise(1).alias("side"), F.explode(where).alias("p")).select("bucket", "p.*", F.col("rep").alias("id"), "root", "ring", "side")
    rest = store.pinned(rest)
    parts = max(1, -(-rest.count() // (8 * BLOCK)))
    rest = rest.withColumn("part", F.pmod(F.xxhash64("bucket", "i", "j", "cross"), F.lit(parts)))
    more = store.pinned(rest.join(sets, "id").groupBy("part").applyInArrow(lambda g: _packed_links(g, threshold), "a long, b long").distinct())
    if more.limit(1).count():
        roots = components(links.union(more))

    of_rep = store.pinned(whole.select("fa", "fb", "n", "rep").join(roots.select(F.col("id").alias("rep"), "root"), "rep", "left").select("fa", "fb", "n", F.coalesce("root", "rep").alias("class_id")))
    out = signed.select("id", "fa", "fb", "n").join(of_rep, ["fa", "fb", "n"]).groupBy("id").agg(F.min("class_id").alias("class_id"), F.max("n").alias("n_shingles"))
    out = store.pinned(out)
    sizes = store.pinned(out.groupBy("class_id").agg(F.count("*").alias("class_size")))
    return out.join(sizes, "class_id").select(F.col("id").alias(key), "class_id", "class_size", "n_shingles")


def one_of_each(docs: DataFrame, threshold: float = 0.8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs without the rows that are in a class of another document; rows that are in no class stay."""
    found = classes(docs, threshold, key, text)
    gone = store.sent(store.pinned(found.where(F.col(key) != F.col("class_id")).select(key)))
    return docs.join(gone, key, "left_anti").select(*docs.columns)
