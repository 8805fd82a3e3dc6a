"""What each filter removes, in every order of the filters: difference arrays over the ranks of permutations.

A document fails a set of filters, its mask. In a given order it is removed at the first filter of its mask. The orders
that share their first letters are neighbours in the lexicographic order of all permutations (a digit of the Lehmer code is
one block of ranks), so for each mask and step the orders that remove it there are a few intervals of ranks. Counts are
added at the ends of these intervals, and a running sum over the ranks gives the totals of all orders. No document meets
the orders one by one, and no order is run.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import store

#: The filters of the audit, in the order of the mask's bits.
FILTERS = "ABCDE"


def ordering(rank: int, letters: str) -> str:
    """The permutation of (sorted) letters with this lexicographic rank."""
    left, out = sorted(letters), ""
    while left:
        block = factorial(len(left) - 1)
        out += left.pop(rank // block)
        rank %= block
    return out


def intervals(mask: int, k: int) -> list[tuple[int, int, int]]:
    """(step, first rank, rank after the last) of the orders of k filters that remove the mask at the step; neighbouring
    intervals of a step are one. Empty for mask 0."""
    found: list[tuple[int, int, int]] = []

    def walk(left: list[int], first: int, step: int) -> None:
        block = factorial(len(left) - 1)
        for i, f in enumerate(left):
            at = first + i * block
            if mask >> f & 1:
                found.append((step, at, at + block))
            elif len(left) > 1:
                walk(left[:i] + left[i + 1 :], at, step + 1)

    if mask:
        walk(list(range(k)), 0, 1)
    merged: list[tuple[int, int, int]] = []
    for step, first, end in sorted(found):
        if merged and merged[-1][0] == step and merged[-1][2] == first:
            merged[-1] = (step, merged[-1][1], end)
        else:
            merged.append((step, first, end))
    return merged


def totals(counts: DataFrame, sums: Sequence[str], part: str = "part", mask: str = "mask", letters: str = FILTERS) -> DataFrame:
    """Per part, order and step: the sums removed there. counts: any number of rows of a part and mask (bit i: fails
    letter i), with columns of longs to add up; sums[0] counts documents.

    Columns: part, filter_order, step, filter, kept, removed, redundant, unique_fails, shapley, and lost_<c> for each other
    sum. Every part of counts has a row for each order and step, zeros included. A null sum counts as 0; rows with a null
    mask count as failing nothing; a null part is a part of its own. Empty counts give no rows.
    """
    k, spark = len(letters), counts.sparkSession
    orders = factorial(k)
    small = counts.select(F.col(part).alias("part"), F.coalesce(F.col(mask), F.lit(0)).cast("int").alias("mask"), *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(f"s{i}") for i, c in enumerate(sums)])
    names = [f"s{i}" for i in range(len(sums))]
    small = store.pinned(small.groupBy("part", "mask").agg(*[F.sum(s).alias(s) for s in names]))  # at most 2**k rows a part
    # step 0 holds each mask in all orders: what goes into the first filter
    ends = [(m, step, rank, sign) for m in range(1 << k) for step, a, b in [(0, 0, orders), *intervals(m, k)] for rank, sign in ((a, 1), (b, -1)) if rank < orders]
    ends_df = F.broadcast(spark.createDataFrame(ends, "mask int, step int, rank int, sign int"))  # fixed: 2**k masks
    changes = small.join(ends_df, "mask").groupBy("part", "step", "rank").agg(*[F.sum(F.col("sign") * F.col(s)).alias(s) for s in names])
    cell = F.explode(F.sequence(F.lit(0), F.lit((k + 1) * orders - 1)))
    zeros = small.select("part").distinct().select("part", cell.alias("c")).select("part", F.expr(f"int(c div {orders})").alias("step"), F.expr(f"int(c % {orders})").alias("rank"), *[F.lit(0).cast("long").alias(s) for s in names])
    grid = zeros.unionByName(changes).groupBy("part", "step", "rank").agg(*[F.sum(s).alias(s) for s in names])
    running = Window.partitionBy("part", "step").orderBy("rank")
    table = grid.select("part", "step", "rank", *[F.sum(s).over(running).alias(s) for s in names])
    through = Window.partitionBy("part", "rank").orderBy("step")
    table = table.withColumn("kept", F.sum(F.when(F.col("step") == 0, F.col("s0")).otherwise(-F.col("s0"))).over(through)).where("step > 0")
    named = F.broadcast(spark.createDataFrame([(r, ordering(r, letters)) for r in range(orders)], "rank int, filter_order string"))
    table = table.join(named, "rank").withColumn("filter", F.substring("filter_order", F.col("step"), F.lit(1)))
    alike = Window.partitionBy("part", "filter")
    fails = F.max(F.when(F.col("step") == 1, F.col("s0"))).over(alike)  # first in line, a filter removes all that fail it
    alone = F.max(F.when(F.col("step") == k, F.col("s0"))).over(alike)  # last in line, what fails nothing else
    return table.select("part", "filter_order", "step", "filter", "kept", F.col("s0").alias("removed"), (fails - F.col("s0")).alias("redundant"), alone.alias("unique_fails"), F.sum("s0").over(alike).alias("shapley"), *[F.col(s).alias(f"lost_{c}") for s, c in zip(names[1:], sums[1:], strict=True)])


def text_mask(text: Column) -> Column:
    """Bits of the filters A to D for a whole text; null is the empty text, which fails A alone.

    A: under 200 words; B: 100 * distinct words < 50 * words; C: 100 * capitals A-Z > 3 * code points; D: holds any of
    #$%&*|. Words are maximal runs of anything but blanks and the controls from tab to carriage return.
    """
    t = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(t, r"[\x20\x09-\x0D]+"), "")
    n, kinds = F.size(words), F.size(F.array_distinct(words))
    capitals = F.char_length(t) - F.char_length(F.regexp_replace(t, "[A-Z]+", ""))
    fails = (n < 200, 100 * kinds.cast("long") < 50 * n.cast("long"), 100 * capitals.cast("long") > 3 * F.char_length(t).cast("long"), t.rlike(r"[#$%&*|]"))
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))


def masks(docs: DataFrame, part: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Rows (key, part, mask, n): how many rows of a key fail these filters. E: the text is that of a smaller key.

    A null text is empty, a null part the empty string. Rows with a null key fail E never and make no other row fail it;
    rows of one key with one text are no copies of each other. Equal texts are found by their SHA-256: each text's least
    key is joined back on text and key, so that a text that holds a large part of all rows stays spread out.
    """
    digest = F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    rows = docs.select(F.col(key).alias("key"), digest.alias("digest"), F.coalesce(F.col(part), F.lit("")).alias("part"), text_mask(F.col(text)).alias("mask"))
    rows = store.pinned(rows.groupBy("key", "digest", "part", "mask").agg(F.count("*").alias("n")))
    first = rows.where("key is not null").groupBy("digest").agg(F.min("key").alias("key")).withColumn("first", F.lit(True))
    copy = F.col("key").isNotNull() & F.col("first").isNull()
    return rows.join(first, ["digest", "key"], "left").select("key", "part", (F.col("mask") + F.when(copy, 16).otherwise(0)).alias("mask"), "n")


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang", text: str = "text", key: str = "doc_id") -> DataFrame:
    """totals of the five filters over whole documents, with the good (quality 1) and toxic (toxic 1) ones among the removed.

    A document is good or toxic if any row of labels with its key says so; null keys have no labels. Other columns play no
    part, whatever their names. An empty table gives no rows.
    """
    marked = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    found = masks(docs, part, text, key).join(marked, "key", "left")
    counts = found.groupBy("part", "mask").agg(F.sum("n").alias("docs"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))
    return totals(counts, ["docs", "good", "toxic"])
