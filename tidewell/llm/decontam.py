"""Benchmark decontamination by size-partitioned MinHash containment search. DataFrame functions only.

A short item inside a long document has a tiny Jaccard similarity, so signatures of equal length would miss it. Items are
partitioned by their number of shingles; within a partition the sketch of an item is its bottom-m MinHash values under
one shared hash, with m = floor((1 - t) * top) + SPARE + 1 for the largest number top of the partition, or all of its
shingles if they are fewer. A document that holds at least the share t of an item's n shingles misses at most
floor((1 - t) * n) of them, so it must hit the sketch at least m - floor((1 - t) * n) times: no contained item is lost.

1. Documents are searched for sketch values only. Pairs with enough hits are the candidates.
2. Candidates, and nothing else, are verified by the exact count of the item's shingles in the document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import store

K = 5
#: Hits beyond one that a sketch asks for: fewer candidates of one chance hit, for a larger sketch.
SPARE = 1
#: Largest number of sketch values or of item shingles that is broadcast; above, the joins are shuffled.
BROADCAST_ROWS = 2_000_000


def word_array(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.split(F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), " ")


def has_words(text: Column) -> Column:
    return text.rlike(r"[\p{L}\p{N}]")


def word_hashes(text: Column) -> Column:
    """Hashes of the words of a text that has some."""
    return F.transform(word_array(text), lambda w: F.xxhash64(w))


def grams(words: Column, k: int) -> Column:
    """Hashes of all runs of k words (empty if there are fewer); k = 5 are the shingles."""
    made = F.transform(F.sequence(F.lit(0), F.size(words) - F.lit(k)), lambda i: F.xxhash64(*[F.get(words, i + F.lit(j)) for j in range(k)], F.lit(k)))
    return F.when(F.size(words) >= k, made).otherwise(F.array().cast("array<bigint>"))


def item_shingles(items: DataFrame, item_key: str, text: str) -> DataFrame:
    """(item, n, width, s): distinct shingles of each distinct row with words; of 1 to 4 words: one, of all its words."""
    words = items.where(F.col(item_key).isNotNull() & has_words(F.col(text))).select(F.col(item_key).alias("item"), word_hashes(F.col(text)).alias("w"))
    width = F.least(F.size("w"), F.lit(K))
    short = [F.when(width == k, grams(F.col("w"), k)) for k in range(1, K)]
    return words.select("item", width.alias("width"), F.array_sort(F.array_distinct(F.coalesce(*short, grams(F.col("w"), K)))).alias("s")).distinct().withColumn("n", F.size("s"))


def sketches(shingled: DataFrame, threshold: float) -> DataFrame:
    """(item, s, h, need): a row for each sketch value of each item, and the number of hits that a candidate must have."""
    missing = lambda c: F.floor(F.round((1 - F.lit(threshold)) * F.col(c), 9)).cast("int")
    sized = shingled.withColumn("part", F.ceil(F.log2("n")).cast("int"))
    tops = sized.groupBy("part").agg(F.max("n").alias("top"))  # one row for each power of two up to the largest item
    m = F.least(missing("top") + F.lit(SPARE + 1), F.col("n"))
    low = F.slice(F.array_sort(F.transform("s", lambda h: F.struct(F.xxhash64(h, F.lit(1)).alias("r"), h.alias("h")))), 1, m)
    return sized.join(F.broadcast(tops), "part").select("item", "s", (m - missing("n")).alias("need"), F.explode(low).alias("x")).select("item", "s", "need", "x.h")


def contained(docs: DataFrame, items: DataFrame, threshold: float = 0.8, doc_key: str = "doc_id", item_key: str = "item_id", text: str = "text") -> DataFrame:
    """doc_key, item_key, n_shingles, n_found, containment of every pair with containment >= threshold (above 0).

    containment: share of the item's distinct 5-word shingles (lower-cased words of letters and digits) in the document.
    An item of one to four words is one shingle, contained where a document has these words in a row. Null keys, null
    texts and texts without words are in no pair. Of a repeated document or
    item key, the best contained pair of rows is reported, once; items with equal texts are each reported. Empty tables
    give no rows. Other columns play no part, whatever their names. Texts of any length are searched whole.
    """
    shingled = store.pinned(item_shingles(items, item_key, text))
    widths = [r[0] for r in shingled.select("width").distinct().orderBy("width").collect()]  # at most five
    sketch = store.pinned(sketches(shingled, threshold).withColumn("id", F.xxhash64("item", "s")).drop("s"))
    texts = docs.where(F.col(doc_key).isNotNull() & has_words(F.col(text))).select(F.col(doc_key).alias("doc"), F.col(text).alias("t"))
    of_doc = lambda df: df.select("doc", word_hashes(F.col("t")).alias("w")).select("doc", F.concat(F.array().cast("array<bigint>"), *[grams(F.col("w"), k) for k in widths]).alias("d"))

    hits = of_doc(texts).select("doc", F.explode_outer("d").alias("h")).join(store.sent(sketch, BROADCAST_ROWS), "h").groupBy("doc", "id", "need").agg(F.count_distinct("h").alias("hit"))
    candidates = store.pinned(hits.where("hit >= need").select("doc", "id"))

    wanted = candidates.join(store.sent(shingled.select("item", F.xxhash64("item", "s").alias("id"), "s", "n"), BROADCAST_ROWS // 64), "id").drop("id")
    held = of_doc(texts.join(store.sent(store.pinned(candidates.select("doc").distinct())), "doc", "left_semi"))
    exact = held.join(wanted, "doc").select("doc", "item", "n", F.size(F.array_intersect("s", "d")).alias("found")).where(F.col("found") >= F.greatest(F.col("n") * threshold - 1e-9, F.lit(1)))
    best = exact.groupBy("doc", "item").agg(F.max(F.struct((F.col("found") / F.col("n")).alias("share"), "n", "found")).alias("x"))
    return best.select(F.col("doc").alias(doc_key), F.col("item").alias(item_key), F.col("x.n").cast("long").alias("n_shingles"), F.col("x.found").cast("long").alias("n_found"), F.col("x.share").alias("containment"))


def clean(docs: DataFrame, items: DataFrame, threshold: float = 0.8, doc_key: str = "doc_id") -> DataFrame:
    """The documents that contain no item. Rows with a null key or text are kept."""
    found = store.pinned(contained(docs, items, threshold, doc_key).select(doc_key).distinct())
    return docs.join(store.sent(found), doc_key, "left_anti").select(*docs.columns)
