"""Toxicity by weak supervision.

1. Lexicons: words and word beginnings that are far more frequent in marked texts, beside a fixed list of insults and a
   pattern.
2. Voters: each lexicon or pattern votes toxic, clean or abstains on a text.
3. A generative label model estimates each voter's accuracy and the correlations left between voters from the votes of
   all documents alone: moments of pairs of voters first, then EM; correlated voters share their weight. Marked rows give
   the prior and which class is the toxic one, nothing else: no posterior is set to a mark.
4. A linear classifier on hashed words is trained on the posteriors of a bounded sample of all documents, marked or not.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import store, textvec

# Insults that mark a text whatever the labelled rows say.
INSULTS = "idiot moron stupid scum trash pathetic loser worthless disgusting clown dumb imbecile bastard vermin filth".split()
VOTERS = ("words", "beginnings_3", "beginnings_4", "beginnings_5", "insults", "shouting")
BITS = 20


@dataclass
class ToxicityModel:
    lexicons: list[np.ndarray]  # sorted feature numbers of the first four voters
    accuracy: np.ndarray  # voters x (vote when toxic, vote when clean)
    correlation: np.ndarray  # voters x voters, within a class
    prior: float
    features: np.ndarray  # sorted feature numbers of the classifier
    weights: np.ndarray
    bias: float


def _feature_sets(text: str | None) -> list[np.ndarray]:
    """Sorted distinct feature numbers of a text: whole words, and word beginnings of 3, 4 and 5 letters."""
    if not text:
        return [np.zeros(0, np.int64)] * 4
    cp = textvec.codepoints(text.lower())
    starts, ends = textvec.word_spans(cp, digits=False)
    hashes = textvec.SpanHasher(cp)
    out = [np.unique(hashes(starts, ends) >> np.uint64(64 - BITS)).astype(np.int64)]
    for n in (3, 4, 5):
        at = starts[ends - starts >= n]
        out.append(np.unique((hashes(at, at + n) * np.uint64(2 * n + 1)) >> np.uint64(64 - BITS)).astype(np.int64))
    return out


_INSULTS = np.unique(np.concatenate([_feature_sets(w)[0] for w in INSULTS]))


def _hits(found: np.ndarray, lexicon: np.ndarray) -> int:
    return 0 if not lexicon.size or not found.size else int((lexicon[np.minimum(np.searchsorted(lexicon, found), lexicon.size - 1)] == found).sum())


def votes_of(text: str | None, sets: list[np.ndarray], lexicons: list[np.ndarray]) -> np.ndarray:
    """1 toxic, -1 clean, 0 no vote, by voter."""
    v = [1 if _hits(found, lexicon) else -1 for found, lexicon in zip(sets, lexicons, strict=True)]
    insulted = _hits(sets[0], _INSULTS) > 0
    loud = bool(text) and text.count("!!") > 3
    return np.array([*v, int(insulted), int(loud and insulted)], np.int8)


def _lexicons(marked: DataFrame, z: float, ratio: float, most: int) -> list[np.ndarray]:
    """From document counts by feature over all marked rows (summed in each task before the shuffle)."""

    def counts(batches: Iterator) -> Iterator:
        seen = np.zeros((4, 2, 1 << BITS), np.int32)
        rows = np.zeros(2, np.int64)
        for b in batches:
            for text, y in zip(b["text"], b["y"], strict=True):
                rows[y] += 1
                for kind, found in enumerate(_feature_sets(text)):
                    seen[kind, y, found] += 1
        yield pd.DataFrame({"kind": [-1], "feature": [-1], "clean": rows[:1], "toxic": rows[1:]})
        for kind in range(4):
            at = np.flatnonzero(seen[kind].any(0))
            yield pd.DataFrame({"kind": kind, "feature": at, "clean": seen[kind, 0, at], "toxic": seen[kind, 1, at]})

    total = marked.mapInPandas(counts, "kind int, feature long, clean long, toxic long").groupBy("kind", "feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    total = store.pinned(total)
    size = total.where("kind = -1").first()
    if not size or not size["clean"] or not size["toxic"]:
        return [np.zeros(0, np.int64)] * 4
    p, q = (F.col("toxic") + 0.5) / (size["toxic"] + 1), (F.col("clean") + 0.5) / (size["clean"] + 1)
    scored = total.where("kind >= 0").withColumn("r", p / q).withColumn("z", F.log(p / q) / F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5)))
    out = []
    for kind in range(4):
        best = scored.where((F.col("kind") == kind) & (F.col("z") > z) & (F.col("r") > ratio)).orderBy(F.desc("z"), "feature").limit(most).select("feature").toPandas()["feature"].to_numpy(np.int64)
        out.append(np.sort(best))
    return out


def _differences(votes: np.ndarray, weight: np.ndarray, rows: float, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Each voter's mean vote on toxic less that on clean rows, and which pairs of voters are independent within a class.

    For independent voters, cov(i, j) = prior (1 - prior) d_i d_j. The products are fitted by alternating least squares; pairs
    whose left-over correlation is above 0.3 are set aside and the rest is fitted again. A covariance within four standard
    errors of zero counts as zero, so voters that agree by chance only get d = 0.
    """
    dev = votes - weight @ votes
    pairs = dev[:, :, None] * dev[:, None, :]
    cov = np.einsum("n,nij->ij", weight, pairs)
    error = np.sqrt(np.maximum(np.einsum("n,nij->ij", weight, pairs**2) - cov**2, 0) / max(rows, 1))
    sure = np.where(np.abs(cov) > 4 * error, cov, 0.0)
    spread, apart = prior * (1 - prior), ~np.eye(len(cov), dtype=bool)
    use, d = apart.copy(), np.zeros(len(cov))
    for _ in range(6):
        d = np.sqrt(np.maximum((sure * use).sum(1), 0) / (spread * np.maximum(use.sum(1), 1)))
        for _ in range(200):
            for i in range(len(d)):
                seen = spread * (use[i] * d**2).sum()
                d[i] = np.clip((use[i] * sure[i] * d).sum() / seen, -2, 2) if seen > 1e-9 else 0.0
        left = cov - spread * np.outer(d, d)
        sd = np.sqrt(np.maximum(np.diag(cov) - spread * d**2, 1e-4))
        keep = apart & ~(left / np.outer(sd, sd) > 0.3)
        keep[keep.sum(1) < 2] = apart[keep.sum(1) < 2]
        if (keep == use).all():
            break
        use = keep
    return d, use


def fit_label_model(votes: np.ndarray, counts: np.ndarray, gold: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray, float, np.ndarray]:
    """The label model of distinct vote patterns. votes: patterns x voters; counts: rows of each; gold: 0, 1 or -1 (not marked).

    gold gives the prior and the polarity; without marks of both kinds the prior is estimated too and voters vote toxic
    as they say. Returns accuracy (voters x class x vote+1), correlations within a class, the prior and each pattern's
    posterior. Voters without information get posteriors at the prior.
    """
    k, weight = votes.shape[1], counts / max(counts.sum(), 1)
    onehot = np.stack([votes == -1, votes == 0, votes == 1], 2).astype(float)
    marks = np.array([counts[gold == c].sum() for c in (0, 1)])
    known = bool(marks.all())
    prior = float(np.clip(marks[1] / marks.sum(), 0.005, 0.995)) if known else 0.5
    d, use = _differences(votes, weight, counts.sum(), prior)
    if known and d @ (counts[gold == 1] @ votes[gold == 1] / marks[1] - counts[gold == 0] @ votes[gold == 0] / marks[0]) < 0:
        d = -d
    share = np.einsum("n,nkv->kv", weight, onehot)  # of each vote among all rows
    dev = votes - weight @ votes
    seen = prior * (1 - prior) * (use * d**2).sum(1)
    shift = np.einsum("n,nkv,nj,kj,j->kv", weight, onehot, dev, use.astype(float), d) / np.maximum(seen, 1e-9)[:, None] * (seen > 1e-9)[:, None]
    accuracy = np.clip(np.stack([share - prior * shift, share + (1 - prior) * shift], 1), 1e-3, 1)
    accuracy /= accuracy.sum(2, keepdims=True)
    corr, part, post = np.eye(k), np.ones(k), np.full(len(votes), prior)
    for _ in range(rounds):
        logs = np.einsum("nkv,kcv->nkc", onehot, np.log(accuracy))
        new = textvec.sigmoid(np.log(prior / (1 - prior)) + ((logs[:, :, 1] - logs[:, :, 0]) * part).sum(1))
        moved, post = np.abs(new - post).max(), new
        w = np.stack([(1 - post) * counts, post * counts])
        accuracy = (np.einsum("cn,nkv->kcv", w, onehot) + share[:, None, :]) / (w.sum(1)[None, :, None] + 1)
        accuracy = np.maximum(accuracy, 1e-6)
        if not known:
            prior = float((w[1].sum() + 1) / (counts.sum() + 2))
        mean = np.einsum("kcv,v->kc", accuracy, np.array([-1.0, 0, 1]))
        cov = sum(((votes - mean[:, c]) * w[c][:, None]).T @ (votes - mean[:, c]) for c in (0, 1)) / max(counts.sum(), 1)
        sd = np.sqrt(np.diag(cov)) + 1e-6
        corr = cov / np.outer(sd, sd)
        strong = np.where((corr > 0.3) & ~np.eye(k, dtype=bool), corr, 0.0)  # weaker ones are within the model's own error
        part = 1 / (1 + strong.sum(1))
        if moved < 1e-6:
            break
    return accuracy, corr, prior, post


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic", sample: int = 6000, marked_rows: int = 200_000, z: float = 3.5, ratio: float = 4.0, most: int = 20000) -> ToxicityModel:
    """Votes come from all of docs; lexicons from at most about marked_rows labelled rows, chosen by a hash of the key, so
    that they can be sent to every task and no text is shuffled; the classifier from about sample documents, marked or
    not, half of them with a posterior of 0.5 or more (scores refer to such a half and half mix).

    labels: key and a 0/1 label; rows with a null or other label take no part. A key marked more than once counts as toxic
    if any of its rows is. Repeated documents count as often as they are given; null keys vote but are not drawn. Without
    rows of both labels only the fixed lists vote; without documents the model scores by the prior alone.
    """
    store.small_batches(docs.sparkSession)
    marks = labels.where(F.col(label).isin(0, 1)).groupBy(F.col(key).alias("key")).agg(F.max(label).cast("int").alias("y"))
    marks = marks.where(store.share(F.col("key"), min(1.0, marked_rows / max(1, marks.count()))))
    marks = F.broadcast(store.pinned(marks))
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    lexicons = _lexicons(rows.join(marks, "key").select("text", "y"), z, ratio, most)
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(lexicons)
    digits = 3 ** np.arange(len(VOTERS))

    def vote(batches: Iterator) -> Iterator:
        for b in batches:
            numbers = [int((votes_of(t, _feature_sets(t), shared.value) + 1) @ digits) for t in b["text"]]
            yield pd.DataFrame({"key": b["key"], "y": b["y"], "pattern": numbers})

    kind = rows.schema["key"].dataType.simpleString()
    seen = store.pinned(rows.join(marks, "key", "left").select("key", "text", F.coalesce("y", F.lit(-1)).alias("y")).mapInPandas(vote, f"key {kind}, y int, pattern int"))
    table = seen.groupBy("pattern", "y").count().toPandas()  # at most 3 ** voters * 3 rows
    empty = np.zeros(0, np.int64)
    if table.empty:
        return ToxicityModel(lexicons, np.zeros((len(VOTERS), 2, 3)), np.eye(len(VOTERS)), 0.5, empty, np.zeros(0, np.float32), 0.0)
    votes = table["pattern"].to_numpy()[:, None] // digits % 3 - 1
    accuracy, corr, prior, post = fit_label_model(votes, table["count"].to_numpy(float), table["y"].to_numpy())
    soft = dict(zip(table["pattern"].tolist(), post.tolist(), strict=True))
    features = np.unique(np.concatenate([*(lexicon * 4 + i for i, lexicon in enumerate(lexicons)), _INSULTS * 4]))
    shape = context.broadcast((soft, features))
    high = sorted(p for p, v in soft.items() if v >= 0.5)
    size = table["count"].groupby(table["pattern"].isin(high)).sum()
    part = F.when(F.col("pattern").isin(high), min(1.0, sample / 2 / size.get(True, 1))).otherwise(min(1.0, sample / 2 / size.get(False, 1)))
    drawn = store.pinned(seen.where(store.share(F.col("key"), part)).groupBy("key").agg(F.max("pattern").alias("pattern")))

    def vectors(batches: Iterator) -> Iterator:
        soft, features = shape.value
        for b in batches:
            yield pd.DataFrame({"p": [soft[p] for p in b["pattern"]], "i": [_columns(_feature_sets(t), features).astype(np.int32) for t in b["text"]]})

    got = rows.join(F.broadcast(drawn), "key").select("text", "pattern").mapInPandas(vectors, "p double, i array<int>").toPandas()
    got = got.assign(i=got["i"].map(tuple)).sort_values(["p", "i"], kind="stable")
    used = np.unique(np.concatenate([np.zeros(0, int), *got["i"]]).astype(int))
    x = np.zeros((len(got), used.size + 1), np.float32)
    for row, i in enumerate(got["i"]):
        at = np.searchsorted(used, np.asarray(i, int))
        x[row, at] = 1
        x[row, -1] = np.log1p(len(at))
    if not len(got):
        return ToxicityModel(lexicons, accuracy, corr, prior, empty, np.zeros(0, np.float32), float(np.log(prior / (1 - prior))))
    w, b = textvec.fit_logistic(x, got["p"].to_numpy(np.float32), l2=5e-5, steps=250, rate=0.2)
    weights = np.zeros(features.size + 1, np.float32)
    weights[used], weights[-1] = w[:-1, 0], w[-1, 0]
    unseen = np.setdiff1d(np.arange(features.size), used)
    weights[unseen] = np.median(w[:-1, 0]) if used.size else 0
    return ToxicityModel(lexicons, accuracy, corr, prior, features, weights, float(b[0]))


def _columns(sets: list[np.ndarray], features: np.ndarray) -> np.ndarray:
    """Positions in features of what a text has."""
    mine = np.concatenate([s * 4 + kind for kind, s in enumerate(sets)])
    if not mine.size or not features.size:
        return np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(features, mine), features.size - 1)
    return np.unique(at[features[at] == mine])


def score(docs: DataFrame, model: ToxicityModel, text: str = "text") -> Column:
    """The probability that each whole text is toxic. Null and empty texts have no feature: the bias alone. Repeated rows
    score alike, texts of any length are read whole, other columns play no part."""
    store.small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        for texts in batches:
            out = np.empty(len(texts))
            for k, t in enumerate(texts):
                at = _columns(_feature_sets(t), m.features)
                out[k] = m.bias + m.weights[at].sum() + (m.weights[-1] * np.log1p(at.size) if m.weights.size else 0)
            yield pd.Series(textvec.sigmoid(out))

    return judge(F.col(text))
