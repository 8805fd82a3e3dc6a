"""Language identification with error-correcting output codes.

Each language has a codeword. One binary logistic classifier on hashed character n-grams predicts each bit; the
decoder weighs each bit's logistic loss by that bit's training reliability and takes the codeword with the least sum.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import store, textvec

SCHEMA = "lang_pred string, score double, margin double, ambiguous boolean"


@dataclass
class LanguageModel:
    """names: languages; code: languages x bits in {-1, 1}; weights, bias: of the bits; trust: weight of each bit."""

    names: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray
    bits: int
    scale: float = 4.0
    close: float = 0.15

    def decode(self, z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best language, its probability and the gap to the second, from the bits' margins z (n x bits)."""
        loss = np.stack([(np.logaddexp(0, -z * row) * self.trust).sum(1) for row in self.code], 1)
        p = np.exp(-self.scale * (loss - loss.min(1, keepdims=True)))
        p /= p.sum(1, keepdims=True)
        order = np.argsort(-p, axis=1, kind="stable")
        best = order[:, 0]
        top = p[np.arange(len(p)), best]
        return best, top, top - (p[np.arange(len(p)), order[:, 1]] if p.shape[1] > 1 else 0)


def codewords(k: int, seed: int = 7) -> np.ndarray:
    """Exhaustive codes for up to 6 languages; above, the random code of 10 log2 k bits with the largest distance."""
    if k <= 1:
        return np.ones((k, 1), np.float32)
    if k <= 6:
        cols = [[1] + [1 if c >> j & 1 else -1 for j in range(k - 1)] for c in range(2 ** (k - 1) - 1)]
        return np.array(cols, np.float32).T
    rng, best, far = np.random.default_rng(seed), None, -1
    for _ in range(50):
        code = rng.choice([-1, 1], (k, int(np.ceil(10 * np.log2(k)))))
        apart = min((code[i] != code[j]).sum() for i in range(k) for j in range(i))
        if apart > far:
            best, far = code, apart
    return best.astype(np.float32)


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", per_language: int = 500, bits: int = 13) -> LanguageModel:
    """Fits on a bounded sample: about per_language rows of each language (whole texts), chosen by a hash of the key.

    Rows with a null language or text take no part; without any rows the model knows no language and answers und.
    """
    store.small_batches(docs.sparkSession)
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    counts = {r[0]: r[1] for r in rows.groupBy(lang).count().collect()}
    names = sorted(counts)
    if not names:
        return LanguageModel([], np.ones((0, 1)), np.zeros((1 << bits, 1)), np.zeros(1), np.ones(1), bits)
    part = F.create_map(*[F.lit(v) for n in names for v in (n, min(1.0, per_language / counts[n]))])[F.col(lang)]

    def vectors(batches: Iterator) -> Iterator:
        for b in batches:
            x = [textvec.unit(textvec.hashed_ngrams(t, bits)) for t in b["text"]]
            at = [np.flatnonzero(v).astype(np.int32) for v in x]
            yield pd.DataFrame({"lang": b["lang"], "i": at, "v": [v[i] for v, i in zip(x, at, strict=True)]})

    got = rows.where(store.share(F.col(key), part)).select(F.col(text).alias("text"), F.col(lang).alias("lang")).mapInPandas(vectors, "lang string, i array<int>, v array<float>").toPandas()
    got = got.sort_values("lang", kind="stable")
    x = np.zeros((len(got), 1 << bits), np.float32)
    for row, (i, v) in enumerate(zip(got["i"], got["v"], strict=True)):
        x[row, np.asarray(i)] = v
    y = np.searchsorted(names, got["lang"].to_numpy().astype(str))
    code = codewords(len(names))
    weights, bias = textvec.fit_logistic(x, (code[y] + 1) / 2, l2=1e-5, steps=150, rate=1.0)
    right = ((x @ weights + bias > 0) == (code[y] > 0)).mean(0) if len(got) else np.ones(code.shape[1])
    trust = np.log(np.clip(right, 0.51, 0.999) / (1 - np.clip(right, 0.51, 0.999)))
    return LanguageModel(names, code, weights, bias, trust / trust.sum(), bits)


def predict(docs: DataFrame, model: LanguageModel, text: str = "text") -> Column:
    """A struct column (lang_pred, score, margin, ambiguous) for each whole text.

    und with score 0 for a null text, a text without a letter, or a model without languages. ambiguous: the two best
    languages are closer than model.close; ties go to the first language by name.
    """
    store.small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(SCHEMA)
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for texts in batches:
            out = []
            for at in range(0, len(texts), 256):
                part = texts.iloc[at : at + 256]
                x = np.stack([textvec.unit(textvec.hashed_ngrams(t, m.bits)) for t in part])
                known = np.array([bool(m.names) and t is not None and any(map(str.isalpha, t)) for t in part])
                if not m.names:
                    best, top, gap = np.zeros(len(part), int), np.zeros(len(part)), np.zeros(len(part))
                else:
                    best, top, gap = m.decode(x @ m.weights + m.bias)
                names = np.array([*m.names, "und"], object)
                out.append(pd.DataFrame({"lang_pred": names[np.where(known, best, len(m.names))], "score": np.where(known, top, 0.0), "margin": np.where(known, gap, 0.0), "ambiguous": ~known | (gap < m.close)}))
            yield pd.concat(out) if out else pd.DataFrame({"lang_pred": pd.Series(dtype=str), "score": pd.Series(dtype=float), "margin": pd.Series(dtype=float), "ambiguous": pd.Series(dtype=bool)})

    return judge(F.col(text))


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", prefix: str = "") -> DataFrame:
    """All rows and columns of docs with lang_pred, score, margin and ambiguous (after prefix; same names are replaced)."""
    got = docs.withColumn("__judged", predict(docs, model, text))
    return got.withColumns({f"{prefix}{c}": F.col(f"__judged.{c}") for c in ("lang_pred", "score", "margin", "ambiguous")}).drop("__judged")
