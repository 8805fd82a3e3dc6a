"""The secret model counts every document and every labelled value."""

import random

import numpy as np

from tidewell.llm import secret_scan


def shape(a):
    return a.next, a.seen, a.ends


def values(spark, rows):
    return spark.createDataFrame([("hex", v) for v in rows], "kind string, value string")


def test_automata_of_all_values_as_by_words(spark):
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("ab01") for _ in range(rng.randint(3, 9))) + rng.choice(["-x", "-y9"]) for _ in range(400)})
    want = secret_scan.learn(words)
    got = secret_scan.learn_all(values(spark, words), {"hex": sum(map(len, words))})["hex"]
    assert shape(got) == shape(want)


def test_long_values_and_bounded_trees_count_all(spark):
    """With a small tree and short rounds the driver holds few prefixes, but each value's moves and ending are counted."""
    rng = random.Random(2)
    words = sorted({"pre_" + "".join(rng.choice("0123456789abcdef") for _ in range(20)) + "-" + "z" * 10 for _ in range(600)} | {"q" * 300})
    a = secret_scan.learn_all(values(spark, words), {"hex": sum(map(len, words))}, depth=6, nodes=500)["hex"]
    assert sum(a.ends) == len(words) and sum(n for m in a.next for _, n in m.values()) == sum(map(len, words))
    assert a.seen[0] >= len(words) and len(a.next) < 100
    assert all(np.isfinite(a.loglik(w)) for w in words)


def test_pairs_of_texts():
    texts = ["ab c=1", "", "é-x\ty", "end."]
    want = np.zeros((secret_scan.CHARACTERS,) * 2, int)
    for w in ("ab", "c=1", "-x", "y", "end."):
        for p in secret_scan._pairs(w):
            want[p] += 1
    assert (secret_scan._text_pairs(texts).reshape(want.shape) == want).all()


def test_every_document_counts(spark):
    """Before: about 20,000 documents and at most 2,000 values a kind."""
    rng = random.Random(3)
    some = ["%040x" % rng.getrandbits(160) for _ in range(2600)]
    docs = spark.createDataFrame([(i, f"word {v} word") for i, v in enumerate(some)], "doc_id long, text string").repartition(4)
    train = [v for v in some if secret_scan.hashlib.md5(v.encode()).digest()[0] % 3]
    model = secret_scan.fit(docs.unionByName(spark.range(25_000).selectExpr("id + 10000 AS doc_id", "'zq' AS text")))
    a = model.formats["hex"]
    assert len(train) > 1400 and sum(a.ends) == len(train)
    z, q = secret_scan.INDEX["z"], secret_scan.INDEX["q"]
    chance = np.exp(model.ordinary[z, q])
    assert chance > 0.9
