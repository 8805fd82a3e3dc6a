"""Top-k search, decontamination and near-duplicates against brute force."""

import os

import duckdb
import numpy as np
import pytest

from tidewell.llm import decontam, maxscore, near_dup, queries, textvec

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def shingle_sets(rows):
    return {k: set(near_dup.shingle_set(t)[0].tolist()) for k, t in rows}


def test_top_k_matches_sql(spark):
    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = sorted(duckdb.sql(queries.OP5_SQL).fetchall())
    assert sorted(map(tuple, queries.op5_exact_top_k(spark, SF).collect())) == want


@pytest.mark.parametrize("scale", [40, 4000, 10**8])
def test_top_k_many_shards_and_ties(spark, scale):
    rng = np.random.default_rng(1)
    v = (rng.standard_normal((700, 12)) * scale).astype(int)
    v[100:400] = v[100]
    rows = spark.createDataFrame([(i, [int(x) for x in r]) for i, r in enumerate(v)], "vec_id long, v array<long>")
    got = maxscore.top_k(rows.where("vec_id % 50 = 0"), rows, 7, shard_rows=90, block_rows=5).collect()
    have = {}
    for r in got:
        have.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    for q in range(0, 700, 50):
        s = v @ v[q]
        best = sorted((i for i in range(700) if i != q), key=lambda i: (-s[i], i))[:7]
        assert sorted(have[q]) == [(k + 1, i, int(s[i])) for k, i in enumerate(best)]


def test_fewer_products_as_the_threshold_rises():
    rng = np.random.default_rng(4)
    v, q = rng.integers(-60, 60, (3000, 32)), rng.integers(-60, 60, (5, 32)) * np.array([8] * 4 + [1] * 28)
    ids, own = np.arange(3000), np.full(5, -1)
    exact = np.sort(v @ q.T, 0)[::-1].T
    made = []
    for floor in (np.full(5, -np.inf), exact[:, 500], exact[:, 9], exact[:, 0]):
        s = maxscore.Search(q, own, floor, 10)
        for at in range(0, 3000, 500):
            s.shard(v[at : at + 500], ids[at : at + 500])
        made.append(s.products)
        for r in range(5):
            want = [x for x in exact[r, :10] if x >= floor[r]]
            assert sorted(s.scores[r].tolist(), reverse=True) == want and (v[s.ids[r]] @ q[r] == s.scores[r]).all()
    assert made == sorted(made, reverse=True) and made[-1] < made[0] < v.size * 5


def test_top_k_of_repeated_rows_matches_sql(spark):
    rng = np.random.default_rng(6)
    rows = [(int(i), [float(x) for x in rng.standard_normal(4)]) for i in [*range(30), 20, 20, 7, 40]] + [(50, None), (60, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").select("vec_id", "embedding")
    v = df.select("vec_id", maxscore.quantized(df.embedding).alias("v"))
    got = maxscore.top_k(v.where("vec_id % 20 = 0"), v, 20, first_rows=3, growth=2).collect()
    con = duckdb.connect()
    con.register("embeddings", df.toArrow())
    assert sorted(map(tuple, got)) == sorted(con.sql(queries.OP5_SQL).fetchall())


def test_top_k_odd_rows(spark):
    rows = spark.createDataFrame([(0, [1.0, 2.0]), (1, None), (2, [float("nan"), 1.0]), (3, [float("inf"), 1.0]), (4, [None, 1.0]), (5, [0.5, -0.01]), (5, [0.5, -0.01]), (6, []), (None, [1.0, 1.0])], "vec_id long, embedding array<float>")
    v = rows.select("vec_id", maxscore.quantized(rows.embedding).alias("v"))
    got = maxscore.top_k(v.where("vec_id in (0, 1, 6)"), v, 3).collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in sorted(got)] == [(0, 1, 5, 64 * 32 - 128), (0, 2, 5, 64 * 32 - 128)]
    assert maxscore.top_k(v.where("false"), v, 3).count() == 0
    assert maxscore.top_k(v, v.where("false"), 3).count() == 0


def test_containment_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    import re

    def grams(t):
        w = [x for x in re.split(r"[\W_]+", t.lower()) if x]
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    d = {r.doc_id: grams(r.text) for r in docs.collect()}
    want = set()
    for r in items.collect():
        g = grams(r.text)
        want |= {(k, r.item_id, len(g), len(g & s)) for k, s in d.items() if g and len(g & s) >= 0.8 * len(g) - 1e-9}
    assert {tuple(r)[:4] for r in decontam.contained(docs, items).collect()} == want and want
    left = decontam.clean(docs, items)
    assert left.columns == docs.columns and left.count() == len(d) - len({w[0] for w in want})


def test_short_items_and_repeated_rows(spark):
    """Items of 1 to 40 words, planted whole or with words changed in long texts, against brute force on word tuples."""
    rng = np.random.default_rng(9)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 400, n)]
    items = [(i, " ".join(word(n))) for i, n in enumerate([1, 2, 3, 4, 5, 6, 7, 9, 12, 15, 20, 25, 30, 40] * 3)]
    docs = []
    for i in range(120):
        own = word(int(rng.integers(1, 300)))
        for j in rng.choice(len(items), 3):
            planted = items[j][1].split()
            if rng.random() < 0.5:
                planted[int(rng.integers(len(planted)))] = "zz"
            own[len(own) // 2 : len(own) // 2] = planted
        docs.append((i, " ".join(own)))
    docs.append((200, " ".join(word(60000)) + " " + items[13][1]))

    def grams(text):
        w = text.split()
        return lambda k: {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}

    want = set()
    for d, text in docs:
        of = grams(text)
        sets = {k: of(k) for k in range(1, 6)}
        for i, item in items:
            k = min(5, len(item.split()))
            g = grams(item)(k)
            if len(g & sets[k]) >= 0.8 * len(g):
                want.add((d, i, len(g), len(g & sets[k])))
    make = lambda rows, name: spark.createDataFrame(rows, f"{name} long, text string")
    got = decontam.contained(make(docs + docs[:5], "doc_id"), make(items + items[:3], "item_id")).collect()
    assert len(got) == len(want) and {tuple(r)[:4] for r in got} == want
    assert {n for *_, n, _ in want} >= {1, 2, 3, 5}


def test_containment_odd_rows(spark):
    text = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(1, f"x {text.upper()}! y", 0), (1, f"x {text.upper()}! y", 0), (2, None, 0), (3, "", 0), (4, "one two three four", 0), (5, "one two three four five six seven eight nine", 0), (None, text, 0)], "doc_id long, text string, h int")
    items = spark.createDataFrame([(7, text, 1), (8, "one two", 1), (9, None, 1), (None, text, 1)], "item_id long, text string, h int")
    short = {(k, 8, 1, 1, 1.0) for k in (1, 4, 5)}
    assert {tuple(r) for r in decontam.contained(docs, items).collect()} == {(1, 7, 6, 6, 1.0), (5, 7, 6, 5, 5 / 6)} | short
    assert decontam.contained(docs, items.where("false")).count() == 0
    assert decontam.contained(docs.where("false"), items).count() == 0
    assert sorted(r.doc_id or 0 for r in decontam.clean(docs, items).collect()) == [0, 2, 3]


def brute_classes(sets, threshold=0.8):
    keys = [k for k in sorted(sets) if sets[k]]
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    where = {}
    for k in keys:
        for s in sets[k]:
            where.setdefault(s, []).append(k)
    for k in keys:
        for o in {o for s in sets[k] for o in where[s] if o > k}:
            both = len(sets[k] & sets[o])
            if both >= threshold * (len(sets[k]) + len(sets[o]) - both) - 1e-9:
                a, b = find(k), find(o)
                root[max(a, b)] = min(a, b)
    return {k: find(k) for k in keys}


def test_classes_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute_classes(shingle_sets((r.doc_id, r.text) for r in docs.collect()))
    got = {r.doc_id: r.class_id for r in near_dup.classes(docs).collect()}
    assert got == want and len(set(want.values())) < len(want)


def test_classes_of_chains_and_rings(spark, monkeypatch):
    """Long chains in which neighbours are similar and others aren't, in blocks so small that many are needed."""
    monkeypatch.setattr(near_dup, "BLOCK", 4)
    rng = np.random.default_rng(0)
    base = [f"w{i}" for i in rng.permutation(2000)]
    rows = [(i, " ".join(base[2 * i : 2 * i + 60])) for i in range(9)]
    star = [f"s{i}" for i in range(100)]
    for i in range(100, 114):
        own = list(star)
        for j in rng.choice(100, 1 if i % 2 else 2, replace=False):
            own[j] = f"q{i}_{j}"
        rows.append((i, " ".join(own)))
    rows = [(i * 7919 % 100003, t) for i, t in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near_dup.classes(docs).collect()}
    assert got == brute_classes(shingle_sets(rows))


def test_classes_when_hub_is_reached_through_others(spark, monkeypatch):
    """In the one bucket of l and r, l is in the hub's component only through m, and r is far from the hub."""
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(base[6 * i : 6 * i + 60])) for i in range(4)]
    bands = {0: [1, 2, 6], 1: [9, 2, 5], 2: [1, 3, 5], 3: [1, 4, 7]}
    monkeypatch.setattr(near_dup, "_signatures", lambda *a: spark.createDataFrame([(k, near_dup.signature(t)[0], k, k, bands[k]) for k, t in rows], "id long, n int, fa long, fb long, bands array<long>"))
    sets = shingle_sets(rows)
    assert len(sets[0] & sets[3]) / len(sets[0] | sets[3]) < 0.6
    got = {r.doc_id: r.class_id for r in near_dup.classes(spark.createDataFrame(rows, "doc_id long, text string"), 0.78).collect()}
    assert got == brute_classes(sets, 0.78) == dict.fromkeys(range(4), 0)


def test_classes_of_a_large_drifting_family(spark):
    """Versions that drift by one changed word each from an earlier one, so that hubs are far from most of their bucket."""
    rng = np.random.default_rng(3)
    texts = [[f"d{i}" for i in range(80)]]
    for i in range(1, 500):
        own = list(texts[rng.integers(max(0, i - 20), i)])
        for j in rng.choice(80, rng.integers(1, 3), replace=False):
            own[j] = f"v{i}_{j}"
        texts.append(own)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = {r.doc_id: r.class_id for r in near_dup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_classes(shingle_sets(rows))


def test_classes_of_copies_with_other_repeats(spark):
    """Pairs of similarity just above 0.8 in which one copy repeats a common line 1000 times."""
    rng, rows = np.random.default_rng(8), []
    line = " ".join(f"line{i}" for i in range(40)) + "\n"
    for k in range(60):
        word = lambda n: " ".join(map(str, rng.integers(10**9, 10**10, n)))  # noqa: E731, B023
        same = word(72)
        rows += [(2 * k, f"{line * 2}{same} {word(12)}"), (2 * k + 1, f"{line * 1000}{same} {word(12)}")]
    sets = shingle_sets(rows)
    assert all(0.8 <= len(sets[k] & sets[k + 1]) / len(sets[k] | sets[k + 1]) < 0.84 for k in range(0, 120, 2))
    got = {r.doc_id: r.class_id for r in near_dup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {k: k - k % 2 for k in range(120)} == brute_classes(sets)


def test_classes_odd_rows(spark):
    rows = [(1, "a b c", 1), (2, "A, b; C!", 1), (3, None, 1), (4, "", 1), (5, "...", 1), (6, "x", 1), (6, "x", 1), (None, "a b c", 1), (7, "word " * 30000, 1), (8, "word " * 29000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, class_id int")
    got = {r.doc_id: (r.class_id, r.class_size) for r in near_dup.classes(docs).collect()}
    assert got == {1: (1, 2), 2: (1, 2), 6: (6, 1), 7: (7, 2), 8: (7, 2)}
    kept = near_dup.one_of_each(docs)
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 3, 4, 5, 6, 6, 7] and kept.columns == docs.columns
    assert near_dup.classes(docs.where("false")).count() == 0


def test_components_of_chains_in_any_order(spark):
    rng = np.random.default_rng(2)
    line = rng.permutation(600) + 1000
    edges = [(int(a), int(b)) for a, b in zip(line, line[1:], strict=False)] + [(1, 2), (2, 2), (5, 4)]
    got = {r.id: r.root for r in near_dup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {int(x): 1000 for x in line} | {1: 1, 2: 1, 4: 4, 5: 4}
    assert near_dup.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_repeated_keys_with_other_texts(spark):
    rows = [(1, "a b c d e f"), (1, "u v w x y z"), (2, "u v w x y z"), (3, "a b c d e f"), (4, "a b c d e f")]
    seen = [tuple(sorted((r.doc_id, r.class_id) for r in near_dup.classes(spark.createDataFrame(part, "doc_id long, text string")).collect())) for part in (rows, rows[::-1])]
    assert seen[0] == seen[1] and seen[0] in (((1, 1), (2, 1), (3, 3), (4, 3)), ((1, 1), (2, 2), (3, 1), (4, 1)))


@pytest.mark.parametrize("m", [1, 96, 2048, 4096])
def test_all_registers_are_filled_alike(m):
    keys = textvec.mix64(np.arange(1, 51))
    sig = near_dup.prob_minhash(keys, np.ones(50), m)
    assert sig.size == m and set(sig.tolist()) <= set(keys.tolist())
    with pytest.raises(ValueError):
        near_dup.prob_minhash(keys, np.ones(50), 0)


def test_prob_minhash_estimates_weighted_similarity():
    rng = np.random.default_rng(5)
    keys = rng.integers(0, 2**63, 300).astype(np.uint64)
    a, b = rng.uniform(0.5, 5, 300), rng.uniform(0.5, 5, 300)
    a[:60], b[240:] = 0, 0
    ia, ib = np.flatnonzero(a), np.flatnonzero(b)
    m = 4096
    same = (near_dup.prob_minhash(keys[ia], a[ia], m) == near_dup.prob_minhash(keys[ib], b[ib], m)).mean()
    both = np.flatnonzero((a > 0) & (b > 0))
    want = sum(1 / np.maximum(a / a[d], b / b[d]).sum() for d in both)
    assert abs(same - want) < 0.035
    assert textvec.shingles(textvec.word_hashes("a b")).size == 1
