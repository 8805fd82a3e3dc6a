"""Filter interactions, secrets and clusters against brute force."""

import hashlib
import itertools
import math
import os
import random
import re

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewell.llm import centroids, interactions, queries, secret_scan

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def sql_rows(name, **views):
    con = duckdb.connect()
    for table, rows in views.items():
        con.register(table, rows)
    rel = con.sql(queries.ORACLE_SQL[name])
    return rel.columns, sorted(map(repr, rel.fetchall()))


@pytest.mark.parametrize("k", [1, 2, 3, 4, 5])
def test_intervals_are_the_orders(k):
    letters = "ABCDE"[:k]
    orders = ["".join(p) for p in itertools.permutations(letters)]
    assert [interactions.ordering(r, letters) for r in range(math.factorial(k))] == orders
    for mask in range(1 << k):
        want = [next((s for s, c in enumerate(o, 1) if mask >> letters.index(c) & 1), 0) for o in orders]
        got = [0] * len(orders)
        for step, a, b in interactions.intervals(mask, k):
            assert got[a:b] == [0] * (b - a)
            got[a:b] = [step] * (b - a)
        assert got == want


TEXTS = [None, "", " \t\n", "a " * 300, " ".join(f"w{i}" for i in range(250)), "A" * 40 + " x" * 300, "rare # sign", "rare # sign", "\x1c word joined", "é" * 10 + "ABC", "long " * 50000 + "| end"]


def brute_audit(docs, labels):
    """Every order is run filter by filter over every document."""
    fails = []
    for key, text, lang in docs:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        got = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": key is not None and any(k is not None and k < key and (o or "") == t for k, o, _ in docs)}
        good = any(k == key and q == 1 for k, q, _ in labels if key is not None)
        toxic = any(k == key and x == 1 for k, _, x in labels if key is not None)
        fails.append((lang or "", got, good, toxic))
    out, shapley = [], {}
    for part in {f[0] for f in fails}:
        for order in itertools.permutations("ABCDE"):
            here = [f for f in fails if f[0] == part]
            for step, c in enumerate(order, 1):
                gone = [f for f in here if f[1][c]]
                here = [f for f in here if not f[1][c]]
                failing = [f for f in fails if f[0] == part and f[1][c]]
                shapley[part, c] = shapley.get((part, c), 0) + len(gone)
                out.append((part, "".join(order), step, c, len(here), len(gone), len(failing) - len(gone), sum(sum(f[1].values()) == 1 for f in failing), sum(f[2] for f in gone), sum(f[3] for f in gone)))
    return sorted((p, o, s, a, b, r, u, g, t, shapley[p, c]) for p, o, s, c, a, b, r, u, g, t in out)


def test_audit_of_odd_rows(spark):
    docs = [(i, t, ["en", "de", None, ""][i % 4]) for i, t in enumerate(TEXTS)] + [(20, TEXTS[4], "en"), (20, TEXTS[4], "en"), (20, "other", "de"), (None, TEXTS[4], "en"), (None, TEXTS[6], None), (21, "only this", "fr"), (22, "only this", None)]
    labels = [(4, 1, 0), (4, 0, 1), (4, None, None), (20, 1, 1), (None, 1, 1), (99, 1, 1), (6, 0, 1)]
    extra = [(*d, "clash", 7, 1) for d in docs]
    df = spark.createDataFrame(extra, "doc_id long, text string, lang string, part string, mask int, n int")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = interactions.audit(df, lab)
    want = brute_audit(docs, labels)
    cols = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "lost_good", "lost_toxic", "shapley"]
    assert sorted(tuple(r[c] for c in cols) for r in got.collect()) == want
    names, rows = sql_rows("op11_filter_interactions", documents=df.toPandas(), labels=lab.toPandas())
    order = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(repr(tuple(w[order.index(c)] for c in names)) for w in want) == rows
    assert interactions.audit(df.where("false"), lab).count() == 0
    assert interactions.audit(df, lab.where("false")).agg({"lost_good": "sum"}).first()[0] == 0


def test_audit_of_other_filters(spark):
    """Three filters, two sums, null masks and repeated cells."""
    counts = spark.createDataFrame([("p", 5, 2, 1), ("p", 5, 1, None), ("p", None, 4, 4), (None, 2, 3, 1)], "p string, m int, docs int, chars int")
    rows = {(r.part, r.filter_order, r.step): r for r in interactions.totals(counts, ["docs", "chars"], "p", "m", "XYZ").collect()}
    assert len(rows) == 2 * 6 * 3
    r = rows["p", "YXZ", 2]
    assert (r.kept, r.removed, r.redundant, r.unique_fails, r.lost_chars, r.shapley) == (4, 3, 0, 0, 1, 9)
    assert rows[None, "XYZ", 1].kept == 3 and rows[None, "XZY", 3].removed == 3


def test_audit_matches_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    rel = con.sql(queries.OP11_SQL)
    got = queries.op11_filter_interactions(spark, SF).select(*rel.columns).collect()
    assert sorted(map(tuple, got)) == sorted(rel.fetchall()) and len(got) == 600 * con.sql("SELECT count(DISTINCT coalesce(lang, '')) FROM documents").fetchall()[0][0]


BASE = {"assign": re.compile(r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"), "access": re.compile(r"AKIA[A-Z0-9]+"), "hex": re.compile(r"[0-9a-f]+")}


def brute_base(text):
    out = []
    for rank, (kind, p) in enumerate(BASE.items()):
        for m in p.finditer(text or ""):
            if len(m[2] if kind == "assign" else m[0]) >= {"assign": 6, "access": 20, "hex": 24}[kind]:
                out.append((m.start(), rank, kind, m.end()))
    return [(kind, s, e) for s, _, kind, e in sorted(out)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["token", "ToKen", "Key", "tokKn", "paſſword", "password", "api_key", "APIkey", " ", "=", ":", '"', "'", "AKIA", "AKIAAKIA", "A1B2C3D4E5F6G7H8", "0123456789abcdef", "deadbeef", "é", "\U0001f600", "\n", "x" * 6, "-", "=="]), max_size=14).map("".join))
def test_base_spans_are_the_patterns(text):
    assert secret_scan.base_spans(text) == brute_base(text)


def test_automata_keep_prefixes_and_loop_over_the_rest():
    words = secret_scan.made("github", 300)
    a = secret_scan.learn(words)
    assert len(a.seen) < 12 and sum(a.ends) == 300 and a.seen[0] == 300
    fresh, noise = secret_scan.made("github", 50, seed=6), secret_scan.made("base64", 50, seed=6)
    assert min(map(a.loglik, fresh)) > max(a.loglik(w) for w in noise)
    # counts are kept: what enters a state leaves or ends
    for s in range(len(a.seen)):
        assert a.seen[s] == a.ends[s] + sum(k for _, k in a.next[s].values())
    # two formats with unlike second characters are told apart, equal tails share one state
    b = secret_scan.learn(["ax" + "01" * 5] * 100 + ["by" + "01" * 5] * 100)
    assert b.loglik("ax" + "01" * 5) > b.loglik("ay" + "01" * 5) + 3
    assert secret_scan.learn([]).next == [{}]
    # the chances of all words of up to n characters and of the rest sum to about one
    c = secret_scan.learn(["a", "ab", "b"] * 400)
    assert abs(sum(math.exp(c.loglik("".join(w))) for n in range(6) for w in itertools.product("ab", repeat=n)) - 1) < 0.02


def test_planted_secrets_and_clean_texts(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(2, 9)))
    clean = [(i, " ".join(word() for _ in range(120)) + f" see {word()}.example.com/{word()}/{word()}.html on 2024-01-02 {rng.randint(10**15, 10**16)}") for i in range(200)]
    planted, at = [], 1000
    for name in secret_scan.FORMATS:
        for w in secret_scan.made(name, 8, seed=31):
            planted.append((at, f"{word()} {word()} {w} {word()}", name, w))
            at += 1
    docs = spark.createDataFrame(clean + [p[:2] for p in planted] + [(None, "token = abcdef"), (5000, None), (5001, ""), (1000, planted[0][1])], "doc_id long, text string")
    model = secret_scan.fit(docs)
    assert model.held_out[0] >= 0.99 and model.held_out[1] > 0.95
    got = [(r.doc_id, r.text, r.p) for r in docs.withColumn("p", secret_scan.scan(docs, model)).collect()]
    assert len(got) == docs.count()
    found = {k: [t[s.start : s.end] for s in p.spans] for k, t, p in got if k is not None and k >= 1000}
    caught = sum(w.rstrip("._-/+") in " ".join(found[k]) for k, _, _, w in planted)
    assert caught >= 0.95 * len(planted)
    assert sum(bool(p.spans) for k, _, p in got if k is not None and k < 1000) == 0
    assert [p.joined for k, _, p in got if k is None] == ["assign:0:14"] and found[5000] == found[5001] == []
    model = secret_scan.fit(docs.where("false"))
    assert set(model.formats) == set(secret_scan.FORMATS) and docs.where("false").withColumn("p", secret_scan.scan(docs, model)).count() == 0


def test_secret_scan_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = secret_scan.fit(docs.select("doc_id", "text"))
    got = {r.doc_id: r for r in queries.op12_secret_scan(spark, SF).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for d, t in rows:
        base = brute_base(t)
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        r = got[d]
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == kind for k, _, _ in base) for kind in BASE]
        spans = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in r.spans.split(",") if s)]
        assert set(base) <= set(spans) and spans == sorted(spans, key=lambda s: (s[1], secret_scan.KINDS.index(s[0]), s[2]))
        # the added ones: every run scored by itself
        want = set(base)
        for s, e in secret_scan.candidates(t):
            if all(e <= a or b <= s for _, a, b in base):
                best = max((a.loglik(t[s:e]), k) for k, a in model.formats.items())
                if model.odds(t[s:e])[0] >= model.threshold:
                    want.add((best[1], s, e))
        assert set(spans) == want


def brute_clusters(rows, k=16, rounds=3, size=64):
    kept = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    kept = [(i, [max(-centroids.LARGEST, min(centroids.LARGEST, x)) for x in v]) for i, v in kept]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    cs = [v for _, v in order[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(cs))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        cs = [[sum(x) // len(groups[j]) for x in zip(*groups[j], strict=True)] if j in groups else c for j, c in enumerate(cs)]
    found = [(i, *reversed(near(v))) for i, v in kept]
    per = {}
    for _, c, d in found:
        per[c] = per.get(c, 0) + d
    fit = lambda x: x if x < 1 << 63 else None
    return sorted(repr((i, c, d, fit(per[c]), fit(sum(per.values())), hashlib.sha256(",".join(map(str, cs[c])).encode()).hexdigest())) for i, c, d in found)


@pytest.mark.parametrize("case", ["mixed", "few", "equal", "large", "spread"])
def test_clusters_against_brute_force(spark, case):
    rng = np.random.default_rng(3)
    v = rng.standard_normal((300, 64)) * (0.3 if case == "mixed" else 1)
    if case == "equal":
        v[:] = v[0]
    if case == "large":
        v *= 10.0 ** rng.integers(0, 9, (300, 1))
    if case == "spread":
        v = np.repeat(rng.standard_normal((30, 64)) * 3, 10, 0) + rng.standard_normal((300, 64)) * 0.01
    rows = [(int(i), [float(x) for x in r]) for i, r in enumerate(v[: 9 if case == "few" else 300])]
    rows += [(3, rows[3][1]), (4, rows[5][1]), (None, rows[6][1]), (None, [0.25] * 64), (900, None), (901, [1.0] * 63), (902, [None] + [1.0] * 63), (903, [float("nan")] * 64), (904, [float("inf")] * 64), (905, [-0.001] * 64)]
    df = spark.createDataFrame([(i, x, 1, "n") for i, x in rows], "vec_id long, embedding array<double>, cluster int, key string")
    found, centres = centroids.clusters(centroids.kept_vectors(df))
    got = centroids.with_inertia(found, centres)
    cols = ["key", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(repr(tuple(r[c] for c in cols)) for r in got.collect()) == brute_clusters(rows)
    empty, none = centroids.clusters(centroids.kept_vectors(df.where("false")))
    assert centroids.with_inertia(empty, none).count() == 0


def test_bounds_hold_and_spare_distances():
    rng = np.random.default_rng(5)
    for scale in (3, 1000, centroids.LARGEST):
        v = rng.integers(-scale, scale + 1, (400, 64))
        centres = v[rng.choice(400, 16, replace=False)]
        p = centroids.Pivots(centres.copy())
        near = centroids.to_all(v, p.points)
        moved = centres + rng.integers(-2, 3, centres.shape)
        exact = np.stack([centroids.squared(v, c) for c in moved], 1)
        assert (p.lower(near, centroids.to_all(moved, p.points)) <= np.sqrt(exact.astype(float))).all()
        cluster, best = p.assign(v, near, moved)
        assert (cluster == exact.argmin(1)).all() and (best == exact.min(1)).all()
    # in clusters far from each other nearly all distances are spared
    v = np.repeat(rng.integers(-1000, 1000, (16, 64)), 50, 0) + rng.integers(-3, 4, (800, 64))
    p = centroids.Pivots(v[::50].copy())
    p.assign(v, centroids.to_all(v, p.points), v[::50] + 1)
    assert p.measured < 0.1 * p.bounded


def test_clusters_match_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    rel = con.sql(queries.OP13_SQL)
    assert sorted(map(tuple, queries.op13_centroid_clusters(spark, SF).select(*rel.columns).collect())) == sorted(rel.fetchall())
