"""Exits over sorted batches."""

from datetime import datetime, timedelta

import numpy as np
import pyarrow as pa
import pytest
from test_queries import SF

from tidewell.operators import paths, rules
from tidewell.plans import registry


def test_first_at_least():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 3, 17, 64, 100):
        values = np.where(rng.random(n) < 0.2, -np.inf, rng.integers(0, 50, n).astype(float))
        start, level = rng.integers(0, n + 2, 300), rng.integers(0, 60, 300).astype(float)
        got = paths.first_at_least(values, start, level)
        assert got.tolist() == [next((i for i in range(s, n) if values[i] >= x), n) for s, x in zip(start, level, strict=True)]


def test_position_exits_shuffles_lines_once(spark):
    """Before: bars, positions and searches were shuffled and pinned many times over, 36 times the input."""
    plan = registry.queries()["position_exits"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "l_suppkey" in plan


@pytest.fixture(scope="module")
def odd(spark):
    """Bars and positions with gaps, nulls, NaN and infinite prices; a long series and series of a row."""
    rng = np.random.default_rng(3)
    bars, pos = [], []
    price = lambda x: [None, float("nan"), float("inf"), x][min(3, int(rng.integers(0, 40)))]
    for s, n in (("long", 900), ("b", 120), ("one", 1), ("c", 60)):
        t, x = datetime(2024, 1, 1), 100.0
        for i in range(n):
            t += timedelta(hours=int(rng.integers(1, 30)))
            x = max(1.0, x + float(rng.integers(-4, 5)))
            bars.append((s, t, price(x + 1), price(x - 1), None if i < 3 else price(2.0)))
            for k in range(int(rng.integers(0, 3))):
                pos.append((f"{s}{i}{k}", s, t + timedelta(minutes=30 * k), price(x), price(x - 8), price(x + 8)))
    pos += [("no bars", "x", datetime(2024, 1, 2), 1.0, 1.0, 1.0), ("no symbol", None, datetime(2024, 1, 2), 1.0, 1.0, 1.0), ("no date", "b", None, 1.0, 1.0, 1.0), ("early", "b", datetime(2020, 1, 1), 1.0, None, None)]
    b = spark.createDataFrame(bars, "symbol string, ts timestamp_ntz, high double, low double, atr double")
    p = spark.createDataFrame(pos, "id string, symbol string, entry_date timestamp_ntz, entry double, stop double, target double")
    return bars, pos, b, p


def brute(bars, pos, multiple, days):
    big = lambda v: (1, 0.0) if v != v else (0, v)  # noqa: E731  # NaN is the largest number
    out = {}
    for key, s, entered, entry, stop, target in pos:
        top, want = entry, (None, None)
        for _, d, high, low, atr in (b for b in bars if b[0] == s and entered is not None and b[1] > entered):
            c = None if low is None or atr is None else low + multiple * atr
            le = lambda a, b: a is not None and b is not None and big(a) <= big(b)
            why = "stop" if le(low, stop) else "trailing" if le(c, top) else "target" if le(target, high) else "time" if (d.date() - entered.date()).days >= days else None
            if why:
                want = (d, why)
                break
            top = top if high is None else high if top is None else max(top, high, key=big)
        out[key] = want
    return out


@pytest.mark.parametrize("days", [1, 20])
def test_exits_on_odd_prices(spark, odd, days):
    bars, pos, b, p = odd
    want = brute(bars, pos, 1.5, days)
    for most in (2_000_000, 500):  # with 500 the long series goes through blocks
        if most == 500:
            finite = lambda r: all(v is None or abs(v) < float("inf") for v in r if isinstance(v, float))
            bars, pos = [r for r in bars if finite(r)], [r for r in pos if finite(r)]
            b, p, want = spark.createDataFrame(bars, b.schema), spark.createDataFrame(pos, p.schema), brute(bars, pos, 1.5, days)
        got = rules.exits(p, b, 1.5, days, most).collect()
        assert len(got) == len(pos)
        assert {r.id: (r.exit_date, r.reason) for r in got} == want


@pytest.mark.parametrize("chunk", [1, 7, 100])
def test_chunks_carry_open_positions(spark, odd, chunk):
    bars, pos, b, p = odd
    rows = rules._walked(p, b, 1.5, 20)
    assert rows.count() == len(pos)
    at = {k: i for i, k in enumerate(["long", "b", "one", "c"])}
    micros = lambda d: int((d - datetime(1970, 1, 1)).total_seconds() * 1e6)
    flat = [(at[s], micros(d), False, d, h, lo, None if lo is None or a is None else lo + 1.5 * a, None, None, None, None, None) for s, d, h, lo, a in bars]
    flat += [(at[s], micros(d), True, None, None, None, None, e, st, ta, micros(datetime.combine(d.date(), datetime.min.time()) + timedelta(20)), k) for k, s, d, e, st, ta in pos if s in at and d]
    flat.sort(key=lambda r: r[:3])
    names = ["s", "__t", "__pos", "d", "high", "low", "__c", "entry", "stop", "target", "__limit", "id"]
    types = [pa.int64(), pa.int64(), pa.bool_(), pa.timestamp("us"), *[pa.float64()] * 6, pa.int64(), pa.string()]
    count: dict[int, int] = {}
    numbers = []
    for r in flat:
        count[r[0]] = count.get(r[0], 0) + 1
        numbers.append(count[r[0]])
    table = pa.table({n: pa.array([r[i] for r in flat], y) for i, (n, y) in enumerate(zip(names, types, strict=True))} | {"__n": numbers, "__bar": [not r[2] for r in flat]})
    got = pa.Table.from_batches(paths.walker(["id"], chunk)(table.to_batches(max_chunksize=5))).to_pylist()
    want = {k: v for k, v in brute(bars, pos, 1.5, 20).items() if k not in ("no bars", "no symbol", "no date")}
    assert len(got) == len(want) and {r["id"]: (r["exit_date"], r["reason"]) for r in got} == want
