"""Scalar column functions: dates, ratios, text and prices. All are built from JVM expressions."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Transaction codes and words that are no tickers.
INSIDER_CODES = {"P": "purchase", "S": "sale", "A": "grant", "D": "disposition", "F": "tax", "M": "exercise", "G": "gift", "C": "conversion"}
STOP_WORDS = "A I AM AN AND ARE AS AT BE BY CEO CFO DD EPS ETF FOR FROM GDP HAS IN IPO IS IT NOT OF ON OR SEC SO THE TO US USA WAS WE WITH YOLO YOU".split()


def split_ratio(text: Column, invalid: float | None = 1.0) -> Column:
    """'a:b' or a number as a/b; what is no ratio, or has a zero in it, becomes invalid."""
    top, low = F.split_part(text, F.lit(":"), F.lit(1)).try_cast("double"), F.split_part(text, F.lit(":"), F.lit(2)).try_cast("double")
    value = F.when(text.contains(":"), F.try_divide(top, low)).otherwise(text.try_cast("double"))
    good = F.when(value > 0, value)
    return good if invalid is None else F.coalesce(good, F.lit(invalid))


def padded_timestamp(digits: Column) -> Column:
    """'YYYYMMDD...' filled with zeros to 14 digits, as a timestamp without zone; null if it is none."""
    return F.expr("try_to_timestamp(rpad({0}, 14, '0'), 'yyyyMMddHHmmss')".format(_name(digits))).cast("timestamp_ntz")


def _name(c: Column) -> str:
    return c._jc.toString()


def nano_timestamp(text: Column) -> Column:
    """RFC 3339 text with up to nine fractional digits, cut to microseconds."""
    return F.regexp_replace(text, r"(\.[0-9]{6})[0-9]+", "$1").try_cast("timestamp")


def local_to_utc(date: Column, time: str = "16:00:00", zone: str = "America/New_York") -> Column:
    """A local date and time as UTC."""
    return F.to_utc_timestamp(F.concat_ws(" ", date.cast("string"), F.lit(time)).cast("timestamp"), zone)


def next_business_day(date: Column, lag: int = 1) -> Column:
    """lag business days later; Saturdays and Sundays are skipped."""
    day = date
    for _ in range(lag):
        w = F.weekday(day)
        day = F.date_add(day, F.when(w == 4, 3).when(w == 5, 2).otherwise(1))
    return day


def calendar(date: Column) -> dict[str, Column]:
    """Weekday (Monday 0), month, quarter, ISO week, day of year, ends of month and quarter, the first days of a year."""
    end = F.last_day(date) == date
    return {"dow": F.weekday(date), "month": F.month(date), "quarter": F.quarter(date), "week": F.weekofyear(date), "doy": F.dayofyear(date), "month_end": end, "quarter_end": end & (F.month(date) % 3 == 0), "year_start": (F.month(date) == 1) & (F.dayofmonth(date) <= 5)}


def interactions(names: Sequence[str]) -> dict[str, Column]:
    """Product, ratio (null for a zero divisor) and difference of all pairs of columns."""
    out = {}
    for a, b in combinations(names, 2):
        out |= {f"{a}_x_{b}": F.col(a) * F.col(b), f"{a}_over_{b}": F.try_divide(F.col(a), F.col(b)), f"{a}_minus_{b}": F.col(a) - F.col(b)}
    return out


def guarded_ratio(a: Column, b: Column, positive: bool = True) -> Column:
    """a / b where b is positive (or, if positive is false, not zero), else null."""
    return F.when(b > 0 if positive else b != 0, a / b)


def fundamental_ratios(price: Column, eps_diluted: Column, eps_basic: Column, equity: Column, shares: Column, debt: Column, income: Column) -> dict[str, Column]:
    """P/E (diluted earnings, else basic; zero falls through), P/B, D/E and return on equity."""
    eps = F.coalesce(F.nullif(eps_diluted, F.lit(0.0)), F.nullif(eps_basic, F.lit(0.0)))
    return {"pe": F.try_divide(price, eps), "pb": F.try_divide(price, F.try_divide(equity, shares)), "debt_to_equity": F.try_divide(debt, equity), "roe": F.try_divide(income, equity)}


def surprise(actual: Column, estimate: Column) -> tuple[Column, Column]:
    """Difference and fraction of the estimate's size."""
    return actual - estimate, F.when(estimate != 0, (actual - estimate) / F.abs(estimate))


def coded(code: Column, names: dict[str, str] = INSIDER_CODES) -> Column:
    """The name of a code, else the code itself."""
    return F.coalesce(F.create_map(*[F.lit(x) for kv in names.items() for x in kv])[code], code)


def tickers(text: Column, known: Sequence[str] | None = None) -> Column:
    """Sorted distinct $TICK or plain upper-case words of two to five letters of the whole text, without stop words."""
    raw = F.regexp_extract_all(text, F.lit(r"(?<![A-Za-z])\$?([A-Z]{2,5})(?![A-Za-z])"), F.lit(1))
    out = F.array_except(raw, F.array(*map(F.lit, STOP_WORDS)))
    return F.array_sort(F.array_intersect(out, F.array(*map(F.lit, known)))) if known is not None else F.array_sort(out)


def book_summary(bids: Column, asks: Column) -> dict[str, Column]:
    """Best prices, spread, mid, depth, imbalance of the top 3 and depth ratio of the top 5 of (price, size) arrays.

    Levels come best first; levels with fewer than two elements are ignored; a missing side gives nulls.
    """
    good = lambda side: F.filter(side, lambda x: F.size(x) >= 2)
    bids, asks = good(bids), good(asks)
    total = lambda side: F.aggregate(side, F.lit(0.0), lambda a, x: a + x[1])
    top = lambda side, n: total(F.slice(side, 1, n))
    bid, ask = F.array_max(F.transform(bids, lambda x: x[0])), F.array_min(F.transform(asks, lambda x: x[0]))
    b3, a3 = top(bids, 3), top(asks, 3)
    return {"best_bid": bid, "best_ask": ask, "spread": ask - bid, "mid": (bid + ask) / 2, "bid_depth": total(bids), "ask_depth": total(asks), "imbalance_3": F.try_divide(b3 - a3, b3 + a3), "depth_ratio_5": F.try_divide(top(bids, 5), top(asks, 5))}


def fixed_cost(shares: Column, price: Column, spread_bps: float = 5.0, per_share: float = 0.005, least: float = 1.0) -> Column:
    """Half the spread and a commission with a minimum."""
    n = F.abs(shares)
    return n * price * spread_bps / 2 / 10_000 + F.when(n > 0, F.greatest(n * per_share, F.lit(least))).otherwise(0.0)


def impact_cost(shares: Column, price: Column, adv: Column, sigma: Column, eta: float = 0.1) -> Column:
    """Square-root market impact: price times sigma eta sqrt(shares / ADV), for all shares."""
    n = F.abs(shares)
    return n * price * sigma * eta * F.sqrt(F.try_divide(n, adv))


def sliced_impact_cost(shares: Column, price: Column, adv: Column, sigma: Column, slices: int = 5, eta: float = 0.1) -> Column:
    """Impact of equal slices that each move the price for the next: the sum over i of q/n |p (1 + f)^i - p|."""
    q = F.abs(shares)
    f = F.signum(shares) * sigma * eta * F.sqrt(F.try_divide(q / slices, adv))
    return F.aggregate(F.sequence(F.lit(1), F.lit(slices)), F.lit(0.0), lambda a, i: a + q / slices * F.abs(price * F.pow(1 + f, i.cast("double")) - price))


def confidence(score: Column) -> Column:
    return F.when(score >= 80, "HIGH").when(score >= 70, "MEDIUM").otherwise("LOW")


def quality_score(hours: Column, days: Column, outlier: Column, has_micro: Column) -> Column:
    """100 less penalties for age of price and of macro data, an outlier, and no microstructure; at least 0."""
    p = F.when(hours > 1, F.least(F.lit(30.0), 5 * (hours - 1))).otherwise(0.0) + F.when(days > 1, F.least(F.lit(20.0), 2 * (days - 1))).otherwise(0.0)
    return F.greatest(100.0 - p - F.when(outlier, 20.0).otherwise(0.0) - F.when(has_micro, 0.0).otherwise(10.0), F.lit(0.0))


#: Multipliers of multiplicative congruential generators, primes below 2**31, and bit patterns.
MULTIPLIERS, PRIMES, BITS = (48271, 69621, 16807, 39373), (2147483647, 1999999973, 1610612741), (0x2C9277B5, 0x5A827999, 0x6ED9EBA1)


def mixed(*parts: Column) -> Column:
    """A pseudo-random number from 0 up to PRIMES[2] of up to four whole numbers that are not negative: products modulo one
    prime after another with bits flipped between, by arithmetic that any SQL engine has. Each part is used once, so that
    calls can be nested."""
    v = sum((p.cast("long") % PRIMES[0] * m for p, m in zip(parts, MULTIPLIERS, strict=False)), F.lit(1).cast("long"))
    for prime, m, bits in zip(PRIMES, MULTIPLIERS[::-1], BITS, strict=False):
        v = (v % prime).bitwiseXOR(F.lit(bits).cast("long")) * m
    return v % PRIMES[2]
