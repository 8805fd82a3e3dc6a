"""Helpers of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import BITS, MULTIPLIERS, PRIMES


#: Added before rounding: far below the last digit, it keeps exact halves from falling differently in two engines.
NUDGE = 3.3e-9


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, without a negative zero, so that results compare across engines: whole units of the last digit are
    counted, as in SQL, which tells for doubles that have no more digits than are kept."""
    unit = 10.0**digits
    return df.select(*[(F.round((F.col(c) + F.lit(NUDGE)) * unit) / unit + F.lit(0.0)).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes])


def r(expr: str, name: str, digits: int = 6) -> str:
    """The same in SQL."""
    return f"round(({expr}) + {NUDGE}, {digits}) + 0.0 AS {name}"


def cdf_sql(z: str) -> str:
    """The normal distribution function of operators.evaluate.erf_cdf in SQL."""
    x = f"(abs({z}) / sqrt(2))"
    t = f"(1 / (1 + 0.3275911 * {x}))"
    half = f"(0.5 * {t} * (0.254829592 + {t} * (-0.284496736 + {t} * (1.421413741 + {t} * (-1.453152027 + {t} * 1.061405429)))) * exp(-{x} * {x}))"
    return f"(CASE WHEN ({z}) >= 0 THEN 1 - {half} ELSE {half} END)"


def mixed_sql(*parts: str) -> str:
    """functions.scalars.mixed in SQL."""
    v = "1 + " + " + ".join(f"CAST({p} AS BIGINT) % {PRIMES[0]} * {m}" for p, m in zip(parts, MULTIPLIERS, strict=False))
    for prime, m, bits in zip(PRIMES, MULTIPLIERS[::-1], BITS, strict=False):
        v = f"xor(({v}) % {prime}, CAST({bits} AS BIGINT)) * {m}"
    return f"(({v}) % {PRIMES[2]})"
