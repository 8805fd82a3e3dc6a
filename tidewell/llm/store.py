"""Shared scratch space and bounded samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import scratch, shared_dir, table  # noqa: F401  used by the operators


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Makes the session send texts to Python in batches of so many rows, unless its batch size was set: at Spark's default
    of 10,000 rows a batch of whole texts takes tens of MB, several times over, in the JVM and in each worker."""
    if spark.conf.get(BATCH) == "10000":
        spark.conf.set(BATCH, str(rows))


def pinned(df: DataFrame) -> DataFrame:
    """The rows written to the shared checkpoint folder, so that a lost executor costs no recomputation."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


#: Largest number of rows (a few numbers each) that is sent to every task; more are joined by a shuffle.
SENT_ROWS = 2_000_000


def sent(df: DataFrame, rows: int = SENT_ROWS) -> DataFrame:
    """df, marked for broadcast if it has at most so many rows. df should be cheap to count (pinned) and narrow."""
    return F.broadcast(df) if df.count() <= rows else df  # a limit would bring the rows together in one task


def share(key: Column, part: Column | float) -> Column:
    """True for about this share of the keys; the same rows on every run."""
    return F.pmod(F.xxhash64(key), F.lit(1_000_003)) < F.lit(part) * F.lit(1_000_003)
