"""Lineage records, run logs and evaluation sinks: append-only parquet tables partitioned by day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from . import checks, ranks

RUN = "run_id string, job string, status string, at timestamp, details string"


def record(inputs: dict[str, DataFrame], output: DataFrame, name: str, at: str) -> DataFrame:
    """One row for each input of a transform: table, row counts and content hashes of both sides."""
    out = checks.content_hash(output).select(F.col("rows").alias("output_rows"), F.col("content_hash").cast("string").alias("output_hash"))
    rows = [checks.content_hash(df).select(F.lit(t).alias("input_table"), F.col("rows").alias("input_rows"), F.col("content_hash").cast("string").alias("input_hash")) for t, df in inputs.items()]
    return checks.suite(rows).crossJoin(F.broadcast(out)).withColumns({"output_table": F.lit(name), "at": F.lit(at).cast("timestamp")})


def upstream(records: DataFrame, table: str) -> DataFrame:
    """Distinct tables that a table was made from."""
    return records.where(F.col("output_table") == table).select(F.col("input_table").alias("table_name")).distinct()


def downstream(records: DataFrame, table: str) -> DataFrame:
    return records.where(F.col("input_table") == table).select(F.col("output_table").alias("table_name")).distinct()


def log_run(spark: SparkSession, path: str, run_id: str, job: str, status: str, at: str, details: str = "") -> None:
    """Appends a start or end row; latest_runs reads the last of each run."""
    row = spark.createDataFrame([(run_id, job, status, details)], "run_id string, job string, status string, details string").withColumn("at", F.lit(at).cast("timestamp"))
    row.withColumn("day", F.to_date("at")).write.mode("append").partitionBy("day").parquet(path)


def latest_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).groupBy("run_id", "job").agg(F.max_by("status", F.struct("at", "status")).alias("status"), F.min("at").alias("started"), F.max("at").alias("ended"))


def append_metrics(metrics: DataFrame, path: str, run_id: str, keys: Sequence[str]) -> None:
    """Wide metrics as long rows (run_id, keys, name, value), appended."""
    names = [c for c, t in metrics.dtypes if c not in keys and t in ("double", "bigint", "int")]
    long = metrics.select(*keys, *[F.col(n).cast("double").alias(n) for n in names]).unpivot(list(keys), names, "name", "value")
    long.withColumn("run_id", F.lit(run_id)).write.mode("append").partitionBy("run_id").parquet(path)


def append_journal(events: DataFrame, path: str, at: str = "ts") -> None:
    """Events appended to daily folders."""
    events.withColumn("event_date", F.to_date(at)).write.mode("append").partitionBy("event_date").parquet(path)


def journal(spark: SparkSession, path: str, first: str, last: str) -> DataFrame:
    """Events of a range of days; only those folders are read."""
    return spark.read.parquet(path).where(F.col("event_date").between(first, last))


def register_trials(trials: DataFrame, path: str, run_id: str) -> None:
    """Appends a run's trials (name, p, ...) to a registry. A run that is there already adds nothing, whatever it brings: its
    folder is the mark, written once and whole. seq numbers runs in the order of their registration."""
    spark = trials.sparkSession
    runs = [r.run for r in registered_trials(spark, path).select("run").distinct().collect()] if _there(spark, path) else []  # one short row a run
    if run_id not in runs:
        trials.withColumns({"run": F.lit(run_id), "seq": F.lit(len(runs))}).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(path)


def registered_trials(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", "false").parquet(path).withColumn("run", F.col("run").cast("string"))


def _there(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return False
    return True


def trial_verdicts(trials: DataFrame, alpha: float = 0.05, p: str = "p") -> DataFrame:
    """trials (run, seq, name, p, ...) with rejected_then and rejected_now: Benjamini-Hochberg over all trials of the runs up
    to the trial's own, and over all so far. So a verdict of an earlier run changes by the rule alone, and rejected_then never.
    A null or NaN p counts as 1.

    Only the cut matters: of m sorted p values, the largest k with p_(k) <= k alpha / m. For each run the ranks of the p values
    up to it come from one table of trials by run and later run; runs are few (a number each), trials may be many.
    """
    rows = trials.withColumn("__p", F.when(F.col(p).isNull() | F.isnan(p), 1.0).otherwise(F.col(p)))
    runs = rows.agg(F.max("seq").alias("__top"))
    spread = rows.select("__p", "seq").crossJoin(F.broadcast(runs)).select("__p", F.explode(F.sequence("seq", "__top")).alias("__upto"))
    counts = spread.groupBy("__upto", "__p").agg(F.count("*").alias("t"))
    total = counts.groupBy("__upto").agg(F.sum("t").alias("__m"))
    ranked = ranks.prefix(counts, ["__upto"], "__p", ["t"]).join(total, "__upto")
    k = F.col("before_t") + F.col("t")
    cut = ranked.where(F.col("__p") <= k * alpha / F.col("__m")).groupBy("__upto").agg(F.max("__p").alias("__cut"))
    now = cut.crossJoin(F.broadcast(runs)).where("__upto = __top").select(F.col("__cut").alias("__now"))
    then = cut.select(F.col("__upto").alias("seq"), F.col("__cut").alias("__then"))
    j = rows.join(then, "seq", "left").crossJoin(F.broadcast(now.agg(F.max("__now").alias("__now"))))
    return j.select(*trials.columns, F.coalesce(F.col("__p") <= F.col("__then"), F.lit(False)).alias("rejected_then"), F.coalesce(F.col("__p") <= F.col("__now"), F.lit(False)).alias("rejected_now"))


def trial_summary(verdicts: DataFrame, score: str = "ic", passed: str = "passed") -> DataFrame:
    """n_trials, n_passed (a boolean column), n_rejected, best score among all trials so far."""
    return verdicts.agg(F.count("*").alias("n_trials"), F.count_if(passed).alias("n_passed"), F.count_if("rejected_now").alias("n_rejected"), F.max(F.when(~F.isnan(score), F.col(score))).alias("best"))
