"""A table of keyed rows under a stream: small files a batch, merge on read, compaction in tiers, recycled folders.

Each micro-batch is written as a run of its own rows. When `fan` runs of a tier have come together they are merged into one of
the next tier, and when all of them hold more than a share of the base's rows, everything is merged into a new base; so each
row is rewritten a bounded number of times (about log_fan of the batches between two bases, and 1 + 1 / share for the base),
however large the table is. A manifest names the runs of each batch and is the commit: what a batch wrote before it failed is
not in any manifest, and a batch that is already in one is not written again. Runs that no kept manifest names are dead; their
folders are written over by later runs, so no file is ever deleted but by Spark's own overwriting.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

MANIFEST = "batch long, tier int, first long, last long, rows long, folder int"


@dataclass(frozen=True)
class Run:
    """Rows of the batches first to last, merged by key. tier -1 is the base; folder is the number of the run's folder."""

    tier: int
    first: int
    last: int
    rows: int
    folder: int


class DeltaTable:
    """path: a folder of this table alone; key: its key columns (null keys are keys as any other). version: columns that
    order rows of one key within a batch, the last wins (ties: by all other columns, so that a batch run again gives the same);
    a later batch wins over an earlier one. retain: manifests kept for readers of earlier batches.

    write is a foreachBatch function; batches come with ascending numbers, as streams give them. One writer at a time.
    """

    def __init__(self, path: str, key: Sequence[str], version: Sequence[str] = (), fan: int = 8, share: float = 0.5, retain: int = 3):
        self.path, self.key, self.version, self.fan, self.share, self.retain = path.rstrip("/"), list(key), list(version), fan, share, retain

    def _manifests(self, spark: SparkSession) -> dict[int, list[Run]]:
        try:
            rows = spark.read.schema(MANIFEST + ", slot int").parquet(f"{self.path}/manifest").collect()  # a few rows for each kept batch
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}
        found: dict[int, list[Run]] = {}
        for r in rows:
            runs = found.setdefault(r.batch, [])
            if r.folder is not None:
                runs.append(Run(r.tier, r.first, r.last, r.rows, r.folder))
        return found

    def state(self, spark: SparkSession, upto: int | None = None) -> tuple[int, list[Run]]:
        """The last committed batch (-1 if none), or the last up to a number, and its runs. An error if that batch is no
        longer kept."""
        kept = self._manifests(spark)
        batches = [b for b in kept if upto is None or b <= upto]
        if not batches:
            if kept:
                raise ValueError(f"batches up to {upto} are no longer kept; the first kept one is {min(kept)}")
            return -1, []
        return max(batches), kept[max(batches)]

    def _folder(self, run: Run) -> str:
        return f"{self.path}/runs/{run.folder}"

    def _merged(self, spark: SparkSession, runs: Sequence[Run]) -> DataFrame:
        """One row a key of the runs: that of the latest run. One shuffle by key, combined in each task."""
        parts = [spark.read.parquet(self._folder(r)).withColumn("__last", F.lit(r.last)) for r in runs]
        if len(parts) == 1:
            return parts[0].drop("__last")
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        rest = [c for c in rows.columns if c not in self.key]
        return rows.groupBy(*self.key).agg(F.max_by(F.struct(*rest), "__last").alias("__r")).select(*self.key, "__r.*").drop("__last")

    def _add(self, df: DataFrame, tier: int, first: int, last: int, taken: set[int]) -> Run:
        spark = df.sparkSession
        free = next(i for i in range(len(taken) + 1) if i not in taken)
        taken.add(free)
        run = Run(tier, first, last, 0, free)
        df.write.mode("overwrite").parquet(self._folder(run))
        return Run(tier, first, last, spark.read.parquet(self._folder(run)).count(), free)

    def write(self, batch: DataFrame, number: int) -> None:
        """Upserts a batch and commits it under its number; a batch that is committed already is passed over."""
        spark = batch.sparkSession
        kept = self._manifests(spark)
        done = max(kept, default=-1)
        if number <= done:
            batch.write.format("noop").mode("overwrite").save()  # a stateful query has to go through the batch to commit its state
            return
        live = list(kept.get(done, []))
        recent = sorted(kept)[-self.retain :]
        taken = {r.folder for b in recent for r in kept[b]}
        rest = [c for c in batch.columns if c not in self.key]
        order = F.struct(*[F.col(c) for c in self.version], *[F.col(c) for c in rest if c not in self.version])
        one = batch.groupBy(*self.key).agg(F.max(F.struct(order.alias("o"))).alias("__r")).select(*self.key, *[F.col(f"__r.o.{c}").alias(c) for c in rest]) if rest else batch.distinct()
        live.append(self._add(one, 0, number, number, taken))
        tier = 0
        while len(same := [r for r in live if r.tier == tier]) >= self.fan:
            made = self._add(self._merged(spark, same), tier + 1, same[0].first, same[-1].last, taken)
            live = [r for r in live if r.tier != tier] + [made]
            tier += 1
        base = sum(r.rows for r in live if r.tier < 0)
        if sum(r.rows for r in live if r.tier >= 0) > self.share * base:
            runs = sorted(live, key=lambda r: r.last)
            live = [self._add(self._merged(spark, runs), -1, runs[0].first, number, taken)]
        self._commit(spark, number, live)

    def _commit(self, spark: SparkSession, number: int, live: Sequence[Run]) -> None:
        # one slot more than is kept: the slot that is written over holds the one manifest that has just become too old
        kept = self._manifests(spark)
        slots = {}
        for r in spark.read.schema(MANIFEST + ", slot int").parquet(f"{self.path}/manifest").select("batch", "slot").distinct().collect() if kept else []:
            slots[r.slot] = max(r.batch, slots.get(r.slot, -1))
        slot = next((s for s in range(self.retain) if s not in slots), min(slots, key=slots.get) if slots else 0)
        rows = [(number, r.tier, r.first, r.last, r.rows, r.folder) for r in live]
        spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/slot={slot}")

    def read(self, spark: SparkSession, upto: int | None = None) -> DataFrame:
        """The rows after the last committed batch, or after the last up to a number, while its manifest is kept."""
        batch, runs = self.state(spark, upto)
        if batch < 0:
            raise ValueError(f"nothing was committed at {self.path}")
        return self._merged(spark, sorted(runs, key=lambda r: r.last))
