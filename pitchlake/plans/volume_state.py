"""The volume monitor as kept state: appending runs reads those and their neighbours, not the history.

Each append writes its runs with their baselines, and the last ``fv.BASELINE_RUNS`` runs of the order as a halo for the next one. A run
that arrives late changes the baselines of the runs behind it, up to that many; these are written anew with it,
and the earlier results are listed as void. What is read for late runs is their span and the neighbours on both sides.
"""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pitchlake import fixed_values as fv
from pitchlake.operators.keyed import settled
from pitchlake.operators.ordered import rolling
from pitchlake.plans import observability
from pitchlake.session import cut_lineage
from pitchlake.sources import claims

RUN = "match_id long, stage_run_id string, completed_at timestamp, rows_out long, at long"
RESULT = f"{RUN}, baseline_rows double, baseline_sample long"
ORDER = ["at", "stage_run_id"]
#: Stands for a missing time, which comes before all others.
_NEVER = -(2**62)


def _behind(place: tuple[int, str], or_at: bool = False) -> Column:
    """Whether a run comes behind ``place`` in the order."""
    at, run = place
    beyond = F.col("stage_run_id") >= run if or_at else F.col("stage_run_id") > run
    # the first condition reaches the Parquet reader
    return (F.col("at") >= at) & ((F.col("at") > at) | beyond)


class VolumeMonitor:
    """``observability.silver_volume_monitor`` over all appended runs. Appends take turns; one that is overtaken is refused."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _log(self) -> list[dict[str, Any]]:
        names = sorted(n for n in claims.names(self.spark, f"{self.path}/log") if n.endswith(".json") and not n.startswith("."))
        return [json.loads(claims.text(self.spark, f"{self.path}/log/{n}")) for n in names]

    def _table(self, name: str, schema: str, log: list[dict[str, Any]]) -> DataFrame:
        if not log:
            return self.spark.createDataFrame([], f"{schema}, part string")
        paths = [f"{self.path}/{name}/part={e['part']}" for e in log]
        return self.spark.read.option("basePath", f"{self.path}/{name}").schema(f"{schema}, part string").parquet(*paths)

    def _results(self, log: list[dict[str, Any]]) -> DataFrame:
        """Current results: of a run that was written again, the last."""
        numbers = F.broadcast(self.spark.createDataFrame([(e["part"], n) for n, e in enumerate(log)], "part string, seq int"))
        rows = self._table("runs", RESULT, log)
        if not any(e["void"] for e in log):
            return rows.drop("part")
        void = self._table("void", "stage_run_id string", [e for e in log if e["void"]]).join(numbers, "part")
        void = settled(void.groupBy("stage_run_id").agg(F.max("seq").alias("void_before")))
        current = rows.join(numbers, "part").join(void, "stage_run_id", "left")
        return current.where("void_before IS NULL OR seq >= void_before").select(*[f.split()[0] for f in RESULT.split(", ")])

    def append(self, stage_runs: DataFrame, key: str) -> dict[str, int]:
        """Add stage runs, of which successful Silver runs with a row count matter; run ids are new ones.

        Returns how many runs were added, read besides them, and written again. A key that is known adds nothing.
        """
        log = self._log()
        if any(e["key"] == key for e in log):
            return {"added": 0, "read": 0, "again": 0}
        at = F.coalesce(F.unix_micros(F.col("completed_at").cast("timestamp")), F.lit(_NEVER))
        batch = observability.volumes(stage_runs, "SILVER").select(
            F.col("match_id").cast("long").alias("match_id"), F.col("stage_run_id").cast("string").alias("stage_run_id"),
            F.col("completed_at").cast("timestamp").alias("completed_at"), F.col("rows_out").cast("long").alias("rows_out"), at.alias("at"))
        batch = cut_lineage(batch)
        halo = self._table("halo", RUN, log[-1:]).drop("part")
        history, again = halo, None
        last = tuple(log[-1]["last"]) if log and log[-1]["last"] else None
        late = batch.where(~_behind(last)) if last else batch.limit(0)
        first, until = (late.orderBy(*[F.col(c).asc() if up else F.col(c).desc() for c in ORDER]).first() for up in (True, False))
        if first is not None:
            known = self._results(log)
            here, there = ((r["at"], r["stage_run_id"]) for r in (first, until))
            before = known.where(~_behind(here, or_at=True)).orderBy(*[F.col(c).desc() for c in ORDER]).limit(fv.BASELINE_RUNS)
            within = known.where(_behind(here) & ~_behind(there))
            after = known.where(_behind(there)).orderBy(*ORDER).limit(fv.BASELINE_RUNS)
            again = cut_lineage(within.unionByName(after))
            columns = halo.columns
            near = before.select(*columns).unionByName(again.select(*columns))
            history = near.unionByName(halo.join(settled(near.select("stage_run_id")), "stage_run_id", "left_anti").select(*columns))
        history = cut_lineage(history.withColumn("own", F.lit(0)))
        own = batch.withColumn("own", F.lit(1))
        measured = rolling(history.unionByName(own), ORDER, fv.BASELINE_RUNS, observability.BASELINE)
        wanted = F.col("own") == 1
        if again is not None:
            again = again.select("stage_run_id")
            marked = measured.join(settled(again).withColumn("again", F.lit(True)), "stage_run_id", "left")
            measured, wanted = marked, wanted | F.col("again").isNotNull()
        part = uuid.uuid4().hex
        measured.where(wanted).select(*[f.split()[0] for f in RESULT.split(", ")]).write.parquet(f"{self.path}/runs/part={part}")
        (again if again is not None else batch.select("stage_run_id").limit(0)).write.parquet(f"{self.path}/void/part={part}")
        newest = history.unionByName(own).select(*halo.columns).orderBy(*[F.col(c).desc() for c in ORDER]).limit(fv.BASELINE_RUNS)
        newest.coalesce(1).write.parquet(f"{self.path}/halo/part={part}")
        end = self.spark.read.parquet(f"{self.path}/halo/part={part}").orderBy(*[F.col(c).desc() for c in ORDER]).first()
        counts = {"added": batch.count(), "read": history.count(), "again": 0 if again is None else again.count()}
        record = {"key": key, "part": part, "void": counts["again"], "last": [end["at"], end["stage_run_id"]] if end else None}
        if not claims.claim(self.spark, f"{self.path}/log", f"{len(log):020d}.json", json.dumps(record)):
            raise RuntimeError("another append has finished meanwhile; append again")
        return counts

    def read(self) -> DataFrame:
        """Each Silver run against the median of the ten runs before it."""
        return observability.volume_status(self._results(self._log()).select(
            "match_id", "completed_at", "rows_out", "baseline_rows", "baseline_sample"))
