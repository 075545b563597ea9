"""All layers of the warehouse in one folder, and the job that feeds them."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from pitchlake import fixed_values as fv, schemas
from pitchlake.operators import checks
from pitchlake.operators.keyed import only, settled, without
from pitchlake.operators.ordered import latest
from pitchlake.plans import bronze, marts, observability, partials, quality, silver
from pitchlake.plans.commits import CommitStore
from pitchlake.plans.incremental import lineage_edges, new_matches, register_artifacts
from pitchlake.session import cut_lineage
from pitchlake.sources import logs, raw, tables
from pitchlake.sources.matches import to_dim_match


class Warehouse:
    """Manifest, Bronze, violations and logs by run; Silver, Gold and the match dimension as commit stores.

    ``ingest`` handles many artifacts in one job. Each of its steps finds or overwrites
    what an interrupted run with the same key has left, so it can be repeated at
    any point; a finished key changes nothing. Folders are per run, never per match.
    """

    def __init__(
        self, spark: SparkSession, root: str, grid: list[list[float]] = fv.XT_GRID,
        provider: str = "open_data", model_version: str = fv.XT_MODEL_VERSION,
    ):
        self.spark, self.root = spark, root.rstrip("/")
        self.grid, self.provider, self.model_version = grid, provider, model_version
        self.silver = CommitStore(spark, self.path("silver"))
        self.gold_parts = CommitStore(spark, self.path("gold_parts"))
        self.gold_team = CommitStore(spark, self.path("gold_team"))
        self.gold_intervals = CommitStore(spark, self.path("gold_intervals"))
        self.dim_match = CommitStore(spark, self.path("dim_match"))

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _keyed(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(self.path(name))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def manifest(self) -> DataFrame:
        fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.MANIFEST.fields)
        return self._keyed("manifest", f"{fields}, run_key string")

    def violations(self) -> DataFrame:
        return self._keyed("violations", "match_id long, rule string, n long, run_key string")

    def _write(self, df: DataFrame, name: str, key: str) -> tuple[DataFrame, int]:
        """Write the part of ``key``; returns what was written, and its row count."""
        rows = tables.write_part(df, self.path(name), key)
        return tables.read_part(self.spark, self.path(name), key), rows

    def _stage(self, stage: str, key: str, attempt: int):
        fields: dict[str, Any] = {
            "airflow_run_id": key, "dag_id": "warehouse", "task_id": stage.lower(), "try_number": attempt,
        }
        return logs.observe_stage(self.spark, self.path("logs/stage_runs"), stage, **fields)

    def files(self) -> DataFrame:
        """Every landed file that was looked at, also copies and files without a match."""
        return self._keyed("files", "raw_uri string, match_id long, run_key string")

    def register(self, artifacts: DataFrame, key: str) -> tuple[DataFrame, int]:
        """Add new artifacts to the manifest; returns all rows of ``key`` and their number.

        What is registered keeps its version: a repeated key only adds files it has not seen.
        Files without a match are set aside as violations.
        """
        # The only step that has to hash all contents: done once, and cut off there.
        arrivals = cut_lineage(
            artifacts.select("match_id", "file_hash", "raw_uri", F.col("arrived_at").alias("arrival"))
        )
        stray = arrivals.where("match_id IS NULL").select("raw_uri").distinct().join(
            self.files().select("raw_uri").distinct(), "raw_uri", "left_anti"
        ).agg(F.count("*").alias("n")).where("n > 0")
        stray = stray.select(F.lit(None).cast("long").alias("match_id"), F.lit("no_match_id").alias("rule"), "n")
        if not stray.isEmpty():
            self._write(stray, "violations", f"{key}-files")
        rows = register_artifacts(
            arrivals.where("match_id IS NOT NULL"), self.manifest(), self.provider,
            ingested_at=F.date_format("arrival", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"),
            source_url=F.col("raw_uri"), raw_uri=F.col("raw_uri"),
        )
        fresh = cut_lineage(rows.select(*schemas.MANIFEST.fieldNames()))
        tables.append_part(fresh, self.path("manifest"), key)
        tables.append_part(arrivals.select("raw_uri", "match_id"), self.path("files"), key)
        own = tables.read_part(self.spark, self.path("manifest"), key)
        return own, own.count()

    def ingest_folder(self, landing: str, key: str, attempt: int = 1, files_per_run: int = raw.FILES_PER_RUN) -> int | None:
        """``ingest`` of the files below ``landing`` that no run has looked at, or that ``key`` left unfinished.

        A large backlog is taken in by several runs of at most ``files_per_run`` files, whose keys are ``key``, ``key-2``, ``key-3`` and
        so on. Returns the last Silver commit, or None if nothing was new.
        """
        seq, turn = None, 0
        while True:
            turn += 1
            own = key if turn == 1 else f"{key}-{turn}"
            files = self.files()
            artifacts = raw.read_new_artifacts(
                self.spark, landing, files.where(F.col("run_key") != own), files.where(F.col("run_key") == own), files_per_run)
            if artifacts is None:
                return seq
            done = self.ingest(artifacts, own, attempt)
            seq = seq if done is None else done

    def ingest(self, artifacts: DataFrame, key: str, attempt: int = 1) -> int | None:
        """Take artifacts (as read by ``raw.read_artifacts``) through all layers.

        Returns the Silver commit, or None if nothing was new. A key that is published in
        every layer does nothing; one that was interrupted goes on where it stopped.
        """
        if all(store.published(key) for store in (self.silver, self.gold_team, self.gold_intervals)):
            return self.silver.published(key)
        try:
            seq = self._ingest(artifacts, key, attempt)
        finally:
            self._record_run(key)
        return seq

    def _ingest(self, artifacts: DataFrame, key: str, attempt: int) -> int | None:
        seq = self.silver.published(key)
        if seq is None:
            seq = self._to_silver(artifacts, key, attempt)
            if seq is None:
                return None
        # Taken before Silver is looked at: facts of a newer version, published from here on, are a conflict and not overwritten.
        seen = self._gold_states()
        listed = self.silver.listing(seq)
        newer = self.silver.match_commits().where(F.col("published") & (F.col("commit_seq") > seq))
        accepted = without(listed.where("published"), newer, ["match_id"])
        rows = without(self.silver.written(seq), without(listed, accepted, ["match_id"]), ["match_id"], settle=True)
        self._publish_gold(rows, accepted, key, attempt, seen)
        registered = tables.read_part(self.spark, self.path("manifest"), key)
        edges = lineage_edges("ingest", registered.select(F.col("raw_uri").alias("dataset")), self.silver.path, key)
        self._write(edges, "lineage", key)
        return seq

    def _to_silver(self, artifacts: DataFrame, key: str, attempt: int) -> int | None:
        with self._stage("INGEST", key, attempt) as seen:
            registered, files = self.register(artifacts, key)
            seen["rows_out"] = files
        if not files:
            return None
        fresh = bronze.with_lineage(
            artifacts.drop("match_id", "file_hash"), registered, ("raw_uri",), manifest_rows=files
        )
        repeats = Observation()
        with self._stage("BRONZE", key, attempt) as seen:
            seen["rows_in"] = files
            stored, seen["rows_out"] = self._write(bronze.to_bronze(bronze.repeated_ids(fresh, repeats)), "bronze", key)

        # Several versions of a match may arrive together: Silver takes the last.
        version = ["match_id", "source_version"]
        newest = latest(registered, ["match_id"], F.col("source_version").desc())
        events = without(stored, without(registered, newest, version), version, settle=True)
        with self._stage("SILVER", key, attempt) as seen:
            def check(written: DataFrame) -> DataFrame:
                # Event ids are shuffled only for matches that differ or may hold one twice. If no file does, and both
                # sides hold the same ids equally often, then Silver has no duplicate either.
                suspects = bronze.matches_with_repeats(newest, repeats)
                _, ids = quality.compared_matches(events, written, suspects)
                by_id = [] if ids is None else [
                    quality.duplicated_ids(ids), quality.reconciliation_violations(quality.reconciled_ids(ids))]
                found = checks.all_of(
                    quality.silver_row_violations(written), *by_id, quality.empty_batches(newest, written),
                    # Only files that gave no event are read again, which is none as a rule.
                    raw.unreadable(only(fresh, without(registered, stored, version), version, settle=True)),
                )
                return self._write(found, "violations", key)[0]

            seq = self.silver.commit(
                quality.require_contract(silver.to_silver(events, self.grid, self.model_version)), key, check=check
            )
            accepted = self.silver.listing(seq).where("published")
            seen["rows_out"] = accepted.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
        return seq

    def _gold_states(self) -> tuple[int, int, int]:
        return self.gold_parts.last(), self.gold_team.last(), self.gold_intervals.last()

    def _publish_gold(self, rows: DataFrame, matches: DataFrame, key: str, attempt: int, seen: tuple[int, int, int]) -> int:
        """Both facts of the given matches from their Silver ``rows``, which are scanned once and kept as sums.

        Returns the commit of the team fact.
        """
        own = self.gold_parts.commit(partials.partial_facts(rows), key, matches=matches, based_on=seen[0])
        parts = self.gold_parts.written(own)
        seq = self._publish("GOLD_TEAM", self.gold_team, partials.team_facts(parts), matches, key, attempt,
                            lambda facts: quality.team_fact_violations(facts, rows), seen[1])
        self._publish("GOLD_INTERVAL", self.gold_intervals, partials.interval_facts(parts), matches, key, attempt,
                      quality.interval_fact_violations, seen[2])
        return seq

    def merged_facts(self, as_of: int | None = None, matches: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
        """Both facts put together from the kept sums, also of an earlier state; checks of the facts are not applied."""
        parts = self.gold_parts.read(as_of, matches)
        return partials.team_facts(parts), partials.interval_facts(parts)

    def _publish(
        self, stage: str, store: CommitStore, facts: DataFrame, matches: DataFrame, key: str, attempt: int,
        rules: Callable[[DataFrame], DataFrame], based_on: int,
    ) -> int:
        """Commit facts; matches that break a rule of their layer are listed and stay hidden."""
        def check(written: DataFrame) -> DataFrame:
            return self._write(rules(written), "violations", f"{key}-{stage.lower()}")[0]

        with self._stage(stage, key, attempt) as seen:
            seq = store.commit(facts, key, check=check, matches=matches, based_on=based_on)
            counted = store.listing(seq).where("published")
            seen["rows_out"] = counted.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
        return seq

    def rebuild(self, matches: DataFrame, key: str) -> int:
        """Compute both Gold facts of the given matches anew from Silver; returns the commit of the team fact."""
        listed, seen = settled(matches.select("match_id")), self._gold_states()
        return self._publish_gold(self.silver.read(matches=listed), listed, key, 1, seen)

    def maintain(self, keep_days: float = 7, **options: Any) -> None:
        """Fold the commits of all five datasets, and remove what only states before the last ``keep_days`` need.

        ``options`` go to ``CommitStore.compact``. Ingests may run meanwhile.
        """
        for store in (self.silver, self.gold_parts, self.gold_team, self.gold_intervals, self.dim_match):
            if not store.last():
                continue
            store.compact(**options)
            old = store.commits().where(F.col("committed_at") < F.current_timestamp() - F.make_dt_interval(secs=F.lit(keep_days * 86_400.0)))
            store.expire(old.agg(F.max("commit_seq").alias("seq")).first()["seq"] or 0)

    def stage_records(self) -> DataFrame:
        """Stage attempts of all runs, as the run views read them."""
        return self.stage_runs().select(F.col("airflow_run_id").alias("run_id"), *[
            c for c in schemas.STAGE_RUN.fieldNames() if c not in ("airflow_run_id", "stage_run_id", "dag_id", "task_id")])

    def _record_run(self, key: str) -> None:
        """Log the outcome of a run so far, and its failed stages as task events."""
        own = self.stage_records().where(F.col("run_id") == key)
        logs.append_log(observability.run_outcomes(own), self.path("logs/pipeline_runs"), schemas.PIPELINE_RUN)
        failed = own.where((F.col("status") == fv.FAILED)).select(
            F.lit(fv.TASK_FAILED).alias("event_type"), F.col("completed_at").alias("occurred_at"), F.lit("warehouse").alias("dag_id"),
            F.lower("stage").alias("task_id"), F.col("run_id").alias("airflow_run_id"), "match_id", "try_number",
            F.col("error_type").alias("exception_type"), "error_message")
        known = self.task_events().select("airflow_run_id", "task_id", "occurred_at")
        logs.append_log(cut_lineage(failed.join(known, ["airflow_run_id", "task_id", "occurred_at"], "left_anti")),
                        self.path("logs/task_events"), schemas.TASK_EVENT)

    def pipeline_runs(self) -> DataFrame:
        """The last outcome of every run."""
        runs = logs.read_log(self.spark, self.path("logs/pipeline_runs"), schemas.PIPELINE_RUN)
        return latest(runs, ["run_id"], F.col("completed_at").desc_nulls_last())

    def run_stages(self) -> DataFrame:
        """All stages of every run; those that were not reached are NOT_RUN."""
        return observability.run_stage_matrix(self.stage_records())

    def task_events(self) -> DataFrame:
        return logs.read_log(self.spark, self.path("logs/task_events"), schemas.TASK_EVENT)

    def load_matches(self, matches: DataFrame, key: str) -> int:
        """Insert or update matches of the dimension from a nested match list."""
        return self.dim_match.commit(quality.require_dim_match(to_dim_match(matches)), key)

    def new_matches(self) -> DataFrame:
        """Known matches of which no artifact has been taken in."""
        return new_matches(self.dim_match.read(), logs.ingested_match_ids(self.manifest()))

    def reference_problems(self) -> DataFrame:
        """Matches with facts but no dimension row, or the other way round."""
        return quality.fact_dim_references(self.gold_team.read(), self.dim_match.read())

    def team_match_enriched(self) -> DataFrame:
        return marts.team_match_enriched(self.gold_team.read(), self.dim_match.read())

    def stage_runs(self) -> DataFrame:
        return logs.read_log(self.spark, self.path("logs/stage_runs"), schemas.STAGE_RUN)
