"""Serving: a copy of Silver that is replaced by match in one step, and SQL with bound parameters over the serving views."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from pitchlake.plans.commits import CommitConflict, CommitStore


class ServingCopy:
    """A dataset that readers see before or after a replacement, never in between.

    A replacement writes a folder of its own; one small file, made in one step, then points readers to it. A view holds the folders that
    were current when it was registered, and keeps giving the same rows until they expire.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.store = spark, CommitStore(spark, path)

    def replace_matches(self, df: DataFrame, attempts: int = 5) -> int:
        """Replace the matches in ``df`` as a whole; returns their number of rows.

        The last of several writers of one match counts: an overtaken one writes again, on top of what it finds.
        """
        for attempt in range(attempts):
            try:
                seq = self.store.commit(df, uuid.uuid4().hex)
                return self.store.listing(seq).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
            except CommitConflict:
                if attempt + 1 == attempts:
                    raise
        raise ValueError("attempts must be positive")

    def read(self, matches: DataFrame | None = None) -> DataFrame:
        return self.store.read(matches=matches)

    def register(self, view: str) -> None:
        """Point a temporary view to the state there is now."""
        self.read().createOrReplaceTempView(view)

    def tidy(self, grace_seconds: float = 86_400) -> None:
        """Fold what was replaced, and remove folders that no view of the last ``grace_seconds`` should need."""
        folded = self.store.compact()
        recent = self.store.commits().where(F.col("committed_at") < F.current_timestamp() - F.make_dt_interval(secs=F.lit(float(grace_seconds))))
        self.store.expire(min(folded, recent.agg(F.max("commit_seq").alias("seq")).first()["seq"] or 0), grace_seconds)


_SCOPE = "(:team IS NULL OR team_name = :team) AND (:season IS NULL OR season_name = :season)"

#: Statements over the view ``team_match_enriched``; both parameters may be NULL, which means all.
STATEMENTS = {
    "team_season_summary": f"""
        SELECT team_name, season_name, count(*) AS matches, sum(goals) AS goals, sum(shots) AS shots, sum(xg) AS xg,
          sum(progressive_passes) AS progressive_passes
        FROM team_match_enriched WHERE {_SCOPE} GROUP BY team_name, season_name""",
    "match_by_match": f"""
        SELECT team_name, season_name, match_date, opponent, venue, goals, xg FROM team_match_enriched WHERE {_SCOPE}
        ORDER BY team_name NULLS LAST, season_name NULLS LAST, match_date NULLS LAST""",
    "team_home_away_summary": f"""
        SELECT team_name, season_name, venue, count(*) AS matches, sum(goals) AS goals, sum(xg) AS xg,
          avg(goals) AS goals_per_match, avg(xg) AS xg_per_match
        FROM team_match_enriched WHERE {_SCOPE} GROUP BY team_name, season_name, venue
        ORDER BY team_name NULLS LAST, season_name NULLS LAST, venue NULLS LAST""",
}


def ask(spark: SparkSession, statement: str, team: str | None = None, season: str | None = None) -> DataFrame:
    """Run a statement with bound parameters: values are never part of its text, and a given one is pushed down like a literal."""
    return spark.sql(STATEMENTS[statement], args={"team": team, "season": season})
