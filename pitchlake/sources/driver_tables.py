"""Maps the star-schema test tables to match-event data.

1,000 consecutive rows of ``events`` make one match; ``documents`` stand for
delivered artifacts with exact copies; ``orders`` stand for run metadata.
Everything is computed row by row or from keys, so it scales with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pitchlake import fixed_values as fv, schemas
from pitchlake.functions.text import fingerprint

PROVIDER = "driver_tables"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spread(df: DataFrame, key: str) -> DataFrame:
    """Spread a table that is read by fewer tasks than there are cores.

    The small test tables are one row group each, which Spark cannot split.
    Large tables are left as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def _div(column: str, by: int) -> Column:
    return F.expr(f"{column} div {by}")


def raw_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw JSON text with lineage columns.

    Every driver row becomes an artifact with one event, so that no match,
    however large, is gathered into one array.
    """
    events = _spread(table(spark, sf_dir, "events").drop("ts"), "event_id").selectExpr(
        "event_id AS e", "user_id AS u", "value AS v", "event_type AS t",
        "int(get_json_object(props, '$.k')) AS k", "event_id div 1000 AS m", "int(event_id % 1000) AS i",
    ).selectExpr(
        "*",
        "CASE WHEN i < 480 THEN 1 WHEN i < 940 THEN 2 WHEN i < 980 THEN 3 ELSE 5 END AS period",
        """int(CASE WHEN i < 480 THEN i div 10 WHEN i < 940 THEN 45 + (i - 480) div 9
                    WHEN i < 980 THEN 90 + (i - 940) div 4 ELSE 120 END) AS minute""",
        "int(e * 7 % 60) AS second",
        "CASE WHEN i % 97 <> 0 THEN if(u % 2 = 0, 1 + m % 10, 11 + m % 7) END AS team_id",
        "array((e * 71 % 1201) / 10D, (e * 89 % 801) / 10D) AS end_location",
    )
    event = F.expr("""named_struct(
        'id', string(e), 'index', i + 1, 'period', period,
        'timestamp', format_string('00:%02d:%02d.000', minute, second), 'minute', minute, 'second', second,
        'type', CASE t WHEN 'view' THEN named_struct('id', 30L, 'name', 'Pass')
                       WHEN 'click' THEN named_struct('id', 43L, 'name', 'Carry')
                       WHEN 'purchase' THEN named_struct('id', 16L, 'name', 'Shot')
                       WHEN 'signup' THEN named_struct('id', 17L, 'name', 'Pressure')
                       ELSE named_struct('id', 42L, 'name', 'Ball Receipt*') END,
        'possession', int(i div 10),
        'possession_team', if(team_id IS NOT NULL, named_struct('id', team_id, 'name', 'Team ' || team_id), NULL),
        'play_pattern', named_struct('id', e % 9 + 1, 'name', 'Pattern ' || (e % 9 + 1)),
        'team', if(team_id IS NOT NULL, named_struct('id', team_id, 'name', 'Team ' || team_id), NULL),
        'player', named_struct('id', u, 'name', 'Player ' || u),
        'position', named_struct('id', u % 25 + 1, 'name', 'Position ' || (u % 25 + 1)),
        'location', array((e * 37 % 1201) / 10D, (e * 53 % 801) / 10D),
        'duration', v,
        'under_pressure', if(k % 7 = 0, true, NULL), 'out', if(k % 11 = 0, true, NULL),
        'related_events', CASE k % 5 WHEN 0 THEN NULL WHEN 1 THEN array()
                                     ELSE array(string(e - 1), string(e + 1)) END,
        'pass', if(t = 'view', named_struct('end_location', end_location,
            'outcome', if(u % 4 = 0, named_struct('id', 9L, 'name', 'Incomplete'), NULL)), NULL),
        'carry', if(t = 'click', named_struct('end_location', end_location), NULL),
        'shot', if(t = 'purchase', named_struct('end_location', end_location,
            'outcome', named_struct('id', 97L, 'name', if(floor(v) % 9 = 0, 'Goal', 'Saved')),
            'statsbomb_xg', if(e % 31 <> 0, (e * 29 % 1000) / 1000D, NULL)), NULL)
    )""")
    m = F.col("m")
    content = F.concat(F.lit("["), F.to_json(event), F.lit("]"))
    return events.select(*match_lineage(1000 + m), content.alias("content"))


def match_lineage(match_id: Column) -> list[Column]:
    return [
        match_id.alias("match_id"), F.lit(PROVIDER).alias("provider"),
        F.lit(1).alias("source_version"), fingerprint(match_id.cast("string")).alias("file_hash"),
        F.concat(F.lit("ingestion-"), match_id.cast("string")).alias("ingestion_id"),
        F.lit("2024-01-01T00:00:00+00:00").alias("ingested_at"),
    ]


def match_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per match: its number ``m``."""
    return table(spark, sf_dir, "events").select(_div("event_id", 1000).alias("m")).distinct()


def match_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest rows of the matches behind ``raw_artifacts``."""
    return match_numbers(spark, sf_dir).select(*match_lineage(1000 + F.col("m")))


def ingested_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches that an earlier run has ingested: every third one."""
    return match_numbers(spark, sf_dir).where("m % 3 = 0").select((1000 + F.col("m")).alias("match_id"))


def match_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested match objects, passed through JSON text like a landed match list."""
    m = F.col("m")
    home, away = 1 + m % 10, 11 + m % 7
    season = F.when(m % 10 < 5, "2023/2024").otherwise("2024/2025")
    match = F.struct(
        (1000 + m).alias("match_id"),
        F.date_format(F.date_add(F.lit("2023-08-01").cast("date"), (3 * m).cast("int")), "yyyy-MM-dd")
        .alias("match_date"),
        F.format_string("%02d:30:00.000", (12 + m % 9)).alias("kick_off"),
        (m % 38 + 1).cast("int").alias("match_week"),
        F.struct(F.lit(2).alias("competition_id"), F.lit("League").alias("competition_name"))
        .alias("competition"),
        F.struct(
            F.when(m % 10 < 5, 281).otherwise(317).alias("season_id"), season.alias("season_name"),
        ).alias("season"),
        F.struct(
            home.alias("home_team_id"), F.concat(F.lit("Team "), home.cast("string")).alias("home_team_name"),
        ).alias("home_team"),
        F.struct(
            away.alias("away_team_id"), F.concat(F.lit("Team "), away.cast("string")).alias("away_team_name"),
        ).alias("away_team"),
        F.when(m % 4 != 0, F.struct(F.concat(F.lit("Stadium "), home.cast("string")).alias("name")))
        .alias("stadium"),
        F.when(m % 5 != 0, F.struct(F.concat(F.lit("Referee "), (m % 12).cast("string")).alias("name")))
        .alias("referee"),
    )
    text = match_numbers(spark, sf_dir).select(F.to_json(match).alias("text"))
    return text.select(F.from_json("text", schemas.MATCH).alias("match")).select("match.*")


def document_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as delivered artifacts: exact copies share a match."""
    return table(spark, sf_dir, "documents").select(
        (F.col("n_chars") % 50).alias("match_id"), F.col("doc_id").alias("arrival"),
        F.col("lang"), F.col("text").alias("content"),
    )


def _stage() -> Column:
    first = F.substring("o_orderpriority", 1, 1)
    return (
        F.when(first == "1", "INGEST").when(first == "2", "BRONZE").when(first == "3", "SILVER")
        .when(first == "4", "GOLD").otherwise("REPORTS")
    )


def stage_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage attempts, one per order."""
    key = F.col("o_orderkey")
    completed = F.expr("timestampadd(SECOND, o_orderkey, o_orderdate)")
    return table(spark, sf_dir, "orders").select(
        key.cast("string").alias("stage_run_id"),
        F.concat(F.lit("run-"), F.col("o_custkey").cast("string")).alias("airflow_run_id"),
        F.lit("match_pipeline").alias("dag_id"), F.lower(_stage()).alias("task_id"),
        (1 + key % 3).cast("int").alias("try_number"),
        (F.col("o_custkey") % 50).alias("match_id"),
        _stage().alias("stage"),
        F.when((F.col("o_orderstatus") == "F") & (key % 3 == 0), fv.FAILED).otherwise(fv.SUCCEEDED)
        .alias("status"),
        F.when(key % 13 != 0, F.expr("timestampadd(SECOND, -(o_orderkey % 3600), "
                                     "timestampadd(SECOND, o_orderkey, o_orderdate))"))
        .alias("started_at"),
        completed.alias("completed_at"),
        (F.col("o_totalprice") % 600).alias("duration_seconds"),
        F.when(key % 7 != 0, F.floor("o_totalprice") % 4000).alias("rows_in"),
        F.when(key % 11 != 0, F.floor("o_totalprice") % 5000).alias("rows_out"),
    )


def task_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task events, one per order; a third of them are retries."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.when(key % 3 == 1, fv.TASK_RETRY).when(key % 3 == 2, fv.TASK_FAILED).otherwise(fv.DAG_FAILED)
        .alias("event_type"),
        F.expr("timestampadd(SECOND, o_orderkey, o_orderdate)").alias("occurred_at"),
        F.lit("match_pipeline").alias("dag_id"), F.lower(_stage()).alias("task_id"),
        F.concat(F.lit("run-"), F.col("o_custkey").cast("string")).alias("airflow_run_id"),
        (F.col("o_custkey") % 50).alias("match_id"),
    )


def pipeline_stage_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded stages of pipeline runs, one run per order.

    A run of status F stops at the stage given by its priority; later stages
    have no record, but in every third of them the next stage fails as well. Every
    fourth run needed a second attempt for Silver.
    """
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        F.substring("o_orderpriority", 1, 1).cast("int").alias("reached"),
    )
    stages = F.array(*[
        F.struct(F.lit(n + 1).alias("n"), F.lit(name).alias("stage")) for n, name in enumerate(fv.STAGES)
    ])
    rows = orders.select("*", F.explode(stages).alias("s")).select("*", "s.n", "s.stage")
    failed = F.col("o_orderstatus") == "F"
    both = failed & (F.col("o_orderkey") % 3 == 0)
    attempts = F.when((F.col("stage") == "SILVER") & (F.col("o_orderkey") % 4 == 0), F.array(F.lit(-30), F.lit(0)))
    rows = rows.withColumn("early", F.explode(F.coalesce(attempts, F.array(F.lit(0)))))
    stops = failed & ((F.col("n") == F.col("reached")) | (both & (F.col("n") == F.col("reached") + 1)))
    status = F.when(stops | (F.col("early") < 0), fv.FAILED).otherwise(fv.SUCCEEDED)
    error = F.when(F.col("n") == F.col("reached"), "ValueError").otherwise("KeyError")
    started = F.expr("timestampadd(SECOND, 60 * n + early, o_orderdate)")
    return rows.where(~failed | (F.col("n") <= F.col("reached") + both.cast("int"))).select(
        F.concat(F.lit("run-"), F.col("o_orderkey").cast("string")).alias("run_id"),
        (F.col("o_orderkey") % 50).alias("match_id"), "stage", status.alias("status"),
        started.alias("started_at"),
        F.expr("timestampadd(SECOND, if(early < 0, 5, o_orderkey % 50 + n), timestampadd(SECOND, 60 * n + early, o_orderdate))")
        .alias("completed_at"),
        F.when((status == fv.SUCCEEDED) & (F.col("stage") != "REPORTS"),
               F.floor("o_totalprice") % 5000 + F.col("n")).alias("rows_out"),
        F.when(status == fv.FAILED, error).alias("error_type"),
        F.when(status == fv.FAILED, F.concat(F.col("stage"), F.lit(" failed"))).alias("error_message"),
    )
