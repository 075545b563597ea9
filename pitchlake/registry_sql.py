"""DuckDB SQL for the registered queries.

Written against the test tables directly, without JSON and without the layers
of the package, so that both sides are computed in independent ways.
"""

from __future__ import annotations

from pitchlake import fixed_values as fv

GRID = "[" + ", ".join(f"{v!r}::DOUBLE" for row in fv.XT_GRID for v in row) + "]"

# Match events and Silver, straight from `events`.
SILVER = f"""
ev AS (
  SELECT event_id AS e, user_id AS u, value AS v, event_type AS t,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         event_id // 1000 AS m, event_id % 1000 AS i
  FROM events
), base AS (
  SELECT e, k, m, v, t, u, 1000 + m AS match_id, CAST(e AS VARCHAR) AS event_id,
    CAST(i + 1 AS INTEGER) AS event_index,
    CAST(CASE WHEN i < 480 THEN 1 WHEN i < 940 THEN 2 WHEN i < 980 THEN 3 ELSE 5 END AS INTEGER) AS period,
    CAST(CASE WHEN i < 480 THEN i // 10 WHEN i < 940 THEN 45 + (i - 480) // 9
              WHEN i < 980 THEN 90 + (i - 940) // 4 ELSE 120 END AS INTEGER) AS minute,
    CAST((e * 7) % 60 AS INTEGER) AS second,
    CASE t WHEN 'view' THEN 'Pass' WHEN 'click' THEN 'Carry' WHEN 'purchase' THEN 'Shot'
           WHEN 'signup' THEN 'Pressure' ELSE 'Ball Receipt*' END AS event_type,
    CASE WHEN i % 97 <> 0 THEN CASE WHEN u % 2 = 0 THEN 1 + m % 10 ELSE 11 + m % 7 END END AS team_id,
    u AS player_id, 'Player ' || u AS player_name, CAST(i // 10 AS INTEGER) AS possession_id,
    (e * 37 % 1201) / 10.0::DOUBLE AS raw_x, (e * 53 % 801) / 10.0::DOUBLE AS raw_y,
    CASE WHEN t IN ('view', 'click', 'purchase') THEN (e * 71 % 1201) / 10.0::DOUBLE END AS raw_end_x,
    CASE WHEN t IN ('view', 'click', 'purchase') THEN (e * 89 % 801) / 10.0::DOUBLE END AS raw_end_y,
    CASE WHEN t = 'view' AND u % 4 = 0 THEN 'Incomplete'
         WHEN t = 'purchase' THEN CASE WHEN CAST(floor(v) AS BIGINT) % 9 = 0 THEN 'Goal' ELSE 'Saved' END
         END AS outcome,
    CASE WHEN t = 'purchase' AND e % 31 <> 0 THEN (e * 29 % 1000) / 1000.0::DOUBLE END AS shot_xg,
    CAST(1 AS INTEGER) AS source_version, sha256(CAST(1000 + m AS VARCHAR)) AS file_hash
  FROM ev
), placed AS (
  SELECT *, 'Team ' || team_id AS team_name,
    raw_x / 120::DOUBLE * 105::DOUBLE AS start_x, raw_y / 80::DOUBLE * 68::DOUBLE AS start_y,
    raw_end_x / 120::DOUBLE * 105::DOUBLE AS end_x, raw_end_y / 80::DOUBLE * 68::DOUBLE AS end_y
  FROM base
), measured AS (
  SELECT *,
    sqrt((105 - start_x) * (105 - start_x) + (34 - start_y) * (34 - start_y)) AS d_start,
    sqrt((105 - end_x) * (105 - end_x) + (34 - end_y) * (34 - end_y)) AS d_end,
    CAST(floor(least(greatest(start_x / 105::DOUBLE * 12, 0), 11)) AS INTEGER) AS start_col,
    CAST(floor(least(greatest(start_y / 68::DOUBLE * 8, 0), 7)) AS INTEGER) AS start_row,
    CASE WHEN end_x IS NOT NULL THEN
      CAST(floor(least(greatest(end_x / 105::DOUBLE * 12, 0), 11)) AS INTEGER) END AS end_col,
    CASE WHEN end_y IS NOT NULL THEN
      CAST(floor(least(greatest(end_y / 68::DOUBLE * 8, 0), 7)) AS INTEGER) END AS end_row,
    event_type = 'Pass' AS is_pass, event_type = 'Carry' AS is_carry, event_type = 'Shot' AS is_shot,
    event_type = 'Pass' AND outcome IS NULL AS is_completed_pass
  FROM placed
), graded AS (
  SELECT *,
    CASE WHEN d_start <> 0 THEN d_start - d_end END AS progress_toward_goal_m,
    CASE WHEN d_start <> 0 THEN (d_start - d_end) / d_start END AS progress_ratio,
    is_completed_pass OR is_carry AS is_successful_move,
    ({GRID})[start_row * 12 + start_col + 1] AS v_start,
    ({GRID})[end_row * 12 + end_col + 1] AS v_end
  FROM measured
), silver AS (
  SELECT *,
    is_completed_pass AND coalesce(progress_ratio >= 0.25, false) AS is_progressive_pass,
    CASE WHEN is_successful_move AND v_end IS NOT NULL THEN v_start END AS xt_start,
    CASE WHEN is_successful_move THEN v_end END AS xt_end,
    CASE WHEN is_successful_move THEN v_end - v_start END AS xt_added,
    '{fv.XT_MODEL_VERSION}' AS xt_model_version
  FROM graded
)"""

SILVER_COLUMNS = """match_id, event_id, event_index, period, minute, second, event_type, team_id, team_name,
  player_id, player_name, possession_id, start_x, start_y, end_x, end_y, outcome, shot_xg, is_pass, is_carry,
  is_shot, is_completed_pass, is_progressive_pass, progress_ratio, progress_toward_goal_m, is_successful_move,
  xt_start, xt_end, xt_added, xt_model_version, source_version, file_hash"""
SILVER_DOUBLES = "start_x start_y end_x end_y shot_xg progress_ratio progress_toward_goal_m xt_start xt_end xt_added"

DIM = """
nums AS (SELECT DISTINCT event_id // 1000 AS m FROM events),
dim AS (
  SELECT 1000 + m AS match_id, CAST(DATE '2023-08-01' + CAST(3 * m AS INTEGER) AS DATE) AS match_date,
    printf('%02d:30:00.000', 12 + m % 9) AS kickoff_time,
    CAST(2 AS INTEGER) AS competition_id, 'League' AS competition_name,
    CAST(CASE WHEN m % 10 < 5 THEN 281 ELSE 317 END AS INTEGER) AS season_id,
    CASE WHEN m % 10 < 5 THEN '2023/2024' ELSE '2024/2025' END AS season_name,
    CAST(m % 38 + 1 AS INTEGER) AS match_week,
    1 + m % 10 AS home_team_id, 'Team ' || (1 + m % 10) AS home_team_name,
    11 + m % 7 AS away_team_id, 'Team ' || (11 + m % 7) AS away_team_name,
    CASE WHEN m % 4 <> 0 THEN 'Stadium ' || (1 + m % 10) END AS stadium,
    CASE WHEN m % 5 <> 0 THEN 'Referee ' || (m % 12) END AS referee
  FROM nums
)"""

def _team_fact(source: str) -> str:
    return f"""
  SELECT match_id, team_id, max(team_name) AS team_name,
    count(*) FILTER (WHERE is_shot) AS shots,
    count(*) FILTER (WHERE is_shot AND outcome = 'Goal') AS goals,
    sum(coalesce(shot_xg, 0)) FILTER (WHERE is_shot) AS xg,
    count(*) FILTER (WHERE is_pass) AS attempted_passes,
    count(*) FILTER (WHERE is_completed_pass) AS completed_passes,
    count(*) FILTER (WHERE is_progressive_pass) AS progressive_passes,
    count(*) FILTER (WHERE is_carry) AS carries,
    100.0::DOUBLE * count(*) FILTER (WHERE is_completed_pass) / nullif(count(*) FILTER (WHERE is_pass), 0)
      AS pass_completion_pct,
    max(source_version) AS source_version, max(file_hash) AS file_hash, '{fv.METRIC_VERSION}' AS metric_version
  FROM {source} WHERE team_id IS NOT NULL GROUP BY match_id, team_id"""


TEAM = SILVER + f", team AS ({_team_fact('silver')})"

# The twenty slots of a match, numbered in display order: ten for each half, the tenth for stoppage time.
SLOTS = ", ".join(f"({n}, '{label}')" for n, label in enumerate(fv.INTERVAL_ORDER))
INTERVALS = SILVER + f""",
slot_list(slot, interval_label) AS (VALUES {SLOTS}),
slot_times AS (
  SELECT slot, interval_label, CAST(1 + slot // 10 AS INTEGER) AS period, CAST(5 * (slot % 10) AS INTEGER) AS interval_start,
    slot % 10 = 9 AS is_stoppage_time FROM slot_list
), halved AS (
  SELECT *, minute - 45 * (period - 1) AS period_minute,
    10 * (period - 1) + least(9, (minute - 45 * (period - 1)) // 5) AS raw_slot
  FROM silver WHERE team_id IS NOT NULL AND period IN (1, 2)
), slotted AS (
  SELECT * EXCLUDE (raw_slot),
    CASE WHEN period_minute < 0 THEN NULL ELSE CAST(raw_slot AS INTEGER) END AS slot,
    coalesce(period_minute >= 45, false) AS late FROM halved
), sums AS (
  SELECT match_id, team_id, slot, list(CASE WHEN is_successful_move THEN xt_added END) AS threats,
    count(*) FILTER (WHERE is_successful_move) AS successful_moves, list(CASE WHEN is_shot THEN coalesce(shot_xg, 0) END) AS xgs
  FROM slotted GROUP BY match_id, team_id, slot
), tallied AS (
  SELECT match_id, team_id, slot, successful_moves, len(list_filter(xgs, lambda v: v IS NOT NULL)) AS shots,
    coalesce(list_sum(xgs), 0) AS xg, coalesce(list_sum(list_filter(threats, lambda v: v > 0)), 0) AS positive_xt,
    coalesce(list_sum(list_filter(threats, lambda v: v < 0)), 0) AS negative_xt, coalesce(list_sum(threats), 0) AS net_xt
  FROM sums
), sides AS (
  SELECT match_id, team_id, max(team_name) AS team_name, max(source_version) AS source_version, max(file_hash) AS file_hash,
    max(xt_model_version) AS xt_model_version, '{fv.METRIC_VERSION}' AS metric_version
  FROM halved GROUP BY match_id, team_id
), intervals AS (
  SELECT match_id, team_id, team_name, period, interval_start, is_stoppage_time, interval_label,
    sum(positive_xt) AS positive_xt, sum(negative_xt) AS negative_xt, sum(net_xt) AS net_xt,
    CAST(sum(successful_moves) AS BIGINT) AS successful_moves, CAST(sum(shots) AS BIGINT) AS shots, sum(xg) AS xg,
    source_version, file_hash, xt_model_version, metric_version
  FROM (
    SELECT match_id, team_id, slot, positive_xt, negative_xt, net_xt, successful_moves, shots, xg FROM tallied WHERE slot IS NOT NULL
    UNION ALL SELECT match_id, team_id, slot, 0, 0, 0, 0, 0, 0 FROM sides, slot_list
  ) JOIN sides USING (match_id, team_id) JOIN slot_times USING (slot) GROUP BY ALL
)"""

def _enriched(source: str = "team") -> str:
    return f"""
  SELECT f.*, d.match_date, d.season_name, d.home_team_id, d.home_team_name, d.away_team_id, d.away_team_name,
    CASE WHEN f.team_id = d.home_team_id THEN 'Home' ELSE 'Away' END AS venue,
    CASE WHEN f.team_id = d.home_team_id THEN d.away_team_name ELSE d.home_team_name END AS opponent
  FROM {source} f JOIN dim d USING (match_id)"""


ENRICHED = TEAM + "," + DIM + f", enriched AS ({_enriched()})"

RUNS = """
runs AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS stage_run_id, 'run-' || o_custkey AS airflow_run_id,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'INGEST' WHEN '2' THEN 'BRONZE' WHEN '3' THEN 'SILVER'
      WHEN '4' THEN 'GOLD' ELSE 'REPORTS' END AS stage,
    CAST(1 + o_orderkey % 3 AS INTEGER) AS try_number, o_custkey % 50 AS match_id,
    CASE WHEN o_orderstatus = 'F' AND o_orderkey % 3 = 0 THEN 'FAILED' ELSE 'SUCCEEDED' END AS status,
    CASE WHEN o_orderkey % 13 <> 0 THEN
      o_orderdate + o_orderkey * INTERVAL 1 SECOND - (o_orderkey % 3600) * INTERVAL 1 SECOND END AS started_at,
    o_orderdate + o_orderkey * INTERVAL 1 SECOND AS completed_at,
    o_totalprice % 600 AS duration_seconds,
    CASE WHEN o_orderkey % 7 <> 0 THEN CAST(floor(o_totalprice) AS BIGINT) % 4000 END AS rows_in,
    CASE WHEN o_orderkey % 11 <> 0 THEN CAST(floor(o_totalprice) AS BIGINT) % 5000 END AS rows_out
  FROM orders
)"""

MONITOR = RUNS + """,
history AS (
  SELECT match_id, completed_at, stage_run_id, rows_out,
    median(rows_out) OVER w AS baseline_rows, count(*) OVER w AS baseline_sample
  FROM runs WHERE stage = 'SILVER' AND status = 'SUCCEEDED' AND rows_out IS NOT NULL
  WINDOW w AS (ORDER BY completed_at, stage_run_id ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)
), monitor AS (
  SELECT *, rows_out / nullif(baseline_rows, 0) AS deviation_ratio,
    CASE WHEN baseline_sample < 10 THEN 'INSUFFICIENT_HISTORY'
         WHEN rows_out / nullif(baseline_rows, 0) > 1.5 THEN 'HIGH_VOLUME'
         WHEN rows_out / nullif(baseline_rows, 0) < 0.5 THEN 'LOW_VOLUME' ELSE 'NORMAL' END AS volume_status
  FROM history
), volume_health AS (
  SELECT *, CASE WHEN volume_status IN ('HIGH_VOLUME', 'LOW_VOLUME') THEN 'WARNING'
    WHEN volume_status = 'INSUFFICIENT_HISTORY' THEN 'INFO' ELSE 'HEALTHY' END AS health_status FROM monitor
), recent AS (
  SELECT *, CASE WHEN status = 'FAILED' THEN 'CRITICAL' WHEN try_number > 1 THEN 'WARNING' ELSE 'HEALTHY' END
    AS health_status
  FROM runs QUALIFY row_number() OVER (PARTITION BY stage ORDER BY completed_at DESC, stage_run_id DESC) = 1
)"""

STAGE_NAMES = ", ".join(f"({n}, '{s}')" for n, s in enumerate(fv.STAGES, 1))
RECORDS = f"""
stages(n, stage) AS (VALUES {STAGE_NAMES}),
marked AS (
  SELECT *, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS reached, o_orderstatus = 'F' AS failed FROM orders
), tried AS (
  SELECT *, failed AND (n = reached OR (o_orderkey % 3 = 0 AND n = reached + 1)) AS stops, 0 AS early
  FROM marked, stages WHERE NOT failed OR n <= reached OR (o_orderkey % 3 = 0 AND n = reached + 1)
  UNION ALL
  SELECT *, true, -30 FROM marked, stages
  WHERE stage = 'SILVER' AND o_orderkey % 4 = 0 AND (NOT failed OR n <= reached OR (o_orderkey % 3 = 0 AND n = reached + 1))
), records AS (
  SELECT 'run-' || o_orderkey AS run_id, o_orderkey % 50 AS match_id, CAST(n AS INTEGER) AS n, stage, early = 0 AS final,
    CASE WHEN stops THEN 'FAILED' ELSE 'SUCCEEDED' END AS status,
    o_orderdate + (60 * n + early) * INTERVAL 1 SECOND AS started_at,
    o_orderdate + (60 * n + early + CASE WHEN early < 0 THEN 5 ELSE o_orderkey % 50 + n END) * INTERVAL 1 SECOND
      AS completed_at,
    CASE WHEN NOT stops AND stage <> 'REPORTS' THEN CAST(floor(o_totalprice) AS BIGINT) % 5000 + n END AS rows_out,
    CASE WHEN stops THEN CASE WHEN n = reached THEN 'ValueError' ELSE 'KeyError' END END AS error_type
  FROM tried
)"""

MANIFEST = """
docs AS (
  SELECT doc_id AS arrival, n_chars % 50 AS match_id, lang, sha256(text) AS file_hash FROM documents
), first_batch AS (
  SELECT match_id, file_hash, min(arrival) AS arrival FROM docs WHERE lang = 'en' GROUP BY ALL
), first_rows AS (
  SELECT *, row_number() OVER (PARTITION BY match_id ORDER BY arrival, file_hash) AS version FROM first_batch
), second_batch AS (
  SELECT match_id, file_hash, min(arrival) AS arrival FROM docs
  WHERE (match_id, file_hash) NOT IN (SELECT (match_id, file_hash) FROM first_batch) GROUP BY ALL
), second_rows AS (
  SELECT s.*, coalesce(k.known, 0) + row_number() OVER (PARTITION BY s.match_id ORDER BY arrival, file_hash) AS version
  FROM second_batch s LEFT JOIN (SELECT match_id, count(*) AS known FROM first_batch GROUP BY ALL) k USING (match_id)
), manifest AS (
  SELECT sha256(match_id || '|' || file_hash) AS ingestion_id, match_id, 'driver_tables' AS provider,
    CAST(version AS INTEGER) AS source_version, file_hash,
    'raw/match_id=' || match_id || '/events_' || substr(file_hash, 1, 12) || '.json' AS raw_uri,
    strftime(TIMESTAMP '2024-01-01' + arrival * INTERVAL 1 SECOND, '%Y-%m-%dT%H:%M:%S') AS ingested_at
  FROM (SELECT * FROM first_rows UNION ALL SELECT * FROM second_rows)
)"""

DAMAGED = SILVER + """,
damaged AS (
  SELECT * REPLACE (
    CASE WHEN e % 887 = 0 THEN NULL WHEN e % 409 = 0 THEN 'repeated' ELSE event_id END AS event_id,
    CASE WHEN e % 997 = 0 THEN NULL ELSE event_type END AS event_type,
    CASE WHEN e % 501 = 0 THEN start_x + 130 ELSE start_x END AS start_x,
    CASE WHEN e % 701 = 0 THEN start_y - 100 ELSE start_y END AS start_y,
    CASE WHEN e % 401 = 0 THEN coalesce(shot_xg, 0) + 1.5 ELSE shot_xg END AS shot_xg,
    e % 601 = 0 OR is_completed_pass AS is_completed_pass,
    e % 307 = 0 OR is_progressive_pass AS is_progressive_pass,
    CASE WHEN e % 211 = 0 THEN NULL ELSE xt_added END AS xt_added) FROM silver
)"""


def _rules(source: str) -> str:
    conditions = {
        "event_id_missing": "event_id IS NULL",
        "event_type_missing": "event_type IS NULL",
        "start_x_out_of_range": "start_x < 0 OR start_x > 105",
        "start_y_out_of_range": "start_y < 0 OR start_y > 68",
        "shot_xg_out_of_range": "shot_xg < 0 OR shot_xg > 1",
        "completed_not_pass": "is_completed_pass AND NOT is_pass",
        "progressive_not_completed": "is_progressive_pass AND NOT is_completed_pass",
        "progressive_below_threshold": "is_progressive_pass AND progress_ratio < 0.25",
        "move_without_xt": "is_successful_move AND (xt_start IS NULL OR xt_end IS NULL OR xt_added IS NULL)",
    }
    return counted(source, conditions) + f"""
  UNION ALL SELECT match_id, 'event_id_duplicated', CAST(sum(c - 1) AS BIGINT) FROM (
    SELECT match_id, event_id, count(*) AS c FROM {source} WHERE event_id IS NOT NULL GROUP BY ALL)
  GROUP BY match_id HAVING sum(c - 1) > 0"""


def counted(source: str, conditions: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT match_id, '{rule}' AS rule, count(*) AS n FROM {source} WHERE {condition} GROUP BY match_id"
        for rule, condition in conditions.items()
    )


def nulls(source: str, columns: str, prefix: str = "") -> str:
    return counted(source, {f"{prefix}{c}_not_null": f"{c} IS NULL" for c in columns.split()})


def rounded(inner: str, columns: str, digits: int = 9) -> str:
    """Round doubles as the queries do; + 0 turns -0.0 into 0.0."""
    kept = ", ".join(f"round({c}, {digits}) + 0 AS {c}" for c in columns.split())
    return f"SELECT * REPLACE ({kept}) FROM ({inner})"


def sql(prefix: str, body: str) -> str:
    return f"WITH {prefix.strip()}\n{body.strip()}"


TEAM_DOUBLES = "xg pass_completion_pct"
INTERVAL_DOUBLES = "positive_xt negative_xt net_xt xg"
E_INTERVAL = "((match_id - 1000) * 40 + team_id + period * 100 + interval_start)"

COMMITS = SILVER + """,
listed AS (
  SELECT m, 1 AS seq, true AS published FROM (SELECT DISTINCT m FROM silver)
  UNION ALL SELECT DISTINCT m, 2, true FROM silver WHERE m % 10 >= 5
  UNION ALL SELECT DISTINCT m, 3, m % 2 <> 0 FROM silver WHERE m % 3 = 0
), data AS (
  SELECT *, CAST(1 AS INTEGER) AS commit_seq FROM silver
  UNION ALL SELECT * REPLACE (2 AS source_version), 2 FROM silver WHERE m % 10 >= 5 AND event_type <> 'Pressure'
  UNION ALL SELECT * REPLACE (3 AS source_version), 3 FROM silver WHERE m % 3 = 0 AND event_type <> 'Ball Receipt*'
)"""


#: The current rows of the three commits, and the interval fact over them.
CURRENT = COMMITS + """, current AS (
  SELECT * EXCLUDE (commit_seq) FROM data d
  WHERE commit_seq = (SELECT max(seq) FROM listed l WHERE l.m = d.m AND published)
)"""
CURRENT_INTERVALS = CURRENT + INTERVALS.removeprefix(SILVER).replace("FROM silver WHERE", "FROM current WHERE")


def _state(as_of: int) -> str:
    return sql(COMMITS, rounded(f"""
      SELECT match_id, commit_seq, source_version, event_id, start_x, xt_added FROM data d
      WHERE commit_seq = (SELECT max(seq) FROM listed l WHERE l.m = d.m AND published AND seq <= {as_of})
    """, "start_x xt_added"))


_INGESTED = "SELECT 1000 + m FROM nums WHERE m % 3 = 0"
_NEW = f"dim WHERE match_id NOT IN ({_INGESTED})"
_SHOTS = "silver WHERE is_shot AND team_name IS NOT NULL"

ORACLE: dict[str, str] = {
    # sources
    "raw_json_scan": sql(SILVER, """
      SELECT match_id, event_id, event_index, event_type, team_name, raw_x AS location_x_raw,
        raw_y AS location_y_raw, CASE WHEN is_pass THEN outcome END AS pass_outcome, shot_xg FROM silver"""),
    "artifact_fingerprint": """
      SELECT doc_id AS arrival, n_chars % 50 AS match_id, sha256(text) AS file_hash,
        substr(sha256(text), 1, 12) AS short_hash,
        'raw/match_id=' || (n_chars % 50) || '/events_' || substr(sha256(text), 1, 12) || '.json' AS raw_key,
        'bronze/match_id=' || (n_chars % 50) || '/events_' || substr(sha256(text), 1, 12) || '.parquet' AS bronze_key
      FROM documents""",
    "manifest_register": sql(MANIFEST, "SELECT * FROM manifest"),
    "ingestion_freshness": sql(MANIFEST, "SELECT max(ingested_at) AS latest_ingested_at FROM manifest"),
    "dim_match": sql(DIM, "SELECT * FROM dim"),
    "stg_dim_match": sql(DIM, "SELECT * FROM dim"),
    "dim_match_upsert": sql(DIM, """
      SELECT * REPLACE (
        CAST(CASE WHEN (match_id - 1000) % 4 IN (1, 2) THEN match_week + 1 ELSE match_week END AS INTEGER) AS match_week,
        CASE WHEN (match_id - 1000) % 4 IN (1, 2) THEN 'Revised' ELSE referee END AS referee) FROM dim"""),
    "lineage_edges": sql(DIM, """
      SELECT 'build_silver' AS job, 'bronze/match_id=' || match_id || '/events_'
          || substr(sha256(CAST(match_id AS VARCHAR)), 1, 12) || '.parquet' AS input_dataset,
        'silver_events' AS output_dataset, 'run-' || match_id AS run_id FROM dim
      UNION ALL
      SELECT 'load_serving', 'silver_events', 'serving.src_silver_events', 'run-' || match_id FROM dim"""),
    # Bronze and Silver
    "bronze_events": sql(SILVER, """
      SELECT match_id, 'driver_tables' AS provider, source_version, file_hash,
        'ingestion-' || match_id AS ingestion_id, '2024-01-01T00:00:00+00:00' AS ingested_at,
        event_id, event_index, period, printf('00:%02d:%02d.000', minute, second) AS timestamp, minute, second,
        CAST(CASE t WHEN 'view' THEN 30 WHEN 'click' THEN 43 WHEN 'purchase' THEN 16 WHEN 'signup' THEN 17
          ELSE 42 END AS BIGINT) AS event_type_id, event_type AS event_type_name,
        team_id, team_name, player_id, player_name, u % 25 + 1 AS position_id,
        'Position ' || (u % 25 + 1) AS position_name, possession_id AS possession,
        team_id AS possession_team_id, team_name AS possession_team_name,
        e % 9 + 1 AS play_pattern_id, 'Pattern ' || (e % 9 + 1) AS play_pattern_name,
        raw_x AS location_x_raw, raw_y AS location_y_raw, v AS duration,
        CASE WHEN k % 7 = 0 THEN true END AS under_pressure, CAST(NULL AS BOOLEAN) AS off_camera,
        CASE WHEN k % 11 = 0 THEN true END AS "out",
        CASE WHEN k % 5 = 0 THEN 'null' WHEN k % 5 = 1 THEN '[]'
          ELSE '["' || (e - 1) || '", "' || (e + 1) || '"]' END AS related_events_json
      FROM silver"""),
    "bronze_with_lineage": sql(SILVER, """
      SELECT event_id, match_id, 'driver_tables' AS provider, source_version, file_hash,
        'ingestion-' || match_id AS ingestion_id, '2024-01-01T00:00:00+00:00' AS ingested_at FROM silver"""),
    "bronze_related_json": sql(SILVER, """
      SELECT match_id, event_id, CASE WHEN k % 5 = 0 THEN 'null' WHEN k % 5 = 1 THEN '[]'
        ELSE '["' || (e - 1) || '", "' || (e + 1) || '"]' END AS related_events_json FROM silver"""),
    "bronze_profile": sql(SILVER, """
      SELECT 'event_type' AS facet, event_type AS name, count(*) AS n FROM silver
      WHERE event_type IS NOT NULL GROUP BY event_type
      UNION ALL SELECT 'team', team_name, count(*) FROM silver GROUP BY team_name"""),
    "bronze_sample": sql(SILVER, """
      SELECT match_id, event_index, minute, second, team_name, player_name, event_type AS event_type_name,
        raw_x AS location_x_raw, raw_y AS location_y_raw FROM silver ORDER BY match_id, event_index LIMIT 20"""),
    "silver_events": sql(SILVER, rounded(f"SELECT {SILVER_COLUMNS} FROM silver", SILVER_DOUBLES)),
    "silver_from_bronze": sql(SILVER, rounded(f"SELECT {SILVER_COLUMNS} FROM silver", SILVER_DOUBLES)),
    "silver_coordinates": sql(SILVER, rounded(
        "SELECT match_id, event_id, start_x, start_y, end_x, end_y FROM silver", "start_x start_y end_x end_y")),
    "silver_outcomes": sql(SILVER, "SELECT match_id, event_id, event_type, outcome, shot_xg FROM silver"),
    "silver_flags": sql(SILVER, """
      SELECT match_id, event_id, is_pass, is_carry, is_shot, is_completed_pass, is_progressive_pass,
        is_successful_move FROM silver"""),
    "silver_progression": sql(SILVER, rounded(
        "SELECT match_id, event_id, progress_toward_goal_m, progress_ratio FROM silver",
        "progress_toward_goal_m progress_ratio")),
    "xt_cells": sql(SILVER, "SELECT match_id, event_id, start_col, start_row, end_col, end_row FROM silver"),
    "xt_lookup": sql(SILVER, rounded(f"""
      SELECT match_id, event_id, '{fv.XT_MODEL_VERSION}' AS model_version,
        CASE WHEN v_end IS NOT NULL THEN v_start END AS xt_start, v_end AS xt_end, v_end - v_start AS xt_added
      FROM silver UNION ALL
      SELECT match_id, event_id, 'reversed', CASE WHEN w_end IS NOT NULL THEN w_start END, w_end, w_end - w_start
      FROM (SELECT *, ({GRID})[start_row * 12 + 11 - start_col + 1] AS w_start,
              ({GRID})[end_row * 12 + 11 - end_col + 1] AS w_end FROM silver)
    """, "xt_start xt_end xt_added")),
    "xt_rated_moves": sql(SILVER, rounded("""
      SELECT match_id, event_id, xt_start, xt_end, xt_added, xt_model_version FROM silver
      WHERE is_successful_move""", "xt_start xt_end xt_added")),
    "xt_grid_long": sql(SILVER, f"""
      SELECT '{fv.XT_MODEL_VERSION}' AS model_version, CAST(c // 12 AS INTEGER) AS "row",
        CAST(c % 12 AS INTEGER) AS col, ({GRID})[c + 1] AS value,
        (SELECT count(*) FROM silver WHERE is_successful_move AND start_row * 12 + start_col = c) AS moves
      FROM range(0, 96) cells(c)"""),
    # Gold
    "fact_gold_team": sql(TEAM, rounded("SELECT * FROM team", TEAM_DOUBLES)),
    "team_match_xt": sql(SILVER, rounded("""
      SELECT match_id, team_id, coalesce(sum(xt_added) FILTER (WHERE xt_added > 0), 0) AS positive_xt,
        coalesce(sum(xt_added) FILTER (WHERE xt_added < 0), 0) AS negative_xt,
        coalesce(sum(xt_added), 0) AS net_xt
      FROM silver WHERE team_id IS NOT NULL GROUP BY ALL""", "positive_xt negative_xt net_xt")),
    "interval_assign": sql(INTERVALS, """
      SELECT match_id, event_id, period, minute, period_minute, late AS is_stoppage_time,
        CASE WHEN late THEN 45 ELSE CAST(trunc(period_minute / 5) AS INTEGER) * 5 END AS interval_start FROM slotted"""),
    "interval_aggregates": sql(INTERVALS, rounded("""
      SELECT match_id, team_id, period, interval_start, is_stoppage_time, positive_xt, negative_xt, net_xt,
        successful_moves, shots, xg FROM tallied JOIN slot_times USING (slot)""", INTERVAL_DOUBLES)),
    "interval_spine": sql(INTERVALS, "SELECT * EXCLUDE (slot) FROM sides, slot_times"),
    "interval_labels": sql(INTERVALS, """
      SELECT period, interval_start, is_stoppage_time, interval_label, count(*) AS rows,
        CAST(sum(successful_moves) AS BIGINT) AS successful_moves FROM intervals GROUP BY ALL"""),
    "fact_gold_intervals": sql(INTERVALS, rounded("SELECT * FROM intervals", INTERVAL_DOUBLES)),
    "fact_team_match": sql(TEAM, rounded("""
      SELECT match_id, team_id, team_name, goals, shots, xg, attempted_passes, completed_passes,
        progressive_passes, carries FROM team""", "xg")),
    "team_match_enriched": sql(ENRICHED, rounded("SELECT * FROM enriched", TEAM_DOUBLES)),
    "team_season_summary": sql(ENRICHED, rounded("""
      SELECT team_name, season_name, count(*) AS matches, CAST(sum(goals) AS BIGINT) AS goals,
        CAST(sum(shots) AS BIGINT) AS shots, sum(xg) AS xg,
        CAST(sum(progressive_passes) AS BIGINT) AS progressive_passes
      FROM enriched GROUP BY ALL""", "xg", 6)),
    "match_by_match": sql(ENRICHED, rounded("""
      SELECT team_name, season_name, match_date, opponent, venue, goals, xg FROM enriched""", "xg")),
    "team_home_away_summary": sql(ENRICHED, rounded("""
      SELECT team_name, season_name, venue, count(*) AS matches, CAST(sum(goals) AS BIGINT) AS goals,
        sum(xg) AS xg, avg(goals) AS goals_per_match, avg(xg) AS xg_per_match
      FROM enriched GROUP BY ALL""", "xg goals_per_match xg_per_match", 6)),
    # profiles and reports
    "top_xt_moves": sql(SILVER, rounded("""
      SELECT match_id, event_index, minute, team_name, player_name, event_type, start_x, start_y, end_x, end_y,
        xt_start, xt_end, xt_added FROM silver WHERE is_successful_move
      ORDER BY xt_added DESC NULLS LAST, match_id, event_index LIMIT 20
    """, "start_x start_y end_x end_y xt_start xt_end xt_added")),
    "player_xt_leaders": sql(SILVER, """
      SELECT player_name, round(sum(xt_added), 8) AS xt_added FROM silver WHERE is_successful_move
      GROUP BY ALL ORDER BY sum(xt_added) DESC NULLS LAST, player_name LIMIT 15"""),
    "player_progressive_leaders": sql(SILVER, """
      SELECT player_name, count(*) AS progressive_passes FROM silver WHERE is_progressive_pass
      GROUP BY ALL ORDER BY progressive_passes DESC, player_name LIMIT 10"""),
    "team_progressive": sql(SILVER, """
      SELECT team_name, count(*) AS progressive_passes FROM silver
      WHERE is_progressive_pass AND team_name IS NOT NULL GROUP BY ALL"""),
    "shot_x_profile": sql(SILVER, rounded(f"""
      SELECT team_name, period, count(*) AS shots, avg(start_x) AS avg_shot_x, min(start_x) AS min_shot_x,
        max(start_x) AS max_shot_x FROM {_SHOTS} GROUP BY ALL""", "avg_shot_x min_shot_x max_shot_x")),
    "orientation_check": sql(SILVER, rounded(f"""
      SELECT match_id, team_name, period, median(start_x) AS median_start_x, median(start_x) < 60 AS suspicious
      FROM {_SHOTS} GROUP BY ALL""", "median_start_x")),
    "match_summary": sql(TEAM, rounded("""
      WITH kept AS (SELECT * FROM team WHERE (match_id - 1000) % 4 <> 3 OR team_id < 11),
      ends AS (SELECT match_id, min(team_name) AS f, max(team_name) AS l, CAST(count(*) AS INTEGER) AS teams FROM kept GROUP BY match_id)
      SELECT match_id, team_a, team_b, teams, metric_order, metric, value_a, value_b, text_a, text_b FROM (
        SELECT a.match_id, a.team_name AS team_a, b.team_name AS team_b, e.teams, s.*
        FROM ends e JOIN kept a ON a.match_id = e.match_id AND a.team_name = e.f
        LEFT JOIN kept b ON b.match_id = e.match_id AND b.team_name = e.l AND e.teams > 1,
        LATERAL (
          SELECT 1 AS metric_order, 'Goals' AS metric, a.goals::DOUBLE AS value_a, b.goals::DOUBLE AS value_b,
            a.goals::VARCHAR AS text_a, b.goals::VARCHAR AS text_b
          UNION ALL SELECT 2, 'Shots', a.shots, b.shots, a.shots::VARCHAR, b.shots::VARCHAR
          UNION ALL SELECT 3, 'xG', a.xg, b.xg,
            round(round(a.xg, 6)::DECIMAL(24, 6), 2)::VARCHAR, round(round(b.xg, 6)::DECIMAL(24, 6), 2)::VARCHAR
          UNION ALL SELECT 4, 'Pass completion', a.pass_completion_pct, b.pass_completion_pct,
            round(round(a.pass_completion_pct, 6)::DECIMAL(24, 6), 1)::VARCHAR || '%',
            round(round(b.pass_completion_pct, 6)::DECIMAL(24, 6), 1)::VARCHAR || '%'
          UNION ALL SELECT 5, 'Progressive passes', a.progressive_passes, b.progressive_passes,
            a.progressive_passes::VARCHAR, b.progressive_passes::VARCHAR
          UNION ALL SELECT 6, 'Carries', a.carries, b.carries, a.carries::VARCHAR, b.carries::VARCHAR
        ) s)""", "value_a value_b")),
    "shot_map_points": sql(SILVER, rounded(f"""
      SELECT match_id, event_id, team_name, player_name, start_x, start_y, shot_xg, outcome = 'Goal' AS is_goal,
        coalesce(shot_xg, 0.05) * 1200 + 60 AS marker_size FROM {_SHOTS}""",
        "start_x start_y shot_xg marker_size")),
    "shot_map_totals": sql(SILVER, rounded(f"""
      SELECT match_id, team_name, count(*) AS shots, count(*) FILTER (WHERE outcome = 'Goal') AS goals,
        sum(coalesce(shot_xg, 0)) AS total_xg FROM {_SHOTS} GROUP BY ALL""", "total_xg")),
    "xg_timeline": sql(SILVER, rounded(f"""
      SELECT match_id, team_name, event_index, minute + second / 60.0::DOUBLE AS match_minute,
        coalesce(shot_xg, 0) AS shot_xg,
        sum(coalesce(shot_xg, 0)) OVER (PARTITION BY match_id, team_name ORDER BY event_index) AS cumulative_xg,
        outcome = 'Goal' AS is_goal,
        CASE WHEN outcome = 'Goal' THEN coalesce(shot_xg, 0) * 350 + 80
             ELSE coalesce(shot_xg, 0) * 250 + 20 END AS marker_size FROM {_SHOTS}
      UNION ALL
      SELECT DISTINCT match_id, team_name, 0, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, false, NULL::DOUBLE
      FROM {_SHOTS}""", "match_minute shot_xg cumulative_xg marker_size")),
    "xt_momentum": sql(INTERVALS, rounded(f"""
      SELECT match_id, team_name, team_rank, interval_label, display_order, positive_xt,
        CASE WHEN team_rank = 2 THEN 0 - positive_xt ELSE positive_xt END AS shown_xt
      FROM (SELECT *, CAST(dense_rank() OVER (PARTITION BY match_id ORDER BY team_name) AS INTEGER) AS team_rank,
          CAST(list_position({fv.INTERVAL_ORDER!r}, interval_label) - 1 AS INTEGER) AS display_order
        FROM intervals WHERE (match_id - 1000) % 4 <> 3 OR team_id < 11)""", "positive_xt shown_xt")),
    "dq_report_inputs": sql(INTERVALS + f""",
      kept_team AS (SELECT match_id, count(*) AS n FROM ({_team_fact('silver')})
        WHERE (match_id - 1000) % 4 <> 3 OR team_id < 11 GROUP BY match_id),
      kept AS (SELECT *, {E_INTERVAL} AS x FROM intervals WHERE {E_INTERVAL} % 23 <> 0)""", """
      SELECT match_id, 'not_two_teams' AS rule, n FROM kept_team WHERE n <> 2
      UNION ALL SELECT match_id, 'unknown_interval_label', count(*) FROM kept WHERE x % 17 = 0 GROUP BY match_id
      UNION ALL SELECT match_id, 'missing_intervals', count(*) FROM (
        SELECT match_id, team_id, count(*) FILTER (WHERE x % 17 <> 0) AS c FROM kept GROUP BY ALL)
        WHERE c < 20 GROUP BY match_id
      UNION ALL SELECT match_id, 'no_shots', 1 FROM silver GROUP BY match_id, m
        HAVING m % 5 = 2 OR count(*) FILTER (WHERE is_shot) = 0"""),
    # quality
    "dq_silver": sql(DAMAGED, _rules("damaged")),
    "quarantine_matches": sql(SILVER + f""",
      bad AS (SELECT * REPLACE (CASE WHEN e % 4001 = 17 THEN -1 ELSE start_x END AS start_x,
        CASE WHEN e % 3001 = 29 THEN 2 ELSE shot_xg END AS shot_xg) FROM silver),
      found AS ({_rules('bad')})""", """
      SELECT match_id, events, coalesce(broken_rules, 0) AS broken_rules, coalesce(violations, 0) AS violations,
        CASE WHEN broken_rules > 0 THEN 'quarantined' ELSE 'published' END AS status
      FROM (SELECT match_id, count(*) AS events FROM bad GROUP BY match_id)
      LEFT JOIN (SELECT match_id, count(*) AS broken_rules, CAST(sum(n) AS BIGINT) AS violations
        FROM found GROUP BY match_id) USING (match_id)"""),
    "published_matches": sql(SILVER + f""",
      bad AS (SELECT * REPLACE (CASE WHEN e % 4001 = 17 THEN -1 ELSE start_x END AS start_x)
        FROM silver WHERE m % 9 <> 4),
      found AS ({_rules('bad')} UNION ALL SELECT DISTINCT match_id, 'empty_batch', 0 FROM silver WHERE m % 9 = 4)""", """
      SELECT match_id, 'published' AS rule, count(*) AS n FROM bad
      WHERE match_id NOT IN (SELECT match_id FROM found) GROUP BY match_id
      UNION ALL SELECT * FROM found"""),
    "reconcile_bronze_silver": sql(SILVER, """
      SELECT *, bronze_rows = silver_rows AND missing_ids + unexpected_ids = 0 AS reconciled FROM (
        SELECT match_id, count(*) AS bronze_rows, count(*) FILTER (WHERE e % 501 <> 0) AS silver_rows,
          count(*) FILTER (WHERE e % 501 = 0 OR e % 3503 = 0) AS missing_ids,
          count(*) FILTER (WHERE e % 501 <> 0 AND e % 3503 = 0) AS unexpected_ids
        FROM silver GROUP BY match_id)"""),
    "reconcile_gold_team": sql(TEAM, rounded("""
      SELECT * FROM (
        SELECT match_id, team_id,
          CASE WHEN found THEN shots + CASE WHEN team_id % 5 = 0 THEN 1 ELSE 0 END END AS gold_shots,
          CASE WHEN found THEN completed_passes END AS gold_completed_passes,
          CASE WHEN found AND team_id % 7 <> 0 THEN xg END AS gold_xg,
          shots AS silver_shots, completed_passes AS silver_completed_passes, xg AS silver_xg
        FROM (SELECT *, (match_id - 1000 + team_id) % 9 <> 0 AS found FROM team))
      WHERE gold_shots IS DISTINCT FROM silver_shots
        OR gold_completed_passes IS DISTINCT FROM silver_completed_passes OR gold_xg IS DISTINCT FROM silver_xg
    """, "gold_xg silver_xg")),
    "fact_dim_references": sql(DIM, """
      SELECT match_id, CASE WHEN m % 7 = 3 THEN 'missing_from_fact' ELSE 'unknown_in_fact' END AS problem
      FROM (SELECT m, 1000 + m AS match_id FROM nums) WHERE (m % 7 = 3) <> (m % 5 = 2)"""),
    "dq_relationships": sql(TEAM, """
      SELECT match_id, 'team_in_dim_match' AS rule, count(*) AS n FROM team
      WHERE (match_id - 1000) % 5 = 2 GROUP BY match_id"""),
    "dq_dim_match": sql(DIM, """
      SELECT NULL::BIGINT AS match_id, 'match_id_missing' AS rule,
        CAST(sum(CASE WHEN m % 3 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS n
      FROM nums WHERE m % 7 = 5 HAVING count(*) > 0
      UNION ALL SELECT 1000 + m, 'match_id_duplicated', 2 FROM nums WHERE m % 3 = 0 AND m % 7 <> 5"""),
    "dq_not_null": sql(DAMAGED + f", team AS ({_team_fact('silver')}), {DIM}, " + f"""
      bad_team AS (SELECT * REPLACE (CASE WHEN team_id % 6 = 0 THEN NULL ELSE team_id END AS team_id) FROM team),
      bad_enriched AS (SELECT * REPLACE (CASE WHEN team_id % 4 = 0 THEN NULL ELSE team_name END AS team_name)
        FROM ({_enriched()}))""",
        nulls("bad_team", "match_id team_id", "team.") + " UNION ALL "
        + nulls("bad_enriched", "match_id team_id team_name goals match_date venue opponent", "enriched.")
        + " UNION ALL " + nulls("damaged", "match_id event_id event_index period minute second event_type")
        + " UNION ALL " + nulls("dim", "match_id match_date home_team_id home_team_name away_team_id away_team_name")),
    "dq_unique": sql(INTERVALS + f", team AS ({_team_fact('silver')})", f"""
      SELECT match_id, 'team_unique' AS rule, 2 * count(*) AS n FROM team WHERE (match_id - 1000) % 3 = 0
      GROUP BY match_id UNION ALL
      SELECT match_id, 'interval_unique', 2 * count(*) FROM intervals WHERE {E_INTERVAL} % 19 = 0 GROUP BY match_id"""),
    "dq_accepted_values": sql(TEAM, """
      SELECT match_id, 'venue_accepted_values' AS rule, count(*) AS n FROM team WHERE team_id % 4 = 0
      GROUP BY match_id"""),
    "dq_accepted_range": sql(INTERVALS + f", team AS ({_team_fact('silver')})",
        counted("team", {
            "shots_accepted_range": "shots - 95 < 0", "xg_accepted_range": "xg - 45 < 0",
            "pass_completion_pct_accepted_range": "pass_completion_pct + 1 > 100",
        }) + " UNION ALL " + counted("intervals", {
            "positive_xt_accepted_range": "positive_xt - 0.05::DOUBLE < 0",
            "negative_xt_accepted_range": "negative_xt + 0.1::DOUBLE > 0",
        })),
    "dq_gold_invariants": sql(TEAM, counted("team", {
        "goals_above_shots": "goals * 8 > shots",
        "completed_above_attempted": "completed_passes + 5 > attempted_passes",
        "progressive_above_completed": "progressive_passes * 2 + 10 > completed_passes + 5",
    })),
    "dq_two_teams": sql(TEAM, """
      SELECT match_id, 'not_two_teams' AS rule, count(*) AS n FROM team
      WHERE (match_id - 1000 + team_id) % 5 <> 0 GROUP BY match_id HAVING count(*) <> 2"""),
    "dq_forty_rows": sql(INTERVALS, f"""
      SELECT match_id, 'not_forty_intervals' AS rule, count(*) AS n FROM intervals
      WHERE {E_INTERVAL} % 23 <> 0 GROUP BY match_id HAVING count(*) <> 40"""),
    "dq_interval_boundaries": sql(INTERVALS, f"""
      SELECT match_id, 'interval_start_off_grid' AS rule, count(*) AS n FROM intervals
      WHERE {E_INTERVAL} % 23 = 0 GROUP BY match_id"""),
    "dq_net_xt": sql(INTERVALS, f"""
      SELECT match_id, 'net_xt_differs' AS rule, count(*) AS n FROM intervals
      WHERE {E_INTERVAL} % 23 = 0 GROUP BY match_id"""),
    # incremental work
    "silver_commit_replace": _state(3),
    "silver_pinned_read": _state(2),
    "serving_replace": sql(SILVER, rounded("""
      SELECT match_id, event_id, CAST(CASE WHEN m % 10 >= 5 THEN 2 ELSE 1 END AS INTEGER) AS source_version,
        event_type, start_x FROM silver WHERE m % 10 < 5 OR event_type <> 'Pressure'""", "start_x")),
    "gold_incremental": sql(SILVER + f""",
      revised AS (SELECT * REPLACE (CAST(CASE WHEN m % 10 >= 5 THEN 2 ELSE 1 END AS INTEGER) AS source_version)
        FROM silver WHERE m % 10 < 5 OR event_type <> 'Carry')""",
        rounded(_team_fact("revised"), TEAM_DOUBLES)),
    "gold_parts_team": sql(CURRENT, rounded(_team_fact("current"), TEAM_DOUBLES)),
    "gold_parts_intervals": sql(CURRENT_INTERVALS, rounded("""
      SELECT match_id, team_id, period, interval_start, is_stoppage_time, interval_label, positive_xt, negative_xt,
        net_xt, successful_moves, shots, xg, source_version FROM intervals""", INTERVAL_DOUBLES)),
    "gold_backfill": sql(INTERVALS, rounded("""
      SELECT match_id, team_id, period, interval_start, is_stoppage_time, interval_label, positive_xt, negative_xt,
        net_xt, successful_moves, shots, xg FROM intervals WHERE (match_id - 1000) % 10 >= 5""", INTERVAL_DOUBLES)),
    "new_matches": sql(DIM, f"SELECT match_id, match_date FROM {_NEW}"),
    "discover_new_matches": sql(DIM, f"""
      SELECT match_id, match_date FROM {_NEW} ORDER BY match_date NULLS LAST, match_id LIMIT 5"""),
    "bulk_scope": sql(DIM, f"""
      SELECT match_id, match_date, home_team_name, away_team_name FROM {_NEW}
      AND competition_id = 2 AND season_id = 281"""),
    "bulk_scope_by_team": sql(DIM, f"""
      SELECT match_id, match_date, season_name, home_team_name AS team_name FROM {_NEW}
      UNION ALL SELECT match_id, match_date, season_name, away_team_name FROM {_NEW}"""),
    # run metadata
    "stage_health": sql(RUNS, rounded("""
      SELECT stage, count(*) AS attempts, count(*) FILTER (WHERE status = 'SUCCEEDED') AS successful_attempts,
        count(*) FILTER (WHERE status = 'FAILED') AS failed_attempts,
        avg(duration_seconds) FILTER (WHERE status = 'SUCCEEDED') AS avg_duration_seconds,
        max(duration_seconds) FILTER (WHERE status = 'SUCCEEDED') AS max_duration_seconds,
        avg(rows_out) FILTER (WHERE status = 'SUCCEEDED') AS avg_rows_out
      FROM runs GROUP BY stage""", "avg_duration_seconds max_duration_seconds avg_rows_out", 6)),
    "stage_volume_history": sql(RUNS, """
      SELECT match_id, stage, completed_at, rows_in, rows_out FROM runs
      WHERE status = 'SUCCEEDED' AND rows_out IS NOT NULL"""),
    "silver_volume_monitor": sql(MONITOR, rounded("""
      SELECT match_id, completed_at, rows_out, baseline_rows, deviation_ratio, volume_status FROM monitor
    """, "baseline_rows deviation_ratio")),
    "silver_volume_appended": sql(MONITOR, rounded("""
      SELECT match_id, completed_at, rows_out, baseline_rows, deviation_ratio, volume_status FROM monitor
    """, "baseline_rows deviation_ratio")),
    "silver_volume_health": sql(MONITOR, rounded("""
      SELECT match_id, completed_at, rows_out, baseline_rows, deviation_ratio, volume_status, health_status
      FROM volume_health""", "baseline_rows deviation_ratio")),
    "recent_stage_health": sql(MONITOR, rounded("""
      SELECT stage, match_id, airflow_run_id, lower(stage) AS task_id, try_number, status, started_at,
        completed_at, duration_seconds, rows_in, rows_out, health_status FROM recent""", "duration_seconds")),
    "alert_candidates": sql(MONITOR, """
      SELECT stage AS component, match_id, completed_at AS occurred_at, health_status, status AS reason
      FROM recent WHERE health_status = 'CRITICAL'
      UNION ALL SELECT 'SILVER_VOLUME', match_id, completed_at, health_status, volume_status
      FROM volume_health WHERE health_status = 'WARNING'"""),
    "current_health": sql(MONITOR + """,
      signals AS (
        SELECT health_status FROM recent UNION ALL
        (SELECT health_status FROM volume_health ORDER BY completed_at DESC, stage_run_id DESC LIMIT 1)
      ), scored AS (
        SELECT CASE health_status WHEN 'CRITICAL' THEN 3 WHEN 'WARNING' THEN 2 WHEN 'INFO' THEN 1 ELSE 0 END
          AS severity FROM signals)""", """
      SELECT CASE max(severity) WHEN 3 THEN 'CRITICAL' WHEN 2 THEN 'WARNING' WHEN 1 THEN 'INFO' ELSE 'HEALTHY' END
          AS overall_health,
        count(*) FILTER (WHERE severity = 3) AS critical_signals,
        count(*) FILTER (WHERE severity = 2) AS warning_signals,
        count(*) FILTER (WHERE severity = 1) AS info_signals FROM scored"""),
    "retry_summary": sql(RUNS, """
      SELECT airflow_run_id, lower(stage) AS task_id, match_id, count(*) AS retry_counts,
        min(completed_at) AS first_retry_at, max(completed_at) AS last_retry_at
      FROM runs WHERE try_number = 2 GROUP BY ALL"""),
    "run_durations": sql(RUNS, """
      SELECT stage_run_id, started_at, completed_at,
        CASE WHEN started_at IS NOT NULL THEN (CAST(stage_run_id AS BIGINT) % 3600)::DOUBLE END AS duration_seconds
      FROM runs"""),
    "run_outcomes": sql(RECORDS, """
      SELECT run_id, match_id, min(started_at) AS started_at,
        CASE WHEN bool_or(final AND status = 'FAILED') THEN 'FAILED' ELSE 'SUCCEEDED' END AS status,
        max(completed_at) AS completed_at,
        arg_max(stage, n) FILTER (WHERE final AND status = 'FAILED') AS failed_stage,
        arg_max(error_type, n) FILTER (WHERE final AND status = 'FAILED') AS error_type,
        arg_max(stage, n) FILTER (WHERE final AND status = 'FAILED') || ' failed' AS error_message,
        epoch(max(completed_at) - min(started_at))::DOUBLE AS duration_seconds
      FROM records GROUP BY run_id, match_id"""),
    "stage_row_flow": sql(RECORDS, """
      SELECT run_id, match_id, stage, status, CASE stage
          WHEN 'BRONZE' THEN max(rows_out) FILTER (WHERE stage = 'INGEST') OVER run
          WHEN 'SILVER' THEN max(rows_out) FILTER (WHERE stage = 'BRONZE') OVER run
          WHEN 'GOLD_TEAM' THEN max(rows_out) FILTER (WHERE stage = 'SILVER') OVER run
          WHEN 'GOLD_INTERVAL' THEN max(rows_out) FILTER (WHERE stage = 'SILVER') OVER run END AS rows_in, rows_out
      FROM records WINDOW run AS (PARTITION BY run_id)"""),
    "run_stage_matrix": sql(RECORDS, """
      SELECT 'run-' || o_orderkey AS run_id, o_orderkey % 50 AS match_id, CAST(s.n AS INTEGER) AS stage_order,
        s.stage, coalesce(r.status, 'NOT_RUN') AS status, r.started_at, r.completed_at
      FROM orders CROSS JOIN stages s
      LEFT JOIN records r ON r.run_id = 'run-' || o_orderkey AND r.stage = s.stage AND r.final"""),
}
