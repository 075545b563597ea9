"""Contracts, quality rules, reconciliation and quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from pitchlake import fixed_values as fv, schemas
from pitchlake.operators import checks
from pitchlake.operators.keyed import key_counts, settled, without
from pitchlake.session import cut_lineage

# Tolerances of the numeric comparisons.
XG_TOLERANCE = 1e-6
NET_XT_TOLERANCE = 1e-10


def contract_errors(actual: T.StructType, contract: T.StructType = schemas.SILVER) -> list[str]:
    """Missing columns and columns of the wrong type family."""
    found = {field.name: field.dataType for field in actual.fields}
    errors = [f"missing column: {name}" for name in contract.fieldNames() if name not in found]
    for field in contract.fields:
        if field.name in found:
            expected = schemas.FAMILIES[type(field.dataType)]
            got = schemas.FAMILIES.get(type(found[field.name]), found[field.name].simpleString())
            # An integer column is numeric, too.
            if got != expected and (expected, got) != ("numeric", "integer"):
                errors.append(f"{field.name}: expected {expected}, got {got}")
    return sorted(errors)


def unexpected_columns(actual: T.StructType, contract: T.StructType = schemas.SILVER) -> list[str]:
    """Columns outside the contract; reported as a warning."""
    return sorted(set(actual.fieldNames()) - set(contract.fieldNames()))


def require_contract(df: DataFrame, contract: T.StructType = schemas.SILVER) -> DataFrame:
    errors = contract_errors(df.schema, contract)
    if errors:
        raise ValueError(f"Contract violated: {errors}")
    return df


def silver_violations(silver: DataFrame) -> DataFrame:
    """All row rules and event-id uniqueness of Silver.

    The row rules are counted next to the scan and shuffle one row per match
    and task. Only the ids themselves are shuffled row by row, by match and
    event, which spreads even one huge match over all tasks.
    """
    counted = silver.groupBy("match_id", "event_id").agg(F.count("*").alias("n_right"))
    return silver_row_violations(silver).unionByName(duplicated_ids(counted))


def silver_row_violations(silver: DataFrame) -> DataFrame:
    """The rules that a row breaks by itself."""
    c = F.col
    rules = {
        "event_id_missing": c("event_id").isNull(),
        "event_type_missing": c("event_type").isNull(),
        "start_x_out_of_range": checks.range_violation("start_x", 0, fv.PITCH_LENGTH),
        "start_y_out_of_range": checks.range_violation("start_y", 0, fv.PITCH_WIDTH),
        "shot_xg_out_of_range": checks.range_violation("shot_xg", 0, 1),
        "completed_not_pass": c("is_completed_pass") & ~c("is_pass"),
        "progressive_not_completed": c("is_progressive_pass") & ~c("is_completed_pass"),
        "progressive_below_threshold": c("is_progressive_pass") & (c("progress_ratio") < fv.PROGRESSIVE_RATIO),
        "move_without_xt": c("is_successful_move")
        & (c("xt_start").isNull() | c("xt_end").isNull() | c("xt_added").isNull()),
    }
    return checks.row_rules(silver, rules)


def duplicated_ids(counted: DataFrame) -> DataFrame:
    """Event ids that occur more than once, from ``n_right`` rows per match and id."""
    return (
        counted.where("event_id IS NOT NULL AND n_right > 1").groupBy("match_id").agg(F.sum(F.col("n_right") - 1).alias("n"))
        .select("match_id", F.lit("event_id_duplicated").alias("rule"), "n")
    )


def empty_batches(registered: DataFrame, silver: DataFrame) -> DataFrame:
    """Registered matches without a single Silver row."""
    missing = without(registered.select("match_id").distinct(), silver, ["match_id"])
    return missing.select("match_id", F.lit("empty_batch").alias("rule"), F.lit(0).cast("long").alias("n"))


def reconcile_bronze_silver(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Row counts and differing event ids per match."""
    agreeing, ids = compared_matches(bronze, silver)
    return agreeing if ids is None else agreeing.unionByName(reconciled_ids(ids))


def set_prints(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Rows per match on both sides, and whether the event ids are the ``same``, by prints that do not depend on order.

    A print is made of sums and exclusive ors of two 64-bit hashes of each id. Bronze counts for, Silver against; equal ids,
    each as often on both sides, cancel out. Rows are added up in the map tasks, so that only sums per match are shuffled.
    """
    def side(df: DataFrame, sign: int) -> DataFrame:
        hashes = [F.xxhash64("event_id").alias("h"), F.xxhash64(F.lit(1), "event_id").alias("g")]
        return df.select("match_id", F.lit(sign).alias("sign"), *hashes)

    halves = [half for h in ("h", "g") for half in (F.col(h).bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(h, 32))]
    both = side(bronze, 1).unionByName(side(silver, -1)).groupBy("match_id").agg(
        F.count_if(F.col("sign") > 0).alias("bronze_rows"), F.count_if(F.col("sign") < 0).alias("silver_rows"),
        *[F.sum(F.col("sign") * half).alias(f"s{k}") for k, half in enumerate(halves)],
        *[F.bit_xor(h).alias(f"x{k}") for k, h in enumerate(("h", "g"))],
    )
    cancelled = F.col("bronze_rows") == F.col("silver_rows")
    for name in ("s0", "s1", "s2", "s3", "x0", "x1"):
        cancelled &= F.col(name) == 0
    return both.select("match_id", "bronze_rows", "silver_rows", cancelled.alias("same"))


def compared_matches(
    bronze: DataFrame, silver: DataFrame, suspects: DataFrame | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """Two levels: reconciled rows of the matches whose prints agree, and rows of each event id of all others.

    Event ids are shuffled for matches that differ, and for ``suspects`` (``match_id``), if there are any.
    """
    prints = cut_lineage(set_prints(bronze, silver))
    others = prints.where("NOT same").select("match_id")
    if suspects is not None:
        others = others.unionByName(suspects.select("match_id")).distinct()
    others = settled(others.withColumnRenamed("match_id", "other_id"))
    listed = F.col("match_id").eqNullSafe(F.col("other_id"))
    none = F.lit(0).cast("long")
    agreeing = prints.join(others, listed, "left_anti").select(
        "match_id", "bronze_rows", "silver_rows", none.alias("missing_ids"), none.alias("unexpected_ids"), F.lit(True).alias("reconciled"))
    if others.isEmpty():
        return agreeing, None
    return agreeing, compared_ids(*(df.join(others, listed, "left_semi") for df in (bronze, silver)))


def compared_ids(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Rows of each event id on both sides."""
    return key_counts(bronze, silver, ["match_id", "event_id"])


def reconciled_ids(ids: DataFrame) -> DataFrame:
    counted = ids.groupBy("match_id").agg(
        F.sum("n_left").alias("bronze_rows"), F.sum("n_right").alias("silver_rows"),
        F.count_if((F.col("n_left") > 0) & (F.col("n_right") == 0)).alias("missing_ids"),
        F.count_if((F.col("n_left") == 0) & (F.col("n_right") > 0)).alias("unexpected_ids"),
    )
    agrees = (F.col("bronze_rows") == F.col("silver_rows")) & (
        F.col("missing_ids") + F.col("unexpected_ids") == 0
    )
    return counted.withColumn("reconciled", agrees)


def reconciliation_violations(reconciled: DataFrame) -> DataFrame:
    differing = F.greatest(
        F.abs(F.col("bronze_rows") - F.col("silver_rows")), F.col("missing_ids") + F.col("unexpected_ids")
    )
    return reconciled.where("NOT reconciled").select(
        "match_id", F.lit("bronze_silver_differ").alias("rule"), differing.alias("n")
    )


def quarantine(silver: DataFrame, violations: DataFrame) -> DataFrame:
    """Silver without the matches that break a rule; the others go on."""
    return without(silver, violations, ["match_id"], settle=True)


def match_status(silver: DataFrame, violations: DataFrame) -> DataFrame:
    """Every match with its row count, broken rules and verdict."""
    rows = silver.groupBy("match_id").agg(F.count("*").alias("events"))
    broken = violations.groupBy("match_id").agg(
        F.count("*").alias("broken_rules"), F.sum("n").alias("violations")
    )
    return rows.join(broken, "match_id", "left").select(
        "match_id", "events",
        F.coalesce("broken_rules", F.lit(0)).cast("long").alias("broken_rules"),
        F.coalesce("violations", F.lit(0)).cast("long").alias("violations"),
        F.when(F.col("broken_rules") > 0, "quarantined").otherwise("published").alias("status"),
    )


def fact_dim_references(fact: DataFrame, dim_match: DataFrame) -> DataFrame:
    """Match ids found on one side only."""
    counts = key_counts(fact, dim_match, ["match_id"]).where("match_id IS NOT NULL")
    return counts.where("n_left = 0 OR n_right = 0").select(
        "match_id",
        F.when(F.col("n_left") == 0, "missing_from_fact").otherwise("unknown_in_fact").alias("problem"),
    )


def reconcile_gold_team(gold: DataFrame, silver: DataFrame) -> DataFrame:
    """Teams whose Gold numbers differ from Silver, or that are on one side only."""
    keys = ["match_id", "team_id"]
    counted = silver.where(F.col("team_id").isNotNull()).groupBy(*keys).agg(
        F.count_if("is_shot").alias("silver_shots"),
        F.count_if("is_completed_pass").alias("silver_completed_passes"),
        F.sum(F.when(F.col("is_shot"), F.coalesce("shot_xg", F.lit(0.0)))).alias("silver_xg"),
    )
    claimed = gold.select(
        *keys, F.col("shots").alias("gold_shots"), F.col("completed_passes").alias("gold_completed_passes"),
        F.col("xg").alias("gold_xg"),
    )
    both = claimed.join(counted, keys, "full")
    same_xg = F.col("gold_xg").eqNullSafe(F.col("silver_xg")) | F.coalesce(
        F.abs(F.col("gold_xg") - F.col("silver_xg")) <= XG_TOLERANCE, F.lit(False)
    )
    same = (
        F.col("gold_shots").eqNullSafe(F.col("silver_shots"))
        & F.col("gold_completed_passes").eqNullSafe(F.col("silver_completed_passes")) & same_xg
    )
    return both.where(~same)


def dim_match_violations(dim_match: DataFrame) -> DataFrame:
    """Missing and duplicated match ids."""
    missing = checks.row_rules(dim_match, {"match_id_missing": F.col("match_id").isNull()})
    return missing.unionByName(checks.unique(dim_match.where("match_id IS NOT NULL"), ["match_id"], "match_id_duplicated"))


def require_dim_match(dim_match: DataFrame) -> DataFrame:
    """Stop on an empty, incomplete or ambiguous match dimension."""
    missing = [n for n in schemas.DIM_MATCH.fieldNames() if n not in dim_match.columns]
    if missing:
        raise ValueError(f"dim_match is missing columns: {missing}")
    if dim_match.isEmpty():
        raise ValueError("dim_match is empty.")
    broken = dim_match_violations(dim_match)
    if not broken.isEmpty():
        raise ValueError("dim_match has missing or duplicated match ids; see dim_match_violations().")
    return dim_match


def gold_team_invariants(gold: DataFrame) -> DataFrame:
    return checks.row_rules(gold, {
        "goals_above_shots": F.col("goals") > F.col("shots"),
        "completed_above_attempted": F.col("completed_passes") > F.col("attempted_passes"),
        "progressive_above_completed": F.col("progressive_passes") > F.col("completed_passes"),
    })


def interval_boundaries(intervals: DataFrame) -> DataFrame:
    return checks.row_rules(intervals, {"interval_start_off_grid": F.col("interval_start") % fv.INTERVAL_MINUTES != 0})


def net_xt(intervals: DataFrame) -> DataFrame:
    gap = F.abs(F.col("positive_xt") + F.col("negative_xt") - F.col("net_xt"))
    return checks.row_rules(intervals, {"net_xt_differs": gap > NET_XT_TOLERANCE})


def team_fact_violations(team: DataFrame, silver: DataFrame) -> DataFrame:
    """All rules of the team fact, before it is published; ``silver``: the rows it was made from."""
    out = checks.range_violation
    differing = reconcile_gold_team(team, silver).groupBy("match_id").agg(F.count("*").alias("n"))
    return checks.all_of(
        gold_team_invariants(team),
        checks.row_rules(team, {
            "shots_accepted_range": out("shots", 0), "xg_accepted_range": out("xg", 0),
            "pass_completion_pct_accepted_range": out("pass_completion_pct", 0, 100),
        }),
        checks.rows_per_match(team, 2, "not_two_teams"),
        checks.unique(team, ["match_id", "team_id"], "team_unique"),
        differing.select("match_id", F.lit("gold_silver_differ").alias("rule"), "n"),
    )


def interval_fact_violations(intervals: DataFrame) -> DataFrame:
    """All rules of the interval fact, before it is published."""
    out = checks.range_violation
    return checks.all_of(
        interval_boundaries(intervals), net_xt(intervals),
        checks.row_rules(intervals, {
            "positive_xt_accepted_range": out("positive_xt", 0),
            "negative_xt_accepted_range": out("negative_xt", None, 0),
        }),
        checks.rows_per_match(intervals, 40, "not_forty_intervals"),
        checks.unique(intervals, ["match_id", "team_id", "period", "interval_start", "is_stoppage_time"], "interval_unique"),
    )


def gold_ranges(team: DataFrame, intervals: DataFrame) -> DataFrame:
    out = checks.range_violation
    return checks.all_of(
        checks.row_rules(team, {
            "shots_accepted_range": out("shots", 0), "xg_accepted_range": out("xg", 0),
            "pass_completion_pct_accepted_range": out("pass_completion_pct", 0, 100),
        }),
        checks.row_rules(intervals, {
            "positive_xt_accepted_range": out("positive_xt", 0),
            "negative_xt_accepted_range": out("negative_xt", None, 0),
        }),
    )


def gold_not_null(team: DataFrame, intervals: DataFrame, enriched: DataFrame) -> DataFrame:
    def named(prefix: str, violations: DataFrame) -> DataFrame:
        return violations.withColumn("rule", F.concat(F.lit(f"{prefix}."), "rule"))

    return checks.all_of(
        named("team", checks.not_null(team, "match_id", "team_id")),
        named("intervals", checks.not_null(
            intervals, "match_id", "team_id", "period", "interval_start", "is_stoppage_time"
        )),
        named("enriched", checks.not_null(
            enriched, "match_id", "team_id", "team_name", "goals", "match_date", "venue", "opponent"
        )),
    )


def serving_not_null(silver: DataFrame, dim_match: DataFrame) -> DataFrame:
    """NOT NULL columns of the serving tables."""
    return checks.all_of(
        checks.not_null(
            silver, "match_id", "event_id", "event_index", "period", "minute", "second", "event_type",
            "is_pass", "is_carry", "is_shot", "is_completed_pass", "is_progressive_pass", "is_successful_move",
        ),
        checks.not_null(
            dim_match, "match_id", "match_date", "home_team_id", "home_team_name", "away_team_id",
            "away_team_name",
        ),
    )


def gold_unique(team: DataFrame, intervals: DataFrame) -> DataFrame:
    return checks.all_of(
        checks.unique(team, ["match_id", "team_id"], "team_unique"),
        checks.unique(
            intervals, ["match_id", "team_id", "period", "interval_start", "is_stoppage_time"],
            "interval_unique",
        ),
    )
