"""Generic quality rules.

Every rule returns its violations as (match_id, rule, n), so that results of
different rules can be united and a bad match can be set aside on its own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from pitchlake.operators.keyed import key_counts


def violated(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def row_rules(df: DataFrame, rules: dict[str, Column], key: str = "match_id") -> DataFrame:
    """Count rows breaking each rule, all rules in one pass; a NULL condition passes."""
    counted = df.groupBy(key).agg(*[F.count_if(violated(c)).alias(name) for name, c in rules.items()])
    return as_rows(counted, list(rules), key)


def as_rows(counted: DataFrame, rules: list[str], key: str = "match_id") -> DataFrame:
    """One row per key and broken rule from one count column per rule."""
    entries = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("n")) for r in rules])
    return counted.select(F.col(key).alias("match_id"), F.inline(entries)).where("n > 0")


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    return row_rules(df, {f"{c}_not_null": F.col(c).isNull() for c in columns})


def accepted_values(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    return row_rules(df, {f"{column}_accepted_values": ~F.col(column).isin(values)})


def range_violation(column: str, low: float | None = None, high: float | None = None) -> Column:
    below = F.col(column) < low if low is not None else F.lit(False)
    above = F.col(column) > high if high is not None else F.lit(False)
    return below | above


def accepted_range(df: DataFrame, column: str, low: float | None = None, high: float | None = None) -> DataFrame:
    """NULL passes; the bounds are accepted."""
    return row_rules(df, {f"{column}_accepted_range": range_violation(column, low, high)})


def unique(df: DataFrame, columns: list[str], rule: str) -> DataFrame:
    """Rows that share a key combination with another one."""
    keys = list(dict.fromkeys(["match_id", *columns]))
    return (
        df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
        .groupBy("match_id").agg(F.sum("n").alias("n"))
        .select("match_id", F.lit(rule).alias("rule"), "n")
    )


def rows_per_match(df: DataFrame, expected: int, rule: str) -> DataFrame:
    """Matches whose number of rows differs; ``n`` is that number."""
    return (
        df.groupBy("match_id").agg(F.count("*").alias("n")).where(F.col("n") != expected)
        .select("match_id", F.lit(rule).alias("rule"), "n")
    )


def relationships(child: DataFrame, parent: DataFrame, rule: str) -> DataFrame:
    """Child rows whose match is not in the parent."""
    counts = key_counts(child.where(F.col("match_id").isNotNull()), parent, ["match_id"])
    return counts.where("n_left > 0 AND n_right = 0").select(
        "match_id", F.lit(rule).alias("rule"), F.col("n_left").alias("n")
    )


def all_of(*violations: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, violations)
