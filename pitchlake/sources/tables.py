"""Parquet datasets: parts by run, and small datasets with a folder per match."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


def write_part(df: DataFrame, path: str, key: str) -> int:
    """Write one run's part of a dataset; repeating the run overwrites just that.

    No shuffle: files of a match reach the writer together, as they were read.
    Returns the row count, taken during the write.
    """
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("overwrite").parquet(f"{path}/run_key={key}")
    return seen.get["rows"]


def append_part(df: DataFrame, path: str, key: str) -> None:
    """Add rows to one run's part; what is there stays."""
    df.write.mode("append").parquet(f"{path}/run_key={key}")


def read_part(spark: SparkSession, path: str, key: str) -> DataFrame:
    """One run's part; other parts are not even listed."""
    return spark.read.parquet(f"{path}/run_key={key}")


def replace_matches(df: DataFrame, path: str, key: str = "match_id") -> int:
    """Replace whole matches of a dataset: only the partitions in ``df`` change.

    For serving copies of up to some ten thousand matches; the warehouse itself
    keeps commits, which need no folder per match. Rebalancing gathers each
    match into few files and splits hot ones.
    """
    seen = Observation()
    (
        df.hint("rebalance", F.col(key)).observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)
    )
    return seen.get["rows"]


def register_serving_views(spark: SparkSession, **paths: str) -> None:
    """Register Parquet datasets as temporary views for ad-hoc SQL."""
    for name, path in paths.items():
        spark.read.parquet(path).createOrReplaceTempView(name)
