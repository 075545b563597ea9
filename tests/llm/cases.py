"""Small tables with the awkward rows that every operator has to handle."""

from __future__ import annotations

import duckdb
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"

#: Null and repeated ids, null, empty and blank texts, repeated rows, a text of one word, a very long one.
AWKWARD = [
    (None, "a text without an id", "en", None, 20), (1, None, None, "s", None), (2, "", "en", "s", 0), (3, " \n\t ", "en", "s", 4),
    (4, "word", "en", "s", 4), (5, "the same row twice", "en", "s", 18), (5, "the same row twice", "en", "s", 18),
    (6, "one id", "en", "s", 6), (6, "for two texts", "en", "s", 13), (7, "long " * 40_000, "en", "s", 200_000),
    (8, "tie of one", "en", "s", 10), (9, "tie of one", "en", "s", 10),
]


def awkward(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(AWKWARD, DOCUMENTS)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DOCUMENTS)


def with_clashes(df: DataFrame, *names: str) -> DataFrame:
    """``df`` with extra columns of names that operators use inside."""
    for name in names:
        df = df.withColumn(name, F.lit("extra"))
    return df


def documents(spark: SparkSession, sf_dir: str, most: int = 100_000) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").where(F.length("text") <= most)


def texts(sf_dir: str) -> dict[int, str]:
    return dict(duckdb.connect().execute(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall())
