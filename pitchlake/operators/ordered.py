"""Ordered computations that stay balanced however skewed the keys are.

A plain window puts a whole group (or, without keys, the whole table) into one
task. Here rows are cut into blocks along the sort order, each block is handled
on its own, and what precedes a block is added from the small table of block
totals.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from pitchlake.session import cut_lineage


def range_blocks(df: DataFrame, order: list[str]) -> DataFrame:
    """Tag rows with ``_block``: ranges of ``order`` of about equal size.

    ``order`` should be unique, so that equal values cannot pile up in a block.
    The result is written to the checkpoint folder, because block borders come
    from sampling and must not change when a lost task is run again.
    """
    # At most spark.sql.shuffle.partitions blocks; adaptive execution merges small neighbours.
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_block", F.spark_partition_id())
    # The number of a row in its block is the lower part of Spark's id.
    ranged = ranged.withColumn("_nth_of_block", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    return cut_lineage(ranged)


def running_totals(
    df: DataFrame, keys: list[str], order: list[str], totals: dict[str, Column], block: Column | None = None
) -> DataFrame:
    """Add running sums of ``totals`` per ``keys`` along ``order`` (current row included).

    ``block`` may be a column that never decreases along ``order`` and cuts every
    group into pieces of bounded size; without it blocks are made by range.
    """
    named = df.select("*", *[value.alias(f"_{name}") for name, value in totals.items()])
    rows = range_blocks(named, keys + order) if block is None else named.withColumn("_block", block)
    # One struct as key: it compares NULLs as equal, and the join can use the window's partitioning.
    rows = rows.withColumn("_piece", F.struct(*keys, "_block"))
    if block is not None:
        # Totals and running sums share this one exchange, so the source is read once.
        rows = rows.repartition("_piece")
    pieces = rows.groupBy("_piece").agg(*[F.sum(f"_{n}").alias(f"_{n}") for n in totals])
    by_block = Window.partitionBy(*[f"_piece.{k}" for k in keys]).orderBy(F.col("_piece._block").asc_nulls_first())
    before = by_block.rowsBetween(Window.unboundedPreceding, -1)
    carried = pieces.select(
        F.col("_piece").alias("_at"), F.row_number().over(by_block).alias("_nth"),
        *[F.sum(f"_{n}").over(before).alias(f"_before_{n}") for n in totals],
    ).where("_nth > 1").drop("_nth")
    if block is None:
        # A block border is crossed by at most one group: fewer rows than blocks.
        carried = F.broadcast(carried)
    within = Window.partitionBy("_piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.select(*df.columns, "_piece", *[F.sum(f"_{n}").over(within).alias(f"_{n}") for n in totals])
    return local.join(carried, F.col("_piece") == F.col("_at"), "left").select(
        *df.columns,
        *[
            F.when(F.col(f"_before_{n}").isNull(), F.col(f"_{n}"))
            .otherwise(F.col(f"_before_{n}") + F.coalesce(f"_{n}", F.lit(0))).alias(n)
            for n in totals
        ],
    )


def numbered(df: DataFrame, order: list[str], name: str = "position") -> DataFrame:
    """Number all rows from 1 along ``order``, without a single-task sort."""
    rows = range_blocks(df, order)
    sizes = rows.groupBy("_block").agg(F.count("*").alias("_size"))
    # One row per block, so this window without keys is small.
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_block", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    return rows.join(F.broadcast(offsets), "_block").select(
        *df.columns, (F.col("_offset") + F.col("_nth_of_block") + 1).alias(name)
    )


def rolling(
    df: DataFrame, order: list[str], preceding: int,
    measures: dict[str, Callable[[WindowSpec], Column]], chunk: int = 50_000,
) -> DataFrame:
    """Measures over the ``preceding`` rows before each row, along ``order`` of the whole table.

    Rows are numbered and cut into chunks; the last rows of a chunk are also
    handed to the next one, where they serve as history only.
    """
    position = F.col("_position") - 1
    own = F.floor(position / chunk)
    rows = numbered(df, order, "_position").withColumn(
        "_chunk", F.explode(F.array_distinct(F.array(own, F.floor((position + preceding) / chunk))))
    )
    frame = Window.partitionBy("_chunk").orderBy("_position").rowsBetween(-preceding, -1)
    measured = rows.select("*", *[make(frame).alias(name) for name, make in measures.items()])
    return measured.where(F.col("_chunk") == own).drop("_chunk", "_position")


def latest(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key along ``order``.

    Spark limits each group inside the map tasks before it shuffles, so a hot
    key sends only one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")
