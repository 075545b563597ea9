"""Expected threat: grid cells and values of a move."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pitchlake import fixed_values as fv

GRID_SCHEMA = "model_version string, row int, col int, value double"


def _cell(value: Column, size: float, cells: int) -> Column:
    scaled = value / F.lit(size) * F.lit(cells)
    # Clamp first: positions far off the pitch must not overflow the cast.
    clamped = F.least(F.greatest(scaled, F.lit(0.0)), F.lit(float(cells - 1)))
    return F.when(value.isNotNull(), clamped.cast("int"))


def grid_col(x: Column) -> Column:
    return _cell(x, fv.PITCH_LENGTH, fv.XT_COLUMNS)


def grid_row(y: Column) -> Column:
    return _cell(y, fv.PITCH_WIDTH, fv.XT_ROWS)


def check_grid(grid: list[list[float]]) -> list[list[float]]:
    if len(grid) != fv.XT_ROWS:
        raise ValueError("Invalid xT grid row count.")
    if any(len(row) != fv.XT_COLUMNS for row in grid):
        raise ValueError("Invalid xT grid column count.")
    return grid


def grid_value(grid: list[list[float]], x: Column, y: Column) -> Column:
    """Value of the cell under (x, y), from the 96-cell grid held as a literal."""
    cells = ", ".join(f"{float(v)!r}D" for row in check_grid(grid) for v in row)
    return F.get(F.expr(f"array({cells})"), grid_row(y) * fv.XT_COLUMNS + grid_col(x))


def grid_frame(
    spark: SparkSession, grid: list[list[float]], model_version: str = fv.XT_MODEL_VERSION
) -> DataFrame:
    """The grid in long form: one row per cell."""
    cells = [
        (model_version, r, c, float(v))
        for r, row in enumerate(check_grid(grid))
        for c, v in enumerate(row)
    ]
    return spark.createDataFrame(cells, GRID_SCHEMA)


def read_grid(spark: SparkSession, path: str, model_version: str = fv.XT_MODEL_VERSION) -> DataFrame:
    """Read a grid file (a JSON array of arrays) in long form and check its shape."""
    raw = spark.read.text(path, wholetext=True)
    rows = raw.select(F.posexplode(F.from_json("value", "array<array<double>>")).alias("row", "cells"))
    long = rows.select(
        F.lit(model_version).alias("model_version"), "row", F.posexplode("cells").alias("col", "value")
    )
    shape = long.groupBy("row").agg(F.count("*").alias("n"), F.max("col").alias("last")).agg(
        F.count("*").alias("rows"),
        F.count_if((F.col("n") != fv.XT_COLUMNS) | (F.col("last") != fv.XT_COLUMNS - 1)).alias("bad"),
    ).first()
    if shape["rows"] != fv.XT_ROWS:
        raise ValueError("Invalid xT grid row count.")
    if shape["bad"]:
        raise ValueError("Invalid xT grid column count.")
    return long


def grid_from_frame(long: DataFrame) -> list[list[float]]:
    """The 96 cells of one model version as nested lists, to be used as a literal.

    Raises unless ``long`` holds exactly these cells, each once and with a value.
    """
    inside = F.col("row").between(0, fv.XT_ROWS - 1) & F.col("col").between(0, fv.XT_COLUMNS - 1)
    complete = F.coalesce(inside & F.col("value").isNotNull(), F.lit(False))
    seen = long.agg(
        F.count("*").alias("rows"), F.count_if(complete).alias("complete"),
        F.count_distinct(F.struct("row", "col")).alias("cells"), F.count_distinct("model_version").alias("versions"),
    ).first()
    wanted = fv.XT_ROWS * fv.XT_COLUMNS
    if (seen["rows"], seen["complete"], seen["cells"], seen["versions"]) != (wanted, wanted, wanted, 1):
        raise ValueError(f"Invalid xT grid: {wanted} cells of one model version are needed, got {seen.asDict()}.")
    grid = [[0.0] * fv.XT_COLUMNS for _ in range(fv.XT_ROWS)]
    for cell in long.collect():  # 96 rows, as just counted
        grid[cell["row"]][cell["col"]] = cell["value"]
    return grid


def rate_moves_by_join(moves: DataFrame, grids: DataFrame, model_versions: list[str]) -> DataFrame:
    """Rate moves against several model versions side by side.

    ``grids`` holds 96 rows per listed version, so both lookups are broadcast.
    """
    used = grids.where(F.col("model_version").isin(model_versions))
    cells = moves.select(
        "*", F.explode(F.array(*[F.lit(v) for v in model_versions])).alias("model_version"),
        grid_row(F.col("start_y")).alias("start_row"), grid_col(F.col("start_x")).alias("start_col"),
        grid_row(F.col("end_y")).alias("end_row"), grid_col(F.col("end_x")).alias("end_col"),
    )
    start = used.select(
        "model_version", F.col("row").alias("start_row"), F.col("col").alias("start_col"),
        F.col("value").alias("start_value"),
    )
    end = used.select(
        "model_version", F.col("row").alias("end_row"), F.col("col").alias("end_col"),
        F.col("value").alias("end_value"),
    )
    rated = cells.join(F.broadcast(start), ["model_version", "start_row", "start_col"], "left").join(
        F.broadcast(end), ["model_version", "end_row", "end_col"], "left"
    )
    both = F.col("start_value").isNotNull() & F.col("end_value").isNotNull()
    return rated.select(
        *moves.columns, "model_version", "start_row", "start_col", "end_row", "end_col",
        F.when(both, F.col("start_value")).alias("xt_start"),
        F.when(both, F.col("end_value")).alias("xt_end"),
        (F.col("end_value") - F.col("start_value")).alias("xt_added"),
    )
