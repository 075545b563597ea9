"""SQL expressions for pitch geometry. All of them give NULL for NULL input."""

from __future__ import annotations

from pitchlake import fixed_values as fv


def metres_x(raw: str) -> str:
    # Keep divide-then-multiply: the order decides the last bit of the double.
    return f"{raw} / {fv.SOURCE_LENGTH}D * {fv.PITCH_LENGTH}D"


def metres_y(raw: str) -> str:
    return f"{raw} / {fv.SOURCE_WIDTH}D * {fv.PITCH_WIDTH}D"


def goal_distance(x: str, y: str) -> str:
    dx, dy = f"({fv.GOAL_X}D - {x})", f"({fv.GOAL_Y}D - {y})"
    return f"sqrt({dx} * {dx} + {dy} * {dy})"


def distance_gained(start: str, end: str) -> str:
    """Metres gained towards goal, from goal distances before and after."""
    return f"CASE WHEN {start} <> 0 THEN {start} - {end} END"


def progress_ratio(start: str, end: str) -> str:
    return f"CASE WHEN {start} <> 0 THEN ({start} - {end}) / {start} END"


def is_progressive(completed: str, ratio: str) -> str:
    return f"{completed} AND coalesce(({ratio}) >= {fv.PROGRESSIVE_RATIO}D, false)"
