"""Column helpers for five-minute intervals."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pitchlake import fixed_values as fv


def period_minute(period: Column, minute: Column) -> Column:
    return F.when(period == 1, minute).otherwise(minute - fv.STOPPAGE_SLOT)


def is_stoppage(period: Column, minute: Column) -> Column:
    return ((period == 1) & (minute >= 45)) | ((period == 2) & (minute >= 90))


def interval_start(minute_in_period: Column, stoppage: Column) -> Column:
    # Cut down to a multiple of the width; % keeps the sign, so this truncates.
    slot = minute_in_period - minute_in_period % fv.INTERVAL_MINUTES
    return F.when(stoppage, F.lit(fv.STOPPAGE_SLOT)).otherwise(slot)


def interval_label(period: Column, start: Column, stoppage: Column) -> Column:
    shift = F.when(period == 1, start).otherwise(start + 45)
    span = F.concat(shift.cast("string"), F.lit("-"), (shift + fv.INTERVAL_MINUTES).cast("string"))
    end = F.when(period == 1, F.lit("45+")).otherwise(F.lit("90+"))
    return F.when(stoppage, end).otherwise(span)


def match_minute(minute: Column, second: Column) -> Column:
    return minute + second / F.lit(60.0)
