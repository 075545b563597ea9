"""Column helpers for hashes, keys and JSON text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def fingerprint(content: Column) -> Column:
    """SHA-256 of the whole content, as lower-case hex."""
    return F.sha2(content, 256)


def short_hash(file_hash: Column) -> Column:
    return F.substring(file_hash, 1, 12)


def artifact_key(layer: str, match_id: Column, file_hash: Column, suffix: str) -> Column:
    return F.format_string(
        f"{layer}/match_id=%d/events_%s.{suffix}", match_id.cast("long"), short_hash(file_hash)
    )


def json_list(items: str) -> Column:
    """JSON text of a string array column; a missing array is the text ``null``."""
    # A quoted string never begins or ends with a bracket, so trimming is exact.
    return F.expr(f"""
        coalesce(concat('[', array_join(
            transform({items}, x -> trim(BOTH '[]' FROM to_json(array(x)))), ', '), ']'), 'null')
    """)


def trim_to_null(value: Column) -> Column:
    return F.nullif(F.trim(value), F.lit(""))
