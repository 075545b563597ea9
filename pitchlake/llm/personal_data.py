"""Personal data by fixed forms, and by contexts learned from them (bootstrapping).

The fixed forms (mail and network addresses, card and phone numbers) give the seed entities. The two words before a seed are a
lexical pattern; every token that looks like an identifier and follows some pattern is an instance of it. Spark scores
this graph in rounds: a pattern is as good as its instances, and an instance as good as the best of its other patterns. Patterns
that many different seeds support and that hardly ever precede anything else then find identifiers that no form describes.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitchlake.llm.storage import stored

KINDS = ("email", "ip", "card", "phone")
#: Different seed instances that a pattern needs, and the confidence from which on it finds new ones.
MIN_SEEDS, CONFIDENCE, ROUNDS = 5, 0.9, 3
#: An identifier has at least so many digits or an at sign, and at most so many characters (the limit of mail addresses).
DIGITS, LONGEST = 5, 254
# The forms of the base entities.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_HINT = re.compile(r"[0-9]+|@|\(at\)|\[at\]")
_EDGE = ".,;:!?\"'()[]{}<>|*#$%&="


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of every base entity, sorted; each kind leftmost and without overlaps of its own."""
    found = [(a, 0, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, m.group())) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def context(text: str, start: int) -> str:
    """The two words before a place, without case, digits and punctuation; empty if there are none."""
    words = [w.strip(_EDGE).lower() for w in text[max(0, start - 80) : start].split()]
    return " ".join(re.sub(r"[0-9]+", "0", w) for w in [w for w in words if w][-2:])


def candidates(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Tokens that look like identifiers and touch no base entity."""
    last, k = 0, 0
    by_end = sorted((b, a) for a, _, b in base)
    for hint in _HINT.finditer(text):
        if hint.start() < last:
            continue
        start, end = hint.start(), hint.end()
        while start > last and not text[start - 1].isspace():
            start -= 1
        while end < len(text) and not text[end].isspace():
            end += 1
        last = end
        while start < end and text[start] in _EDGE:
            start += 1
        while end > start and text[end - 1] in _EDGE:
            end -= 1
        while k < len(by_end) and by_end[k][0] <= start:
            k += 1
        token = text[start:end]
        if any(a < end for _, a in by_end[k : k + 4]) or not 0 < len(token) <= LONGEST:
            continue
        if sum(map(str.isdigit, token)) >= DIGITS or any(x in token for x in ("@", "(at)", "[at]")):
            yield start, end


_SPAN = "struct<start: long, kind: int, end: long>"
_SEEN = "struct<pattern: string, instance: long, kind: int, start: long, end: long>"
_SPAN_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
_SEEN_ARROW = pa.list_(pa.struct([
    ("pattern", pa.string()), ("instance", pa.int64()), ("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))


def scan(documents: DataFrame, text: str) -> DataFrame:
    """All columns but the text, with ``_base`` (sorted spans) and ``_seen`` (seeds and candidates with their patterns)."""
    others = [c for c in documents.columns if c not in (text, "_base", "_seen")]

    def instance(value: str) -> int:
        return int.from_bytes(hashlib.blake2b(value.lower().encode(errors="replace"), digest_size=8).digest(), "little", signed=True)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, seen = [], []
            for value in batch.column(batch.num_columns - 1):
                value = value.as_py() or ""
                spans = base_spans(value)
                base.append([{"start": a, "kind": kind, "end": b} for a, kind, b in spans])
                tokens = [(a, kind, b) for a, kind, b in spans] + [(a, -1, b) for a, b in candidates(value, spans)]
                seen.append([
                    {"pattern": p, "instance": instance(value[a:b]), "kind": kind, "start": a, "end": b}
                    for a, kind, b in tokens if (p := context(value, a))])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(base, _SPAN_ARROW), pa.array(seen, _SEEN_ARROW)], names=[*others, "_base", "_seen"])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in documents.schema.fields if f.name in others)
    return documents.select(*[F.col(f"`{c}`") for c in others], F.col(f"`{text}`")).mapInArrow(
        read, f"{fields}_base array<{_SPAN}>, _seen array<{_SEEN}>")


def good_patterns(seen: DataFrame, min_seeds: int = MIN_SEEDS, confidence: float = CONFIDENCE, rounds: int = ROUNDS) -> DataFrame:
    """(``pattern``, ``found_kind``, ``confidence``) of patterns to trust. ``seen``: pattern, instance, kind (-1: no seed)."""
    edges = seen.groupBy("pattern", "instance").agg(F.max("kind").alias("kind"))
    seeded = edges.groupBy("pattern").agg(F.count(F.when(F.col("kind") >= 0, 1)).alias("seeds")).where(F.col("seeds") >= min_seeds)
    edges = stored(edges.join(seeded.select("pattern"), "pattern"), "edges")
    kinds = F.explode(F.array(*[F.lit(k) for k in range(len(KINDS))])).alias("k")
    by_kind = edges.select("pattern", "instance", "kind", kinds)
    scored = by_kind.withColumn("score", F.when(F.col("kind") == F.col("k"), 1.0).otherwise(0.0))
    for turn in range(rounds):
        patterns = stored(scored.groupBy("pattern", "k").agg(
            F.avg("score").alias("confidence"), F.count(F.when(F.col("kind") == F.col("k"), 1)).alias("seeds")), "patterns")
        if turn == rounds - 1:
            break
        trusted = patterns.where((F.col("seeds") >= min_seeds) & (F.col("confidence") >= 0.5))
        votes = edges.where("kind < 0").join(trusted.select("pattern", "k", "confidence"), "pattern")
        # the best vote, and the best of another pattern: no pattern believes an instance because of itself
        first = votes.groupBy("instance", "k").agg(F.max(F.struct("confidence", "pattern")).alias("first"))
        believed = votes.join(first, ["instance", "k"]).groupBy("instance", "k", "first").agg(
            F.max(F.when(F.col("pattern") != F.col("first.pattern"), F.col("confidence"))).alias("second"))
        other = F.when(F.col("first.pattern") == F.col("pattern"), F.col("second")).otherwise(F.col("first.confidence"))
        scored = by_kind.join(believed, ["instance", "k"], "left").select(
            "pattern", "instance", "kind", "k",
            F.when(F.col("kind") == F.col("k"), 1.0).when(F.col("kind") >= 0, 0.0).otherwise(F.coalesce(other, F.lit(0.0))).alias("score"))
    best = F.row_number().over(Window.partitionBy("pattern").orderBy(F.desc("confidence"), "k"))
    return patterns.where((F.col("seeds") >= min_seeds) & (F.col("confidence") >= confidence)).withColumn("best", best).where(
        "best = 1").select("pattern", F.col("k").alias("found_kind"), "confidence")


def personal_data(documents: DataFrame, text: str = "text", **limits: float) -> DataFrame:
    """Every row's columns without the text, with ``base`` and ``added``: sorted arrays of (start, kind number, end).

    Offsets count code points. A null or empty text has no spans. Repeated rows each get their spans.
    """
    scanned = scan(documents, text)
    others = [c for c in documents.columns if c not in (text, "base", "added", "_base", "_seen")]
    # the document's own columns stay in a struct, where their names can't clash
    doc = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in others]).alias("doc")
    scanned = stored(scanned.select(doc, "_base", "_seen", F.monotonically_increasing_id().alias("_row")), "spans")
    seen = scanned.where(F.size("_seen") > 0).select("_row", F.inline("_seen"))
    patterns = good_patterns(seen.select("pattern", "instance", "kind"), **limits)
    added = seen.where("kind < 0").join(patterns, "pattern").groupBy("_row").agg(
        F.array_sort(F.collect_set(F.struct("start", F.col("found_kind").alias("kind"), "end"))).alias("added"))
    empty = F.array().cast(f"array<{_SPAN}>")
    return scanned.join(added, "_row", "left").select(
        *[F.col(f"doc.`{c}`").alias(c) for c in others], F.col("_base").alias("base"), F.coalesce("added", empty).alias("added"))
