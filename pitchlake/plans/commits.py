"""Versioned datasets whose matches are replaced as a whole: several writers, pinned reads, compaction, expiry.

A commit writes its rows into a folder of its own, checks and lists them by match, and then claims the next number by making a
file that must not exist yet. Between the state it started from and the number it gets, no other commit may have listed one of its
matches; otherwise it is refused and nothing of it is seen.

A base is the state after some commit, folded: the folders to read and the (match, folder) pairs in them. Reads start
from the last base before their pin and add the commits since. A base changes no state, so it never stands in a writer's way.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Callable
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from pitchlake.operators.keyed import only, settled, without
from pitchlake.session import cut_lineage
from pitchlake.sources import claims

LISTING = "match_id long, file_hash string, source_version int, rows long, published boolean, commit_seq int, part string"
INDEX = "match_id long, file_hash string, source_version int, file_name string, rows long, part string"
KEYS = "commit_seq int, commit_key string, committed_at timestamp"
#: Files that a read by match opens one by one, at most; beyond, it opens whole folders.
FILES = 10_000


class CommitConflict(RuntimeError):
    """Another writer has replaced some of the same matches since this commit's state was read."""

    def __init__(self, matches: list[int]):
        super().__init__(f"replaced by another commit meanwhile: matches {matches}")
        self.matches = matches


def hidden(match_commits: DataFrame, by: str = "commit_seq") -> DataFrame:
    """(match, ``by``) pairs not to be read: replaced later, or held back by a check."""
    newest = match_commits.where("published").groupBy("match_id").agg(F.max("commit_seq").alias("newest"))
    return match_commits.join(newest, "match_id", "left").where(
        F.coalesce(~F.col("published") | (F.col("commit_seq") < F.col("newest")), F.lit(True))
    ).select("match_id", by)


def pinned(data: DataFrame, match_commits: DataFrame, as_of: int | None = None) -> DataFrame:
    """State after commit ``as_of`` (by default the last one).

    Only hidden matches are looked up. They are few next to the data, so they
    are counted first and normally broadcast: the data are not shuffled.
    """
    if as_of is not None:
        data = data.where(F.col("commit_seq") <= as_of)
        match_commits = match_commits.where(F.col("commit_seq") <= as_of)
    return without(data, hidden(match_commits), ["match_id", "commit_seq"], settle=True)


class CommitStore:
    """A dataset whose matches are replaced by appending commits; see above.

    ``data/part=P`` holds rows, ``files/part=P`` the matches of each of its files, ``matches/part=P`` the listing, and
    ``log`` a small file per commit and base. What is published never changes: repeating its key does nothing. A commit
    that failed half way is not seen; ``expire`` removes what it left. Matches that fail the check stay hidden, and their former
    version stays current.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    # -- the log --------------------------------------------------------------------

    def _numbers(self) -> tuple[list[int], list[int]]:
        """Numbers of the commits and of the bases whose log files exist."""
        found: dict[str, list[int]] = {"commit": [], "base": []}
        for name in claims.names(self.spark, f"{self.path}/log"):
            kind, _, rest = name.partition("-")
            if kind in found:
                found[kind].append(int(rest.removesuffix(".json")))
        return sorted(found["commit"]), sorted(found["base"])

    def _entries(self, kind: str, numbers: list[int]) -> list[dict[str, Any]]:
        """Log files in order: one small record for each commit since the last base."""
        return [json.loads(claims.text(self.spark, f"{self.path}/log/{kind}-{n:020d}.json")) for n in numbers]

    def _claim(self, kind: str, number: int, **record: Any) -> bool:
        now = datetime.now(timezone.utc).isoformat()
        content = json.dumps({"commit_seq": number, "committed_at": now, **record})
        return claims.claim(self.spark, f"{self.path}/log", f"{kind}-{number:020d}.json", content)

    def last(self) -> int:
        commits, bases = self._numbers()
        return max([0, *commits, *bases])

    def _since_base(self, as_of: int | None = None) -> tuple[dict[str, Any] | None, list[dict[str, Any]]]:
        """The base to start from and the commits after it, up to ``as_of``."""
        commits, bases = self._numbers()
        if as_of is not None:
            commits, bases = ([n for n in x if n <= as_of] for x in (commits, bases))
        base = max(bases, default=0)
        wanted = [n for n in commits if n > base]
        if wanted != list(range(base + 1, base + 1 + len(wanted))) or (as_of is not None and as_of > 0 and not wanted and not base and self.last()):
            raise ValueError(f"commit {as_of} is older than what is kept")
        found = self._entries("base", [base] if base else [])
        return (found[0] if found else None), self._entries("commit", wanted)

    def _read(self, part: str, schema: str, parts: list[str], merge: bool = False) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.option("basePath", f"{self.path}/{part}")
        if not merge:
            reader = reader.schema(schema)
        return reader.parquet(*[f"{self.path}/{part}/part={p}" for p in parts])

    def _listing(self, base: dict[str, Any] | None, entries: list[dict[str, Any]]) -> DataFrame:
        """(match, part) pairs of a base and the commits after it."""
        own = LISTING.replace("commit_seq int, ", "")
        numbers = self.spark.createDataFrame([(e["part"], e["commit_seq"]) for e in entries], "part string, commit_seq int")
        rows = self._read("matches", own, [e["part"] for e in entries]).join(F.broadcast(numbers), "part")
        rows = rows.select(*_names(LISTING))
        if base is not None:
            folded = self.spark.read.schema(LISTING).parquet(f"{self.path}/bases/{base['part']}")
            rows = folded.unionByName(rows)
        return rows

    def commits(self) -> DataFrame:
        """Every commit, also those whose rows are no longer kept."""
        base, entries = self._since_base()
        rows = self.spark.createDataFrame(
            [(e["commit_seq"], e["commit_key"], datetime.fromisoformat(e["committed_at"])) for e in entries], KEYS)
        if base is not None:
            rows = self.spark.read.schema(KEYS).parquet(f"{self.path}/keys/{base['part']}").unionByName(rows)
        return rows

    def published(self, commit_key: str) -> int | None:
        """The commit of a key, if it is visible."""
        base, entries = self._since_base()
        own = [e["commit_seq"] for e in entries if e["commit_key"] == commit_key]
        if own or base is None:
            return max(own, default=None)
        folded = self.spark.read.schema(KEYS).parquet(f"{self.path}/keys/{base['part']}")
        return folded.where(F.col("commit_key") == commit_key).agg(F.max("commit_seq").alias("own")).first()["own"]

    def match_commits(self, as_of: int | None = None) -> DataFrame:
        """Matches by commit since the last base; before it, those that the base still reads."""
        return self._listing(*self._since_base(as_of)).drop("part")

    def listing(self, seq: int) -> DataFrame:
        """The matches of one commit, while its log file is kept."""
        return self._listing(None, self._entries("commit", [seq])).drop("part")

    # -- writing ----------------------------------------------------------------------

    def commit(
        self, df: DataFrame, commit_key: str, check: Callable[[DataFrame], DataFrame] | None = None,
        matches: DataFrame | None = None, based_on: int | None = None,
    ) -> int:
        """Publish new contents for the matches in ``df``; returns the commit number.

        ``check`` gets the written rows and returns violations by match. ``matches`` may list further matches that are
        replaced by nothing. A ``commit_key`` that is published already gives its number and changes nothing. ``based_on`` is the state
        that ``df`` was derived from, by default the last one now. If another writer has listed one of the matches since, this
        raises ``CommitConflict``; commits of other matches are no obstacle.
        """
        own = self.published(commit_key)
        if own is not None:
            return own
        seen = self.last() if based_on is None else based_on
        part = uuid.uuid4().hex
        df.write.parquet(f"{self.path}/data/part={part}")
        written = self._written(part)
        index = self._write_index(written, part)
        listed = index.groupBy("match_id", "file_hash").agg(
            F.max("source_version").alias("source_version"), F.sum("rows").alias("rows"))
        if matches is not None:
            listed = matches.select("match_id").distinct().join(listed, "match_id", "left")
        if check is None:
            listed = listed.withColumn("published", F.lit(True))
        else:
            bad = check(written).select("match_id").distinct().withColumn("bad", F.lit(True))
            listed = listed.join(bad, "match_id", "left").withColumn("published", F.col("bad").isNull()).drop("bad")
        listed.write.parquet(f"{self.path}/matches/part={part}")
        while True:
            last = self.last()
            if last > seen:
                own = self.published(commit_key)
                if own is not None:
                    return own
                self._refuse_conflicts(part, seen, last)
                seen = last
            if self._claim("commit", last + 1, commit_key=commit_key, part=part):
                return last + 1

    def _write_index(self, written: DataFrame, part: str) -> DataFrame:
        """Rows by match and file: the only look at the written rows, and only at three columns of them."""
        # Datasets without sources, such as the match dimension, have no version or hash.
        for name, kind in (("file_hash", "string"), ("source_version", "int")):
            if name not in written.columns:
                written = written.withColumn(name, F.lit(None).cast(kind))
        rows = written.groupBy("match_id", "file_hash", F.col("_metadata.file_name").alias("file_name")).agg(
            F.max("source_version").alias("source_version"), F.count("*").alias("rows"))
        rows.write.parquet(f"{self.path}/files/part={part}")
        return self.spark.read.schema(INDEX.replace(", part string", "")).parquet(f"{self.path}/files/part={part}")

    def _refuse_conflicts(self, part: str, seen: int, last: int) -> None:
        commits, _ = self._numbers()
        newer = [n for n in range(seen + 1, last + 1)]
        if not set(newer) <= set(commits):
            raise ValueError(f"commit {seen + 1} is older than what is kept")
        mine = self._read("matches", LISTING.replace("commit_seq int, ", ""), [part]).select("match_id").distinct()
        theirs = self._listing(None, self._entries("commit", newer)).select("match_id")
        shared = only(mine, theirs, ["match_id"]).orderBy("match_id").limit(20).collect()
        if shared:
            raise CommitConflict([r["match_id"] for r in shared])

    # -- reading ----------------------------------------------------------------------

    def _written(self, part: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/data/part={part}")

    def written(self, seq: int) -> DataFrame:
        """All rows of one commit, also those held back."""
        return self._written(self._entries("commit", [seq])[0]["part"])

    def _state(self, as_of: int | None = None) -> tuple[list[str], DataFrame]:
        """The folders to read, and the listing of what is in them."""
        base, entries = self._since_base(as_of)
        parts = (list(base["parts"]) if base else []) + [e["part"] for e in entries]
        if not parts:
            raise ValueError("no commit is published")
        return parts, self._listing(base, entries)

    def read(self, as_of: int | None = None, matches: DataFrame | None = None) -> DataFrame:
        """State after commit ``as_of``; earlier pins keep giving the same rows, as long as they are kept.

        With ``matches`` (``match_id``) only their rows, out of the files that hold some of them.
        """
        parts, listing = self._state(as_of)
        paths = [f"{self.path}/data/part={p}" for p in parts]
        if matches is not None:
            matches = settled(matches.select("match_id"))
            listing = listing.join(matches, "match_id", "left_semi")
        gone = settled(hidden(listing, "part"))
        if matches is not None:
            index = self._read("files", INDEX, parts).join(matches, "match_id", "left_semi")
            index = index.join(gone, ["match_id", "part"], "left_anti")
            named = index.select("part", "file_name").distinct().limit(FILES + 1).collect()
            if not named:
                return self._written(parts[0]).limit(0)
            if len(named) <= FILES:
                paths = [f"{self.path}/data/part={r['part']}/{r['file_name']}" for r in named]
        data = self.spark.read.option("basePath", f"{self.path}/data").parquet(*paths)
        if matches is not None:
            data = data.join(matches, "match_id", "left_semi")
        return data.join(gone, ["match_id", "part"], "left_anti").drop("part")

    # -- maintenance --------------------------------------------------------------------

    def compact(self, small_rows: int = 10_000_000, live_share: float = 0.5, file_rows: int = 1_000_000) -> int:
        """Fold the state after the last commit into a base; returns that commit's number.

        Folders of fewer than ``small_rows`` rows, or with fewer than ``live_share`` of theirs still current, are rewritten
        into one, in files of ``file_rows`` rows that lie in order of matches. All other folders stay as they are. Writers may
        go on meanwhile; of two compactions of one state, one counts.
        """
        base, entries = self._since_base()
        seq = max([base["commit_seq"] if base else 0, *(e["commit_seq"] for e in entries)])
        if not entries:
            return seq
        parts, listing = self._state(seq)
        listing = cut_lineage(listing)
        gone = settled(hidden(listing, "part"))
        live = cut_lineage(listing.where("published AND rows > 0").join(gone, ["match_id", "part"], "left_anti"))
        count = lambda rows: {r["part"]: r["n"] for r in rows.groupBy("part").agg(F.sum("rows").alias("n")).collect()}  # noqa: E731  one row per folder
        written, current = count(listing), count(live)
        size = {p: written.get(p) or 0 for p in parts}
        stays = [p for p in parts if size[p] >= small_rows and (current.get(p) or 0) >= live_share * size[p]]
        rewritten, part = [p for p in parts if p not in stays], uuid.uuid4().hex
        kept = live.where(F.col("part").isin(stays))
        held = listing.join(gone, ["match_id", "part"], "left_semi").where(F.col("part").isin(stays))
        if rewritten:
            rows = self._read("data", "", rewritten, merge=True)
            rows = rows.join(gone, ["match_id", "part"], "left_anti").drop("part")
            files = max(1, math.ceil(sum(current.get(p) or 0 for p in rewritten) / file_rows))
            # the hash lets a match of very many rows span several files
            order = F.xxhash64(*[F.col(f"`{c}`") for c, kind in rows.dtypes if not kind.startswith("map")])
            rows.repartitionByRange(files, "match_id", order).sortWithinPartitions("match_id").write.parquet(f"{self.path}/data/part={part}")
            self._write_index(self._written(part), part)
            moved = live.where(~F.col("part").isin(stays)).withColumn("part", F.lit(part))
            kept, stays = kept.unionByName(moved), [*stays, part]
        # pairs that stay in a folder but are not to be read keep a row each, as not published
        kept = kept.unionByName(held.withColumn("published", F.lit(False)))
        kept.select(*_names(LISTING)).write.parquet(f"{self.path}/bases/{part}")
        self.commits().where(F.col("commit_seq") <= seq).write.parquet(f"{self.path}/keys/{part}")
        self._claim("base", seq, part=part, parts=stays)
        return seq

    def expire(self, keep_from: int, grace_seconds: float = 86_400) -> list[str]:
        """Remove what only reads of states before ``keep_from`` need; returns the folders removed.

        States from ``keep_from`` on stay readable, and at least the last. Log files go first, so that no new read starts from what is
        about to go. Folders that no log file names, as a failed or refused commit leaves them, go once they are older
        than ``grace_seconds``, which must exceed the time of a commit and of a read.
        """
        commits, bases = self._numbers()
        first = max((b for b in bases if b <= keep_from), default=0)
        known = {e["part"] for e in self._entries("commit", commits)} | {p for e in self._entries("base", bases) for p in (e["part"], *e["parts"])}
        for kind, numbers, bound in (("commit", commits, first + 1), ("base", bases, first)):
            for n in numbers:
                if n < bound:
                    claims.remove(self.spark, f"{self.path}/log/{kind}-{n:020d}.json")
        commits, bases = [n for n in commits if n > first], [b for b in bases if b >= first]
        folded = self._entries("base", bases)
        needed = {e["part"] for e in self._entries("commit", commits)} | {p for e in folded for p in (e["part"], *e["parts"])}
        removed, oldest = [], (time.time() - grace_seconds) * 1000
        for folder in ("data", "files", "matches", "bases", "keys"):
            for name, changed in claims.names(self.spark, f"{self.path}/{folder}").items():
                part = name.removeprefix("part=")
                if part not in needed and (part in known or changed < oldest):
                    claims.remove(self.spark, f"{self.path}/{folder}/{name}")
                    removed.append(f"{folder}/{name}")
        return removed


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]
