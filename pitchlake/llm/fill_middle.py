"""Fill-in-middle transformation of whole documents with piece tables.

A document is never copied while it is cut and arranged: it is a list of descriptors (buffer, start, length) over two immutable
buffers, the text itself and the sentinels. Cutting splits a descriptor, an arrangement permutes the list, the inverse permutation
restores it, and hashes read the descriptors' slices one after the other. Only ``output`` and ``restored`` texts, if asked for, are
joined. Every row is handled by itself, so there is no shuffle; a lost executor's rows are computed again with the same result, as
the choices depend on the key alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEXT, SENTINEL = 0, 1
#: Sentinels of prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
#: Order of the descriptors in each form: 0 to 2 are prefix, middle and suffix; 3 to 5 the sentinels of prefix, suffix and middle.
ARRANGEMENTS = {"psm": (3, 0, 4, 2, 5, 1), "spm": (4, 2, 3, 0, 5, 1)}
PIECES = "array<struct<buffer:int,start:bigint,length:bigint>>"


class PieceTable:
    """Descriptors over immutable byte buffers."""

    def __init__(self, buffers: Sequence[bytes | memoryview], pieces: list[tuple[int, int, int]]):
        self.buffers, self.pieces = buffers, pieces

    def cut(self, at: int) -> int:
        """Split the list at byte ``at`` of what it describes; the number of the first descriptor behind the cut."""
        for k, (buffer, start, length) in enumerate(self.pieces):
            if at <= length:
                self.pieces[k : k + 1] = [(buffer, start, at), (buffer, start + at, length - at)]
                return k + 1
            at -= length
        raise ValueError("the cut is behind the end")

    def arranged(self, order: Sequence[int]) -> PieceTable:
        return PieceTable(self.buffers, [self.pieces[k] for k in order])

    def restored(self, order: Sequence[int]) -> PieceTable:
        """The list that ``arranged(order)`` was made from."""
        return self.arranged(np.argsort(order).tolist())

    def slices(self) -> Iterator[memoryview]:
        for buffer, start, length in self.pieces:
            yield memoryview(self.buffers[buffer])[start : start + length]

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for part in self.slices():
            digest.update(part)
        return digest.hexdigest()

    def joined(self) -> bytes:
        return b"".join(self.slices())


def checked(sentinels: Sequence[str]) -> tuple[bytes, bytes, bytes]:
    """The sentinels as bytes, if one can't begin inside another: then none arises where two pieces meet."""
    found = tuple(s.encode() for s in sentinels)
    if len(found) != 3 or not all(found) or len(set(found)) < 3 or any(
            a.endswith(b[:n]) and (a is not b or n < len(a)) for a in found for b in found for n in range(1, len(b) + 1)):
        raise ValueError("three different sentinels are needed, none of which begins inside another")
    return found


def _whole(buffer: bytes | memoryview, sentinels: Sequence[bytes]) -> PieceTable:
    return PieceTable((buffer, b"".join(sentinels)), [(TEXT, 0, len(buffer))])


def transform(data: bytes | memoryview, first: int, second: int, form: str, sentinels: Sequence[bytes]) -> PieceTable:
    """``data`` cut at the byte offsets ``first`` <= ``second`` and arranged."""
    table = _whole(data, sentinels)
    if form != "plain":
        table.cut(second)
        table.cut(first)
        at = 0
        for sentinel in sentinels:
            table.pieces.append((SENTINEL, at, len(sentinel)))
            at += len(sentinel)
        table = table.arranged(ARRANGEMENTS[form])
    return table


def invert(output: bytes | memoryview, form: str, sentinels: Sequence[bytes]) -> PieceTable:
    """The text behind ``output``: cut at its sentinels, put into the old order, sentinels left out."""
    table = _whole(output, sentinels)
    if form != "plain":
        data = bytes(output)
        order, at = ARRANGEMENTS[form], 0
        for k in (order[0], order[2], order[4]):
            at = data.index(sentinels[k - 3], at)
            if at:
                table.cut(at)
            at += len(sentinels[k - 3])
            table.cut(at)
        table = table.restored(order)
        table.pieces = table.pieces[:3]
    return table


def _characters(data: memoryview) -> int:
    return int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80))


def _choices(key: Column, seed: str) -> list[Column]:
    """Four numbers below 2**32 that depend on the key alone; a null key counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def _kept(keep: list[str], made: Sequence[str]) -> Column:
    if clash := set(keep) & set(made):
        raise ValueError(f"kept columns have names of the result: {sorted(clash)}")
    return F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept")


def _schema(rows: DataFrame, made: str) -> T.StructType:
    return T.StructType([rows.schema["kept"], *T.StructType.fromDDL(made).fields])


def _flat(df: DataFrame, keep: list[str], made: Sequence[str]) -> DataFrame:
    return df.select(*[F.col("kept").getField(c).alias(c) for c in keep], *made)


def fill_in_middle(
    documents: DataFrame, key: str = "doc_id", text: str = "text", keep: Sequence[str] | None = None, seed: str = "7",
    percent: int = 100, spm_percent: int = 50, sentinels: Sequence[str] = SENTINELS, with_output: bool = False,
) -> DataFrame:
    """The kept columns (the key), ``n`` lines, ``form``, ``prefix_chars``, ``middle_chars``, ``pieces``, ``output_sha256``.

    A text is cut before two of its lines, chosen by a hash of the key, and becomes psm (prefix, suffix, middle) or spm (suffix,
    prefix, middle), each part behind its sentinel. It stays plain if it is null (read as empty), empty, holds a sentinel, or its key
    is outside ``percent``; then both counts are null. Parts may be empty. Rows with equal keys get equal choices, equal rows equal
    results; a null key counts as an empty one; an empty table gives no rows. A text is read whole, whatever its length. Columns that
    are not kept may have any names; kept ones may not have those of the result. ``with_output`` adds the ``output`` text.
    """
    keep, marks = list(keep or [key]), checked(sentinels)
    made = ["n", "form", "prefix_chars", "middle_chars", "pieces", "output_sha256", *(["output"] if with_output else [])]
    kept = _kept(keep, made)
    rows = documents.select(kept, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"), *_choices(F.col(f"`{key}`"), seed))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            texts = batch.column(1).cast(pa.large_binary())
            for value, h1, h2, h3, h4 in zip(texts, *(batch.column(c).to_pylist() for c in range(2, 6))):
                whole = value.as_py()
                data = memoryview(whole)
                ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10) + 1
                if len(data) and (len(ends) == 0 or ends[-1] < len(data)):
                    ends = np.append(ends, len(data))
                n = len(ends)
                if n == 0 or h3 % 100 >= percent or any(mark in whole for mark in marks):
                    form, first, second, sizes = "plain", 0, 0, (None, None)
                else:
                    form = "spm" if h4 % 100 < spm_percent else "psm"
                    first, second = (int(ends[k - 1]) if k else 0 for k in sorted((h1 % (n + 1), h2 % (n + 1))))
                    sizes = _characters(data[:first]), _characters(data[first:second])
                table = transform(data, first, second, form, marks)
                pieces = [dict(zip(("buffer", "start", "length"), p)) for p in table.pieces]
                found.append((n, form, *sizes, pieces, table.sha256(), *((table.joined().decode(),) if with_output else ())))
            columns = list(zip(*found)) or [()] * len(made)
            types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), _PIECES, pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types))], names=["kept", *made])

    result = f"n long, form string, prefix_chars long, middle_chars long, pieces {PIECES}, output_sha256 string"
    return _flat(rows.mapInArrow(apply, _schema(rows, result + (", output string" if with_output else ""))), keep, made)


_PIECES = pa.list_(pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("length", pa.int64())]))


def restore(
    arranged: DataFrame, output: str = "output", form: str = "form", keep: Sequence[str] = ("doc_id",),
    sentinels: Sequence[str] = SENTINELS, with_text: bool = True,
) -> DataFrame:
    """The kept columns, ``restored_sha256`` and, unless told otherwise, the ``restored`` text, from output and form alone.

    A null output is read as empty; a form other than psm and spm leaves the output as it is. Rows are handled one by one, equal
    ones alike and long ones whole; an empty table gives no rows. An output without its form's sentinels is an error, as it can't
    come from ``fill_in_middle``.
    """
    keep, marks = list(keep), checked(sentinels)
    made = ["restored_sha256", *(["restored"] if with_text else [])]
    kept = _kept(keep, made)
    known = F.when(F.col(f"`{form}`").isin(*ARRANGEMENTS), F.col(f"`{form}`")).otherwise("plain")
    rows = arranged.select(kept, F.coalesce(F.col(f"`{output}`"), F.lit("")).alias("output"), known.alias("form"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for value, name in zip(batch.column(1).cast(pa.large_binary()), batch.column(2).to_pylist()):
                table = invert(memoryview(value.as_buffer()), name, marks)
                found.append((table.sha256(), *((table.joined().decode(),) if with_text else ())))
            columns = list(zip(*found)) or [()] * len(made)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.string()) for c in columns)], names=["kept", *made])

    result = "restored_sha256 string" + (", restored string" if with_text else "")
    return _flat(rows.mapInArrow(apply, _schema(rows, result)), keep, made)
