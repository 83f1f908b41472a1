"""Cutting the row tuples out of captured messages, a batch at a time.

A tuple is a column count (two bytes) and per column a marker byte, followed for
text by a length (four bytes) and the bytes. Where a cell begins depends on all
cells before it, so the walk goes column by column over all rows of an Arrow
batch at once. Everything after it is column expressions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

CELL_LIST = "array<struct<m: string, t: binary>>"
TUPLES = f"struct<one: {CELL_LIST}, two: {CELL_LIST}, cut: boolean, plain: boolean>"

_TEXT = ord("t")
_ROW_KINDS = [ord(kind) for kind in "IUD"]
_OLD_MARKS = [ord(mark) for mark in "KO"]

# bytes that are neither control characters, quote, backslash nor beyond ASCII
_PLAIN = np.zeros(256, dtype=bool)
_PLAIN[0x20:0x7F] = True
_PLAIN[[ord('"'), ord("\\")]] = False


def _number(data: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    value = np.zeros(len(at), dtype=np.int64)
    for i in range(width):
        value = (value << 8) | data[at + i]
    return value


class _Walk:
    """Cells of one tuple per row: where they are and where the tuple ends."""

    def __init__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, has: np.ndarray):
        fits = has & (start + 2 <= end)
        count = np.zeros(len(start), dtype=np.int64)
        count[fits] = _number(data, start[fits], 2)
        # every cell takes at least one byte: a larger count cannot be true
        fits &= count <= end - start - 2
        count[~fits] = 0

        first = np.concatenate(([0], np.cumsum(count)))
        marker = np.zeros(first[-1], dtype=np.uint8)
        begin = np.zeros(first[-1], dtype=np.int64)
        size = np.zeros(first[-1], dtype=np.int64)
        at = np.where(fits, start + 2, start)
        rows = np.flatnonzero(count)
        column = 0
        while len(rows):
            inside = at[rows] < end[rows]
            fits[rows[~inside]] = False
            rows = rows[inside]
            mark = data[at[rows]]
            cell = first[rows] + column
            marker[cell] = mark
            at[rows] += 1
            is_text = mark == _TEXT
            long, cell = rows[is_text], cell[is_text]
            inside = at[long] + 4 <= end[long]
            fits[long[~inside]] = False
            long, cell = long[inside], cell[inside]
            length = _number(data, at[long], 4)
            begin[cell] = at[long] + 4
            size[cell] = length
            at[long] += 4 + length
            fits[long[at[long] > end[long]]] = False
            column += 1
            rows = rows[fits[rows] & (count[rows] > column)]
        self.has, self.fits, self.after = has, fits, at
        self._cells = (data, first, marker, begin, size)

    def to_arrow(self) -> tuple[pa.Array, np.ndarray]:
        """The cells as lists, and for each row whether all its text is plain."""
        data, first, marker, begin, size = self._cells
        # cells of rows that did not fit stay empty and are never read
        is_text = marker == _TEXT
        readable = np.repeat(self.fits, np.diff(first))
        size = np.where(is_text & readable, size, 0)
        ends = np.concatenate(([0], np.cumsum(size)))
        taken = np.arange(ends[-1]) + np.repeat(begin - ends[:-1], size)
        texts = pa.Array.from_buffers(
            pa.binary(),
            len(marker),
            [
                pa.array(is_text).buffers()[1],
                pa.py_buffer(ends.astype(np.int32)),
                pa.py_buffer(data[taken]),
            ],
        )
        odd = np.concatenate(([0], np.cumsum(~_PLAIN[data[taken]])))
        row_ends = odd[ends[first]]
        plain = row_ends[1:] == row_ends[:-1]
        shown = np.where(marker < 128, marker, ord("?")).astype(np.uint8)
        markers = pa.Array.from_buffers(
            pa.string(),
            len(marker),
            [None, pa.py_buffer(np.arange(len(marker) + 1, dtype=np.int32)), pa.py_buffer(shown)],
        )
        cells = pa.ListArray.from_arrays(
            pa.array(first.astype(np.int32)),
            pa.StructArray.from_arrays([markers, texts], ["m", "t"]),
            mask=pa.array(~(self.has & self.fits)),
        )
        return cells, plain


def cut_tuples(payload: pa.Array) -> pa.Array:
    """``struct<one, two, cut, plain>`` per row message.

    ``two`` is the new tuple of an update that also carries its old one. Other
    messages, and updates and deletes that end after the relation id, have
    neither. ``cut`` marks a message that ends too early, ``plain`` one whose text
    needs no JSON escape at all.
    """
    payload = payload.cast(pa.large_binary())
    _, spots, content = payload.buffers()
    offsets = np.frombuffer(spots, dtype=np.int64)[
        payload.offset : payload.offset + len(payload) + 1
    ]
    data = np.frombuffer(content, dtype=np.uint8) if content else np.zeros(0, dtype=np.uint8)
    start, end = offsets[:-1], offsets[1:]

    def byte_at(place: np.ndarray, within: np.ndarray) -> np.ndarray:
        found = np.zeros(len(place), dtype=np.uint8)
        ok = within & (place < end)
        found[ok] = data[place[ok]]
        return found

    everywhere = np.ones(len(payload), dtype=bool)
    kind = byte_at(start, everywhere)
    is_row = np.isin(kind, _ROW_KINDS)
    ends_early = end - start <= 5
    has = is_row & ~(ends_early & (kind != ord("I")))
    one = _Walk(data, start + 6, end, has)

    with_old = has & (kind == ord("U")) & np.isin(byte_at(start + 5, has), _OLD_MARKS)
    more = with_old & one.fits & (one.after < end)
    has_new = more & (byte_at(one.after, more) == ord("N"))
    two = _Walk(data, one.after + 1, end, has_new)

    cut = (has & ~one.fits) | (has_new & ~two.fits) | (more & ~has_new)
    first, first_plain = one.to_arrow()
    second, second_plain = two.to_arrow()
    return pa.StructArray.from_arrays(
        [first, second, pa.array(cut), pa.array(first_plain & second_plain)],
        ["one", "two", "cut", "plain"],
    )


def row_tuples(payload: Column) -> Column:
    """The tuples of each message, see ``cut_tuples``."""
    return F.arrow_udf(cut_tuples, TUPLES)(payload)
