"""Words and hashes of Arrow text columns, a few MB at a time, with numpy.

A word is a maximal run of ASCII digits, ASCII letters (A-Z lower-cased) and bytes of non-ASCII code points, that is
`[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the lower-cased text: no byte of a longer UTF-8 sequence is below 0x80."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 18  # numpy needs some fifty times as much for a moment
UPPER, LOWER_CASE = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[48:58] = IS_WORD[97:123] = IS_WORD[128:] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_tables: dict[tuple, Any] = {}


def free_name(df, stem: str) -> str:
    """A column name that `df` does not have."""
    taken, name = {c.lower() for c in df.columns}, f"__{stem}"
    while name in taken:
        name += "_"
    return name


def plain_names(df):
    """`df` with other names for columns whose names would need quotes, and the function that gives theirs back."""
    odd = {c: f"__odd{i}" for i, c in enumerate(df.columns) if "." in c or "`" in c}
    if not odd:
        return df, lambda out: out
    given = {new: c for c, new in odd.items()}
    return df.toDF(*[odd.get(c, c) for c in df.columns]), lambda out: out.toDF(*[given.get(c, c) for c in out.columns])


def text_key(text: Column) -> list[Column]:
    """128 bits that stand for a text (a null is an empty text)."""
    text = F.coalesce(text, F.lit(""))
    return [F.xxhash64(text), F.xxhash64(F.lit(1), text)]


def schema_of(df) -> str:
    """The columns of `df` as a schema string."""
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema.fields)


def worker_tables(key: tuple, make: Callable[[], Any]) -> Any:
    """Large tables of an operator, which a Python worker makes once and keeps for its next tasks. A worker has one set at a time, and none
    once it works on texts for an operator that needs none (`text_chunks`): Spark gives idle workers to any operator."""
    if key not in _tables:
        _tables.clear()
        _tables[key] = make()
    return _tables[key]


def row_chunks(batch: pa.RecordBatch, at: int, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows whose values in column `at` have at most `limit` bytes together; a larger value comes alone. An entry of a
    list counts as the 32 bytes of a Python integer."""
    column = batch.column(at)
    listed = pa.types.is_list(column.type)
    size = pc.fill_null(pc.list_value_length(column) if listed else pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    size = size.astype(np.int64) * (32 if listed else 1)
    until, row = np.cumsum(size), 0
    while row < len(size):
        end = max(row + 1, int(np.searchsorted(until, until[row] - size[row] + limit, "right")))
        yield batch.slice(row, end - row)
        row = end


def add_in_arrow(rows, column: str, run: Callable[[pa.Array], list[pa.Array]], new: dict[str, str]):
    """`rows` with new columns (name: type) that `run` makes of the values of one column, some at a time. Any column names do."""
    at, plain = rows.columns.index(column), rows.toDF(*[f"c{i}" for i in range(len(rows.columns))])
    names = [*plain.columns, *[f"n{i}" for i in range(len(new))]]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_chunks(batch, at):
                yield pa.RecordBatch.from_arrays([*part.columns, *run(part.column(at))], names)

    added = ", ".join(f"n{i} {kind}" for i, kind in enumerate(new.values()))
    return plain.mapInArrow(work, f"{schema_of(plain)}, {added}").toDF(*rows.columns, *new)


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows of at most `limit` bytes; a longer text comes alone."""
    _tables.clear()
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, int(n).bit_length())
    if size not in _powers:
        _powers.clear()
        tables = []
        for base in (_BASE, _INVERSE):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            tables.append(np.multiply.accumulate(steps))
        _powers[size] = tuple(tables)
    return _powers[size]


@dataclass
class Words:
    """All words of a chunk: byte ranges, the row each belongs to, and 64-bit hashes."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    hashes: np.ndarray
    counts: np.ndarray
    firsts: np.ndarray  # of each row, its first word; one more entry at the end

    def text(self, i: int) -> str:
        return self.data[self.starts[i] : self.ends[i]].tobytes().decode("utf-8", "replace")


def words_of(raw: np.ndarray, offsets: np.ndarray) -> Words:
    data = LOWER[raw]
    inside = IS_WORD[data]
    rows = len(offsets) - 1
    before = np.zeros(len(data) + 1, dtype=bool)
    before[1:] = inside
    edge = offsets[:-1][offsets[:-1] < len(data)]
    before[edge] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    after = np.zeros(len(data) + 1, dtype=bool)
    after[:-1] = inside
    after[edge] = False
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    owner = np.searchsorted(offsets, starts, "right") - 1
    counts = np.bincount(owner, minlength=rows)
    power, inverse = _power_tables(len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * inverse[starts])
    firsts = np.zeros(rows + 1, dtype=np.int64)
    np.cumsum(counts, out=firsts[1:])
    return Words(data, starts, ends, owner, hashes, counts, firsts)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k consecutive words (also of runs across rows, which the caller leaves out)."""
    n = max(0, len(hashes) - k + 1)
    out = np.full(n, k, dtype=np.uint64)
    for j in range(k):
        out = out * np.uint64(_BASE) + hashes[j : j + n]
    return mix(out)


def runs_inside(rows: np.ndarray, k: int) -> np.ndarray:
    """Of each run of k words, whether one row has all of it."""
    n = max(0, len(rows) - k + 1)
    return rows[:n] == rows[k - 1 : k - 1 + n]
