"""Helpers shared by the training-data operators: written intermediates and byte-level numpy text tools."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from plover.session import fresh_path

BASE_A = 0x9E3779B97F4A7C15  # odd multipliers of the two polynomial hashes
BASE_B = 0xD6E8FEB86659FD93
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the cluster's shared folder and read it back: cuts lineage and survives lost executors.

    Unlike an eager ``checkpoint()``, the plan runs once and the files are compressed and columnar.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem = "_" + stem
    return stem


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary column (UTF-8), concatenated, and the row offsets; null rows are empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def row_chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose ``column`` holds at most ``limit`` bytes (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch.column(column))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def spans(flags: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every maximal run of set flags; runs never cross a row offset."""
    if not len(flags):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before, after = np.zeros(len(flags), bool), np.zeros(len(flags), bool)
    before[1:], after[:-1] = flags[:-1], flags[1:]
    inner = offsets[(offsets > 0) & (offsets < len(flags))]
    before[inner] = False
    after[inner - 1] = False
    return np.flatnonzero(flags & ~before), np.flatnonzero(flags & ~after) + 1


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` modulo 2**64 for i < n."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        def run(b):
            out = np.full(max(n, 1 << 16), b, np.uint64)
            out[0] = 1
            return np.multiply.accumulate(out)

        have = _POWERS[base] = (run(base), run(pow(base, -1, 1 << 64)))
    return have


def prefix_hash(data: np.ndarray, base: int = BASE_A) -> np.ndarray:
    """Running polynomial sums; ``span_hash`` reads the hash of any span off them."""
    up, _ = powers(base, len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=out[1:])
    return out


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (every input bit reaches every output bit)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASE_A) -> np.ndarray:
    """64-bit hashes of the spans; equal bytes give equal hashes wherever they stand."""
    _, down = powers(base, len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts])


def words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, row and start of each maximal run of word bytes (``data`` already lower-cased where wanted)."""
    starts, ends = spans(is_word[data], offsets)
    row = np.searchsorted(offsets, starts, "right") - 1
    return span_hash(prefix_hash(data), starts, ends), row, np.stack([starts, ends])


def byte_class(excluded: list[tuple[int, int]]) -> np.ndarray:
    """Boolean table of the bytes outside the inclusive ranges."""
    table = np.ones(256, bool)
    for low, high in excluded:
        table[low:high + 1] = False
    return table


#: [^\x20\x09-\x0D]+
SPACED_WORD = byte_class([(0x20, 0x20), (0x09, 0x0D)])
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
ALNUM_WORD = byte_class([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])
