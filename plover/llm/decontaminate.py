"""Benchmark decontamination: an FM-index per training shard, searched backward for every benchmark window.

A shard is the part of a task's documents held in memory at a time.  Words that
stand in no benchmark window next to the same neighbour cannot be part of a match;
they only separate runs, so the index of a shard holds the remaining runs, each
ended by its own separator.  All windows are searched backward at once through
the ranks of a wavelet matrix, occurrences are located by walking to sampled
suffix positions, and the covered words merge into removal spans.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plover.llm.common import ALNUM_WORD, ASCII_LOWER, free_name, row_chunks, text_bytes, words

SHARD_BYTES = 1 << 20
BLOCK_BYTES = 32 << 20  # benchmark text searched per pass; more text means more passes, in blocks
SAMPLE = 8  # every so many positions of a run keep their suffix position


class Wavelet:
    """Wavelet matrix of a symbol sequence: rank and access by one bit plane per symbol bit."""

    def __init__(self, seq: np.ndarray, top: int):
        self.planes, self.zeros, self.bits = [], [], max(1, int(top).bit_length())
        for b in range(self.bits - 1, -1, -1):
            bit = (seq >> b) & 1
            self.planes.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int32))
            self.zeros.append(len(seq) - int(self.planes[-1][-1]))
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often the symbol stands before position ``at``."""
        low = np.zeros(len(symbol), np.int64)
        for k, (plane, zeros) in enumerate(zip(self.planes, self.zeros, strict=True)):
            one = (symbol >> (self.bits - 1 - k)) & 1 == 1
            a, z = plane[at].astype(np.int64), plane[low].astype(np.int64)
            at, low = np.where(one, zeros + a, at - a), np.where(one, zeros + z, low - z)
        return at - low

    def access(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at), np.int64)
        for plane, zeros in zip(self.planes, self.zeros, strict=True):
            a = plane[at].astype(np.int64)
            one = plane[at + 1] > a
            out = out * 2 + one
            at = np.where(one, zeros + a, at - a)
        return out


def suffix_order(rank: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; runs end in symbols of their own, so ties stop there."""
    n, step = len(rank), 1
    while True:
        ahead = np.zeros(n, np.int64)
        ahead[:-step] = rank[step:] + 1
        key = rank * (n + 2) + ahead
        order = np.argsort(key, kind="stable")
        key = key[order]
        fresh = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        if fresh[-1] == n - 1 or step >= n:
            return order
        step *= 2


class FMIndex:
    """Index of runs over symbols 1..top; a 0 ends every run."""

    def __init__(self, seq: np.ndarray, top: int):
        self.n, ends = len(seq), seq == 0
        count = int(ends.sum())
        rank = seq + count
        rank[ends] = np.arange(count)
        compact = np.unique(rank, return_inverse=True)[1]
        order = suffix_order(compact.astype(np.int64))
        before = seq[order - 1]  # the symbol of position -1 is the last separator
        self.less = np.concatenate([[0], np.cumsum(np.bincount(seq, minlength=top + 1))])
        self.wavelet = Wavelet(before, top)
        since = np.arange(self.n)
        start = np.concatenate([[0], np.flatnonzero(ends)[:-1] + 1])
        since -= start[np.cumsum(ends) - ends]
        kept = (since % SAMPLE == 0)[order]
        self.sampled = kept
        self.position = order[kept]
        self.before = np.concatenate([[0], np.cumsum(kept)])

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrase, low, high) of the phrases (rows of symbols) that occur."""
        which = np.arange(len(phrases))
        last = phrases[:, -1]
        low, high = self.less[last], self.less[last + 1]
        for j in range(phrases.shape[1] - 2, -1, -1):
            live = low < high
            which, low, high = which[live], low[live], high[live]
            if not len(which):
                break
            c = phrases[which, j]
            low, high = self.less[c] + self.wavelet.rank(c, low), self.less[c] + self.wavelet.rank(c, high)
        live = low < high
        return which[live], low[live], high[live]

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix-array rows."""
        out, at, todo, steps = np.empty(len(rows), np.int64), rows.copy(), np.arange(len(rows)), 0
        while len(todo):
            found = self.sampled[at]
            out[todo[found]] = self.position[self.before[at[found]]] + steps
            todo, at = todo[~found], at[~found]
            c = self.wavelet.access(at)
            at = self.less[c] + self.wavelet.rank(c, at)
            steps += 1
        return out


class Phrases:
    """Distinct windows of benchmark items, by length, with the items that have them."""

    def __init__(self, ids: list[str | None], texts: pa.Array, size: int):
        data, offsets = text_bytes(texts)
        h, row, _ = words(ASCII_LOWER[data], offsets, ALNUM_WORD)
        self.vocabulary = np.unique(h)
        symbol = np.searchsorted(self.vocabulary, h) + 1
        self.top = len(self.vocabulary)
        self.ids = ids
        pair = (row[1:] == row[:-1])
        self.pairs = np.unique(symbol[:-1][pair] << 32 | symbol[1:][pair])
        self.alone = np.zeros(self.top + 1, bool)
        count = np.bincount(row, minlength=len(ids))
        first = np.concatenate([[0], np.cumsum(count)[:-1]])
        self.windows: dict[int, np.ndarray] = {}
        self.items: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for length in range(1, size + 1):
            some = np.flatnonzero(count == length) if length < size else np.flatnonzero(count >= size)
            if not len(some):
                continue
            number = count[some] - length + 1
            item = np.repeat(some, number)
            step = np.arange(len(item)) - np.repeat(np.cumsum(number) - number, number)
            start = first[item] + step
            found, inverse = np.unique(symbol[start[:, None] + np.arange(length)], axis=0, return_inverse=True)
            inverse = inverse.reshape(-1)
            by = np.argsort(inverse, kind="stable")
            self.windows[length] = found
            self.items[length] = (np.concatenate([[0], np.cumsum(np.bincount(inverse, minlength=len(found)))]), item[by])
            if length == 1:
                self.alone[found[:, 0]] = True

    def find(self, h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Flags of the covered words, and (row, item) pairs, of one shard."""
        hit = np.zeros(len(h), bool)
        none = np.zeros(0, np.int64)
        if not len(h) or not self.top:
            return hit, none, none
        at = np.minimum(np.searchsorted(self.vocabulary, h), self.top - 1)
        symbol = np.where(self.vocabulary[at] == h, at + 1, 0)
        both = (symbol[:-1] > 0) & (symbol[1:] > 0) & (row[1:] == row[:-1])
        where = np.flatnonzero(both)
        if len(where) and len(self.pairs):
            code = symbol[where] << 32 | symbol[where + 1]
            at = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
            where = where[self.pairs[at] == code]
        else:
            where = where[:0]
        joined = np.zeros(len(h), bool)  # this word and the next may stand side by side in a window
        joined[where] = True
        keep = joined | self.alone[symbol]
        keep[where + 1] = True
        source = np.flatnonzero(keep)
        if not len(source):
            return hit, none, none
        ends = ~joined[source]
        place = np.arange(len(source)) + np.cumsum(ends) - ends
        seq = np.zeros(len(source) + int(ends.sum()), np.int64)
        seq[place] = symbol[source]
        origin = np.zeros(len(seq), np.int64)
        origin[place] = source
        index = FMIndex(seq, self.top)
        cover = np.zeros(len(h) + 1, np.int64)
        rows, items = [none], [none]
        for length, windows in self.windows.items():
            which, low, high = index.search(windows)
            if not len(which):
                continue
            size = high - low
            spot = np.repeat(low - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            start = origin[index.locate(spot)]
            np.add.at(cover, start, 1)
            np.add.at(cover, start + length, -1)
            pair = np.unique(np.stack([np.repeat(which, size), row[start]], axis=1), axis=0)
            offset, item = self.items[length]
            n = offset[pair[:, 0] + 1] - offset[pair[:, 0]]
            take = np.repeat(offset[pair[:, 0]] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            rows.append(np.repeat(pair[:, 1], n))
            items.append(item[take])
        return np.cumsum(cover[:-1]) > 0, np.concatenate(rows), np.concatenate(items)


LEAK = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())), T.StructField("spans", T.BinaryType()),
])


def _without(texts: list, spans: np.ndarray, cut: np.ndarray) -> pa.Array:
    """The texts without their spans (rows ``cut[r]`` to ``cut[r + 1]`` of the array)."""
    for r in np.flatnonzero(np.diff(cut)).tolist():
        raw, kept, done = texts[r].encode(), [], 0
        for s, e in spans[cut[r]:cut[r + 1]].tolist():
            kept.append(raw[done:s])
            done = e
        texts[r] = b"".join([*kept, raw[done:]]).decode()
    return pa.array(texts, pa.string())


def _pass(docs: DataFrame, text_col: str, out: str, phrases, later: bool, remove: bool) -> DataFrame:
    """One block of benchmark items against all rows; ``later``: ``out`` holds the finds of earlier blocks.

    ``remove``: the spans are cut out of the text, and ``out`` is left away.
    """
    columns = [c for c in docs.columns if c != out]
    plain = docs.select(*columns).schema
    schema = plain if remove else T.StructType([*plain.fields, T.StructField(out, LEAK)])

    def run(batches):
        block = phrases.value
        for b in row_chunks(batches, text_col, SHARD_BYTES):
            data, offsets = text_bytes(b.column(text_col))
            h, row, (start, end) = words(ASCII_LOWER[data], offsets, ALNUM_WORD)
            hit, rows, items = block.find(h, row)
            found: list[set] = [set() for _ in range(b.num_rows)]
            for r, i in zip(rows.tolist(), items.tolist(), strict=True):
                if block.ids[i] is not None:
                    found[r].add(block.ids[i])
            if later:
                old = b.column(out)
                for r, x in enumerate(old.to_pylist()):
                    found[r].update(x["items"])
                    for s, e in np.frombuffer(x["spans"], np.int64).reshape(-1, 2) + offsets[r]:
                        hit |= (row == r) & (start < e) & (end > s)
            first = hit & ~np.concatenate([[False], hit[:-1] & (row[1:] == row[:-1])])[:len(hit)]
            last = hit & ~np.concatenate([hit[1:] & (row[1:] == row[:-1]), [False]])[:len(hit)]
            spans = np.stack([start[first], end[last]], axis=1) - offsets[row[first]][:, None]
            cut = np.searchsorted(row[first], np.arange(b.num_rows + 1))
            if remove:
                text = _without(b.column(text_col).to_pylist(), spans, cut)
                yield pa.RecordBatch.from_arrays([text if c == text_col else b.column(c) for c in columns], columns)
                continue
            leak = pa.StructArray.from_arrays([
                pa.array(np.bincount(row, minlength=b.num_rows)), pa.array(np.bincount(row[hit], minlength=b.num_rows)),
                pa.array([sorted(x) for x in found], pa.list_(pa.string())),
                pa.array([spans[cut[r]:cut[r + 1]].tobytes() for r in range(b.num_rows)], pa.binary()),
            ], ["n_words", "n_hit", "items", "spans"])
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in columns), leak], [*columns, out])

    return docs.mapInArrow(run, schema)


def scan_leaks(docs: DataFrame, benchmark: DataFrame, size: int = 10, text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", out: str | None = None,
               remove: bool = False) -> DataFrame:
    """``docs`` plus a struct: ``n_words``, ``n_hit``, ``items`` (sorted ids as text) and ``spans``.

    With ``remove``: ``docs`` with the spans cut out of the text instead.

    ``spans`` holds the removal spans as int64 pairs of byte offsets (end exclusive).
    A window is ``size`` consecutive words of an item, or the whole of a shorter one.
    Null or wordless text has no words; an item without words has no window; items
    with a null id still cover words but are not listed; repeated rows and repeated
    items change nothing; an empty table on either side gives no finds.  Benchmark
    text goes to the tasks in blocks of at most about ``BLOCK_BYTES`` (one item at
    least), one narrow pass over the documents each.
    """
    out = out or free_name(docs, "leak")
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("string").alias("id"), F.col(item_text_col).alias("text"))
    size_of = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-int(size_of) // BLOCK_BYTES))
    for k in range(blocks):
        part = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k)
        table = part.toArrow()
        phrases = spark.sparkContext.broadcast(
            Phrases(table.column("id").to_pylist(), table.column("text").combine_chunks(), size))
        docs = _pass(docs, text_col, out, phrases, later=k > 0, remove=remove and k == blocks - 1)
    return docs


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 10, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Per document: words, hit words, items with occurring windows and the digest of their ids (see ``scan_leaks``)."""
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    leak = scan_leaks(base, benchmark, size, out="leak")
    return leak.select("doc_id", "leak.n_words", "leak.n_hit", F.size("leak.items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("leak.items", ","), 256).alias("items_sha256"),
                       (F.col("leak.n_hit") > 0).alias("contaminated"))


def remove_leaks(docs: DataFrame, benchmark: DataFrame, size: int = 10, text_col: str = "text",
                 chars_col: str | None = None) -> DataFrame:
    """``docs`` with the removal spans cut out of the text (``chars_col``, if named, gets its new length)."""
    cut = scan_leaks(docs, benchmark, size, text_col, remove=True)
    if chars_col is None:
        return cut
    return cut.withColumn(chars_col, F.length(text_col).cast(docs.schema[chars_col].dataType))
