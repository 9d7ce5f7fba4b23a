"""Spelling variant grouping: bit-sliced position index over the vocabulary, one edit at a time.

Words are counted on Spark with built-in functions.  Two words one edit apart share
their first or their last ``s`` letters, ``s`` being half of the shorter length, so
words meet in groups of equal beginnings or ends.  In a group the vocabulary is
bit-sliced: a bitset per (position, letter) holds the words with that letter there.
All words of one length run through the index together, letter by letter; four sets
per word are kept: no error so far, and one error with the positions in step (a
replaced letter), one ahead (an inserted one) or one behind (a deleted one).  A pair
is kept in one group only.  A group over ``GROUP_WORDS`` is dealt to index
shards that each see all words of the group stream past.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plover.llm.common import materialise, text_bytes

GROUP_WORDS = 8192  # words of an index; larger groups are dealt to several
BLOCK_WORDS = 2048  # words of small groups that share one index
SET_BYTES = 1 << 21  # bytes of one family of sets: bounds memory, not the result
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def runs(docs: DataFrame, id_col: str, text_col: str, least: int, noise: int) -> DataFrame:
    """(word) per run of at least ``least`` letters, one letter deleted where ``noise`` divides the run's checksum."""
    found = F.regexp_extract_all(F.col("text"), F.lit(f"([A-Za-zÀ-ÿ]{{{least},}}+)"), 1)
    run = F.col("run")
    plain = F.octet_length(run) == F.char_length(run)
    low = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text"))
    low = (low.select("id", F.explode(found).alias("run"))
           .select("id", F.when(plain, F.lower(run)).otherwise(F.translate(run, UPPER, LOWER)).alias("run")))
    if not noise:
        return low.select(run.alias("word"))
    hashed = low.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.char_length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return hashed.select(F.when(F.col("h") % noise == 0, cut).otherwise(run).alias("word"))


def vocabulary(docs: DataFrame, id_col: str, text_col: str, least: int, count: int, noise: int) -> DataFrame:
    """(word, n) of the words of at least ``least`` code points and ``count`` occurrences."""
    words = runs(docs, id_col, text_col, least, noise).filter(F.char_length("word") >= least)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= count)


def group_keys(word: Column, least: int) -> Column:
    """Array of (kind, s, hash): beginnings and ends of half the length, and of half the length of a shorter partner."""
    size = F.char_length(word)
    half, short = F.floor(size / 2).cast("int"), F.floor((size - 1) / 2).cast("int")

    def both(s: Column) -> list[Column]:
        return [F.struct(F.lit(0).alias("kind"), s.alias("s"), F.xxhash64(F.substring(word, F.lit(1), s)).alias("h")),
                F.struct(F.lit(1).alias("kind"), s.alias("s"), F.xxhash64(F.substring(word, size - s + 1, s)).alias("h"))]

    return F.when((short < half) & (size > least), F.array(*both(half), *both(short))).otherwise(F.array(*both(half)))


def letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """One byte per letter (its code point, all below 256) of a column of words, and the word offsets."""
    data, offsets = text_bytes(column)
    tail = (data >= 0x80) & (data < 0xC0)
    lead = data >= 0xC0
    before = np.concatenate([[0], np.cumsum(lead)])
    return np.where(tail, data + 0x40, data).astype(np.uint8)[~lead], offsets - before[offsets]


class PositionIndex:
    """Bitsets over a list of words: per (position, letter), per least length and per length."""

    def __init__(self, flat: np.ndarray, offsets: np.ndarray):
        self.size = np.diff(offsets)
        n = len(self.size)
        self.words = max(1, -(-n // 64))
        self.code, self.sets = [], []
        self.none = np.zeros(self.words, np.uint64)
        for p in range(int(self.size.max(initial=0))):
            own = np.flatnonzero(self.size > p)
            present, which = np.unique(flat[offsets[own] + p], return_inverse=True)
            bits = np.zeros((len(present) + 1, self.words * 64), bool)
            bits[which, own] = True
            code = np.full(256, len(present), np.int64)  # letters that no word has here: the empty set
            code[present] = np.arange(len(present))
            self.code.append(code)
            self.sets.append(self._pack(bits))

    @staticmethod
    def _pack(bits: np.ndarray) -> np.ndarray:
        return np.packbits(bits, axis=-1, bitorder="little").view(np.uint64)

    def at(self, p: int, letter: np.ndarray) -> np.ndarray:
        """Words with the given letters at position ``p``, one bitset per letter."""
        if not 0 <= p < len(self.sets):
            return np.zeros((len(letter), self.words), np.uint64)
        return self.sets[p][self.code[p][letter]]

    def where(self, mask: np.ndarray) -> np.ndarray:
        bits = np.zeros(self.words * 64, bool)
        bits[:len(mask)] = mask
        return self._pack(bits)

    def near(self, word: np.ndarray, s: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """(word, bitset) of the indexed words one edit from each word of one length.

        ``word`` is (words, length).  Kept are partners whose shorter length has
        half ``s`` and that share the first ``s`` letters (kind 0) or do not (kind 1).
        """
        q, m = word.shape
        same = np.zeros((q, self.words), np.uint64)
        exact = np.full((q, self.words), ~np.uint64(0))
        put, more, less = (np.zeros((q, self.words), np.uint64) for _ in range(3))
        for i in range(m):
            half = s == i
            if half.any():
                same[half] = exact[half]
            here, longer = self.at(i, word[:, i]), self.where(self.size > i)
            put = (put & here) | (exact & ~here & longer)
            more = (more | (exact & longer)) & self.at(i + 1, word[:, i])
            less = (less & self.at(i - 1, word[:, i])) | exact
            exact = exact & here
        more |= exact & self.where(self.size > m)
        near = (put & self.where(self.size == m)) | (more & self.where(self.size == m + 1))
        near[s != m // 2] = 0
        last = less & self.where(self.size == m - 1)
        last[s != (m - 1) // 2] = 0
        return (near | last) & np.where(kind[:, None] == 0, same, ~same)


def near_pairs(index: PositionIndex, index_group: np.ndarray, flat: np.ndarray, offsets: np.ndarray, s: np.ndarray,
               kind: np.ndarray, group: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, indexed word) positions of the pairs one edit apart within a group."""
    size = np.diff(offsets)
    step = max(1, SET_BYTES // (8 * index.words))
    for m in np.unique(size):
        rows = np.flatnonzero(size == m)
        for at in range(0, len(rows), step):
            own = rows[at:at + step]
            sets = index.near(flat[offsets[own][:, None] + np.arange(m)], s[own], kind[own])
            hit, word = np.nonzero(sets)
            bits = np.unpackbits(sets[hit, word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            which, bit = np.nonzero(bits)
            a, b = own[hit[which]], word[which] * 64 + bit
            keep = group[a] == index_group[b]
            yield a[keep], b[keep]


def links(words: DataFrame, least: int) -> DataFrame:
    """(word, near, near_n): every ordered pair of words one edit apart, once.  ``words`` is (word, n)."""
    keyed = words.select("word", "n", F.explode(group_keys(F.col("word"), least)).alias("k")).select("word", "n", "k.*")
    sizes = keyed.groupBy("kind", "s", "h").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    keyed = keyed.join(sizes, ["kind", "s", "h"])
    shards = F.ceil(F.col("size") / GROUP_WORDS).cast("int")
    own = F.pmod(F.xxhash64("word"), shards).cast("int")
    # a small group is index and query at once (turn 0); a large one has an index per shard, all its words come to each
    turns = F.when(shards == 1, F.array(F.struct(F.lit(0).alias("shard"), F.lit(0).alias("turn")))).otherwise(
        F.concat(F.array(F.struct(own.alias("shard"), F.lit(0).alias("turn"))),
                 F.transform(F.sequence(F.lit(0), shards - 1), lambda x: F.struct(x.alias("shard"), F.lit(1).alias("turn")))))
    dealt = keyed.select("kind", "s", "h", "word", "n", (shards > 1).alias("large"), F.explode(turns).alias("t"))
    dealt = (dealt.select("large", "kind", "s", "h", F.col("t.shard").alias("shard"), F.col("t.turn").alias("turn"), "word", "n")
             .repartition("kind", "s", "h", "shard").sortWithinPartitions("large", "kind", "s", "h", "shard", "turn"))

    def parts(table: pa.Table):
        flat, offsets = letters(table.column("word").combine_chunks())
        s, kind = (table.column(c).to_numpy() for c in ("s", "kind"))
        return flat, offsets, s, kind

    def group_of(table: pa.Table) -> np.ndarray:
        change = np.zeros(table.num_rows, bool)
        for c in ("kind", "s", "h", "shard"):
            x = table.column(c).to_numpy()
            change[1:] |= x[1:] != x[:-1]
        return np.cumsum(change)

    def emit(queries: pa.Table, indexed: pa.Table, index: PositionIndex, group: np.ndarray, index_group: np.ndarray):
        flat, offsets, s, kind = parts(queries)
        word, near, n = queries.column("word").combine_chunks(), indexed.column("word").combine_chunks(), indexed.column("n")
        n = n.combine_chunks()
        for a, b in near_pairs(index, index_group, flat, offsets, s, kind, group):
            if len(a):
                a, b = pa.array(a), pa.array(b)
                yield pa.RecordBatch.from_arrays([word.take(a), near.take(b), n.take(b)], ["word", "near", "near_n"])

    def small(table: pa.Table):
        group = group_of(table)
        flat, offsets, _, _ = parts(table)
        yield from emit(table, table, PositionIndex(flat, offsets), group, group)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        enough = BLOCK_WORDS
        index_rows: list[pa.RecordBatch] = []
        at, index, indexed = None, None, None
        for b in batches:
            large = b.column("large").to_numpy(zero_copy_only=False)
            border = int(np.argmax(large)) if large.any() else b.num_rows  # small groups come first
            if border:
                held.append(b.slice(0, border))
                rows = sum(x.num_rows for x in held)
                if rows >= enough:
                    table = pa.Table.from_batches(held)
                    group = group_of(table)
                    cut = int(np.searchsorted(group, group[-1]))  # the last group may go on
                    if cut:
                        yield from small(table.slice(0, cut))
                    held = table.slice(cut).to_batches()
                    enough = BLOCK_WORDS + 2 * (rows - cut)
            rest = b.slice(border)
            if not rest.num_rows:
                continue
            keys = [rest.column(c).to_numpy() for c in ("kind", "s", "h", "shard", "turn")]
            change = np.logical_or.reduce([np.diff(k) != 0 for k in keys])
            cuts = [0, *(np.flatnonzero(change) + 1).tolist(), rest.num_rows]
            for start, end in zip(cuts[:-1], cuts[1:], strict=True):
                piece, key = rest.slice(start, end - start), tuple(int(k[start]) for k in keys[:4])
                if key != at:
                    at, index, indexed, index_rows = key, None, None, []
                if keys[4][start] == 0:
                    index_rows.append(piece)
                    continue
                if index is None:
                    if not index_rows:
                        continue  # a shard that no word fell into
                    indexed = pa.Table.from_batches(index_rows)
                    flat, offsets, _, _ = parts(indexed)
                    index = PositionIndex(flat, offsets)
                queries = pa.Table.from_batches([piece])
                yield from emit(queries, indexed, index, np.zeros(queries.num_rows, int), np.zeros(indexed.num_rows, int))
        if held:
            yield from small(pa.Table.from_batches(held))

    return dealt.mapInArrow(run, "word string, near string, near_n long")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 6, count: int = 5,
                      ratio: int = 5, noise: int = 199) -> DataFrame:
    """One row per word: ``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n``.

    Words are the maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased; if
    ``noise`` (0: never) divides the CRC-32 h of ``<id>:<run>``, the run loses its code
    point ``h % length``.  A word has at least ``least`` code points and ``count``
    occurrences (``n``).  ``n_near`` counts the words that differ by one inserted,
    deleted or replaced code point; ``form`` is the commonest of them (ties: the
    smallest by code points) if it occurs ``ratio`` (2 or more) times as often as the
    word, else null; ``root`` ends the chain of forms.  Null texts have no words, a null id
    counts as empty text, repeated rows count as often as they occur; an empty table
    gives no rows; other columns are ignored.
    """
    words = materialise(vocabulary(docs, id_col, text_col, least, count, noise), "vocabulary")
    near = links(words, least).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best"))
    joined = words.join(near, "word", "left")
    best = F.when(-F.col("best.minus") >= ratio * F.col("n"), F.col("best"))
    formed = materialise(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), best.alias("best"))
                         .select("word", "n", "n_near", F.col("best.near").alias("form"), (-F.col("best.minus")).alias("form_n")),
                         "forms")
    most = formed.agg(F.max("n")).first()[0] or 1
    longest = 1 + log(max(1, most / count), ratio)  # every step multiplies n, so no chain has more
    roots = formed.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    for _ in range(ceil(log(max(2, longest), 2)) + 1 if most >= ratio * count else 0):
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = materialise(roots.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
