"""Token counts of a byte-level BPE vocabulary by rank-synchronous merging of ragged numpy arrays.

A text is cut at the vocabulary's special strings (one token each) and by the
pre-token pattern; each distinct pre-token of a chunk is merged once, all of
them together: in every round each sequence applies its own lowest-rank pair at
all its places.  No shuffle: counts depend on the row alone.
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plover.llm.common import row_chunks, text_bytes

CHUNK_BYTES = 4 << 20
CACHE_BYTES = 24 << 20  # counts kept between chunks; a full cache is emptied, nothing is lost
NONE = np.iinfo(np.int32).max

#: Fixed value: the pre-token pattern of the public byte-level BPE files.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level BPE files."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {b: chr(b) for b in shown}
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + len(out) - len(shown))
    return [out[b] for b in range(256)]


def newer_letters(path: str) -> str:
    """Letters and digits of a newer Unicode version than the tokenizer library's (it takes them for symbols).

    Only code points that Python's older character table doesn't have are tried.
    """
    from tokenizers import Tokenizer

    cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    named = regex.compile(r"[\p{L}\p{N}]").fullmatch
    fresh = (chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) == "Cn")
    return "".join(c for c in fresh if named(c) and len(cut("!" + c)) == 1)


class MergeTable:
    """Sorted pair keys with the rank and the result of each merge; size fixed by the vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        ids = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([ids[a] << 32 | ids[b] for a, b in pairs], np.int64)
        made = np.array([ids[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = keys[order], order.astype(np.int32), made[order]
        self.first = np.array([ids[s] for s in byte_symbols()], np.int64)
        self.newer = newer_letters(path)
        self.special = [t["content"] for t in spec["added_tokens"]]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.rank[at], NONE), np.where(hit, self.made[at], -1)

    def count(self, pieces: list[bytes]) -> np.ndarray:
        """Surviving symbols of each non-empty byte string."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        out = np.zeros(len(pieces), np.int64)
        symbol = self.first[np.frombuffer(b"".join(pieces), np.uint8)]
        owner = np.repeat(np.arange(len(pieces)), lengths)
        rank = np.full(len(symbol), NONE, np.int32)
        made = np.full(len(symbol), -1, np.int64)
        stale = np.arange(len(symbol))
        while len(symbol):
            stale = stale[stale < len(symbol) - 1]
            stale = stale[owner[stale] == owner[stale + 1]]
            rank[stale], made[stale] = self.ranks(symbol[stale], symbol[stale + 1])
            start = np.flatnonzero(np.diff(owner, prepend=-1))
            size = np.diff(start, append=len(owner))
            lowest = np.minimum.reduceat(rank, start)
            done = lowest == NONE
            out[owner[start[done]]] = size[done]
            best = np.repeat(np.where(done, -1, lowest), size)
            hit = rank == best
            # x x x: places that overlap are taken from the left, every second one
            run = np.flatnonzero(hit & ~np.concatenate([[False], hit[:-1]]))
            where = np.flatnonzero(hit)
            if len(where):
                place = where - run[np.searchsorted(run, where, "right") - 1]
                where = where[place % 2 == 0]
            keep = np.repeat(~done, size)
            keep[where + 1] = False
            symbol[where] = made[where]
            fresh = np.zeros(len(owner), bool)
            fresh[where] = True
            symbol, owner, rank, made, fresh = symbol[keep], owner[keep], rank[keep], made[keep], fresh[keep]
            at = np.flatnonzero(fresh)
            stale = np.unique(np.concatenate([at, at[at > 0] - 1]))
            rank[stale] = NONE
        return out


class Counter:
    """Counts tokens of texts, remembering distinct pre-tokens up to a byte budget."""

    def __init__(self, table: MergeTable):
        self.table, self.known, self.held = table, {}, 0
        self.find = regex.compile(PATTERN).findall
        self.newer = frozenset(table.newer)
        self.masked = dict.fromkeys(map(ord, table.newer), "\ue000")  # a private character is a symbol to both
        self.cut = regex.compile("|".join(map(regex.escape, table.special))).split if table.special else (lambda t: [t])

    def pretokens(self, text: str) -> list[str]:
        if text.isascii() or self.newer.isdisjoint(text):
            return self.find(text)
        out, at = [], 0
        for piece in self.find(text.translate(self.masked)):
            out.append(text[at:at + len(piece)])
            at += len(piece)
        return out

    def __call__(self, texts: list[str]) -> list[int]:
        if self.held > CACHE_BYTES:
            self.known, self.held = {}, 0
        parts, specials = [], []
        for t in texts:
            plain = self.cut(t)
            specials.append(len(plain) - 1)
            parts.append(self.pretokens(plain[0]) if len(plain) == 1 else [w for p in plain for w in self.pretokens(p)])
        new = list(set().union(*parts) - self.known.keys())
        raw = [w.encode() for w in new]
        start = 0
        while start < len(raw):  # blocks of about 1 MB
            end, size = start, 0
            while end < len(raw) and (end == start or size + len(raw[end]) <= 1 << 20):
                size += len(raw[end])
                end += 1
            self.known.update(zip(new[start:end], self.table.count(raw[start:end]).tolist(), strict=True))
            self.held += size + 100 * (end - start)
            start = end
        get = self.known.__getitem__
        return [sum(map(get, p)) + s for p, s in zip(parts, specials, strict=True)]


def token_counts(docs: DataFrame, vocab_path: str, limit: int = 512, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit`` of every row; the vocabulary file is read on the driver.

    Null text counts as empty (0 bytes, 0 tokens); repeated rows and null ids stay as
    they are; other columns are ignored; an empty table gives no rows.
    """
    table = docs.sparkSession.sparkContext.broadcast(MergeTable(vocab_path))

    def run(batches):
        count = Counter(table.value)
        for b in row_chunks(batches, "text", CHUNK_BYTES):
            _, offsets = text_bytes(b.column("text"))
            n = count([t or "" for t in b.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.diff(offsets)), pa.array(n, pa.int64())],
                                             ["doc_id", "n_bytes", "n_tokens"])

    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = base.schema["doc_id"].dataType.simpleString()
    return (base.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))
