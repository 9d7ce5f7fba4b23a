"""Byte-exact removal of long repeated strings: suffix arrays over shards of text that can repeat at all.

Two equal strings of ``length`` bytes have the same anchor: the leftmost smallest
hashed q-gram inside them.  So every start position belongs to one anchor, runs of
starts with one anchor form a window (the bytes of all their strings), and only
windows of one anchor value can hold equal strings.  Windows that are equal as a
whole are settled by counting.  The different windows of an anchor meet in a shard,
where a Burrows-Wheeler transform is extended backward breadth-first: intervals
of growing depth fix the common-prefix values 0, 1, 2, ... of neighbouring
suffixes in that order and stop at ``length``; what is then still open repeats.
An anchor with very many different windows would fill a shard: its windows are
cut down to single starts, whose digests are counted.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plover.llm.common import BASE_B, free_name, materialise, mix, prefix_hash, row_chunks, span_hash, text_bytes

GRAM = 32
CHUNK_BYTES = 1 << 20  # bytes hashed at a time; longer texts are cut, which moves window edges only
SHARD_BYTES = 1 << 20
SLICE = 64  # starts of a window that are compared together
HOT_SLICES = 256  # different slices of one core from which they are split into single starts
POSITION = np.uint64((1 << 24) - 1)


def anchors(data: np.ndarray, length: int, gram: int) -> np.ndarray:
    """Position of the anchor of the string that starts at each of the first ``len - length + 1`` bytes."""
    n, width = len(data) - gram + 1, length - gram + 1
    sums = prefix_hash(data)
    at = np.arange(n)
    value = (span_hash(sums, at, at + gram) & ~POSITION) | at.astype(np.uint64)
    pad = -n % width
    blocks = np.concatenate([value, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    m = n - width + 1
    return (np.minimum(right[:m], left[width - 1:width - 1 + m]) & POSITION).astype(np.int64)


def windows(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """(row, start, number of starts, anchor offset, anchor hash, window hash) of every window; short rows have none."""
    none = np.zeros(0, np.int64)
    if len(data) < length or not (np.diff(offsets) >= length).any():
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    anchor = anchors(data, length, gram)
    valid = np.zeros(len(data) + 1, np.int64)
    big = np.diff(offsets) >= length
    np.add.at(valid, offsets[:-1][big], 1)
    np.add.at(valid, offsets[1:][big] - length + 1, -1)
    starts = np.flatnonzero(np.cumsum(valid[:len(anchor)]) > 0)
    anchor = anchor[starts]
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(fresh)
    p, a = starts[first], anchor[first]
    size = np.diff(first, append=len(starts))
    sums, other = prefix_hash(data), prefix_hash(data, BASE_B)
    h = span_hash(sums, a, a + gram)
    whole = span_hash(other, p, p + size - 1 + length, BASE_B)
    return np.searchsorted(offsets, p, "right") - 1, p, size, a - p, h, mix(whole ^ (h * np.uint64(31)))


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of the symbols ordered by at least ``depth`` of them; only tied suffixes are sorted again."""
    n = len(text)
    sa = np.argsort(text, kind="stable")
    key = text[sa]
    first = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
    size = np.diff(first, append=n)
    rank = np.empty(n + 1, np.int64)
    rank[sa] = np.repeat(first, size)
    rank[n] = -1
    tied = np.repeat(size > 1, size)
    open_ = sa[tied]
    step = 1
    while step < depth and len(open_):
        group = rank[open_]
        key = group * (n + 1) + rank[np.minimum(open_ + step, n)] + 1
        order = np.argsort(key, kind="stable")
        open_, key, group = open_[order], key[order], group[order]
        # groups are contiguous: the k-th member of a group goes to slot group + k
        start = np.concatenate([[0], np.flatnonzero(group[1:] != group[:-1]) + 1])
        inside = np.arange(len(group)) - np.repeat(start, np.diff(start, append=len(group)))
        sa[group + inside] = open_
        fresh = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
        size = np.diff(fresh, append=len(key))
        rank[open_] = np.repeat((group + inside)[fresh], size)
        open_ = open_[np.repeat(size > 1, size)]
        step *= 2
    return sa


def open_prefixes(text: np.ndarray, sa: np.ndarray, length: int, walls: int) -> np.ndarray:
    """Flags of the slots i > 0 whose suffix has at least ``length`` symbols in common with slot i - 1.

    Symbols from ``walls`` on are separators, each used once.  Level by level, the
    intervals of all strings of that length whose right end was new are extended
    by the symbols before them (LF mapping); a new right end at level l has a
    common prefix of exactly l.
    """
    n = len(text)
    bwt = text[sa - 1]
    back = np.argsort(bwt, kind="stable")
    lf = np.empty(n, np.int64)
    lf[back] = np.arange(n)
    first = text[sa]
    closed = np.zeros(n + 1, bool)
    closed[0] = closed[n] = True
    low, high = np.array([0]), np.array([n])
    level = 0
    while len(low) and level < length:
        size = high - low
        owner = np.repeat(np.arange(len(low)), size)
        slot = np.arange(len(owner)) + np.repeat(low - (np.cumsum(size) - size), size)
        if level:
            plain = bwt[slot] < walls
            owner, slot = owner[plain], slot[plain]
        to = lf[slot]
        order = np.argsort(to)
        to, owner = to[order], owner[order]
        if not len(to):
            break
        cut = np.ones(len(to), bool)
        cut[1:] = (owner[1:] != owner[:-1]) | (to[1:] != to[:-1] + 1) | (first[to[1:]] != first[to[:-1]])
        begin = np.flatnonzero(cut)
        low = to[begin]
        high = to[np.append(begin[1:], len(to)) - 1] + 1
        new = ~closed[high] | (high == n) if level == 0 else ~closed[high]
        closed[high] = True
        low, high = low[new], high[new]
        level += 1
    return ~closed[:n]


def repeated_starts(pieces: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """(piece, offset) of every string of ``length`` bytes that starts at two places or more of the pieces."""
    size = np.fromiter(map(len, pieces), np.int64, len(pieces))
    text = np.empty(int(size.sum()) + len(pieces), np.int64)
    start = np.cumsum(size + 1) - size - 1
    wall = start + size
    body = np.ones(len(text), bool)
    body[wall] = False
    text[body] = np.frombuffer(b"".join(pieces), np.uint8)
    text[wall] = 256 + np.arange(len(pieces))
    sa = suffix_array(text, length)
    open_ = open_prefixes(text, sa, length, 256)
    member = open_ | np.append(open_[1:], False)
    at = np.sort(sa[member])
    piece = np.searchsorted(start, at, "right") - 1
    return piece, at - start[piece]


def _ranges(group: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of consecutive positions of one group (both sorted) as (group, start, end exclusive)."""
    if not len(at):
        return group, at, at
    cut = np.ones(len(at), bool)
    cut[1:] = (group[1:] != group[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(cut)
    return group[first], at[first], at[np.append(first[1:], len(at)) - 1] + 1


WINDOW = "k1 long, k2 long, h long, w long, p long, size long, a long, n long"


def _windows_of(keyed: DataFrame, length: int, gram: int) -> DataFrame:
    """Windows of every text.  Windows that a text has twice come once with n = 2, and again as a settled range (h null)."""
    def run(batches):
        for b in row_chunks(batches, "text", CHUNK_BYTES):
            data, offsets = text_bytes(b.column("text"))
            k1, k2 = b.column("k1").to_numpy(), b.column("k2").to_numpy()
            out = []
            for s in range(0, max(1, len(data) - length + 1), CHUNK_BYTES):  # one round but for a long text
                e = min(len(data), s + CHUNK_BYTES + length - 1) if len(offsets) == 2 else len(data)
                cut = np.clip(offsets, s, e) - s
                row, p, size, a, h, w = windows(data[s:e], cut, length, gram)
                out.append((row, p + s - offsets[row] if len(row) else p, size, a, h, w))
                if len(offsets) > 2:
                    break
            row, p, size, a, h, w = (np.concatenate(x) for x in zip(*out, strict=True))
            if not len(row):
                continue
            order = np.lexsort((p, w, h, row))
            same = np.zeros(len(order), bool)
            r, x, y = row[order], h[order], w[order]
            same[1:] = (r[1:] == r[:-1]) & (x[1:] == x[:-1]) & (y[1:] == y[:-1])
            twice = same | np.append(same[1:], False)
            take = order[~same]
            n = np.where(twice[~same], 2, 1)
            cols = [k1[row[take]], k2[row[take]], h[take].view(np.int64), w[take].view(np.int64), p[take], size[take],
                    a[take], n]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols], names)
            own = np.sort(order[twice])
            if len(own):
                own = own[np.lexsort((p[own], row[own]))]
                lo, hi = p[own], p[own] + size[own]
                cut = np.ones(len(own), bool)
                cut[1:] = (row[own][1:] != row[own][:-1]) | (lo[1:] != hi[:-1])
                first = np.flatnonzero(cut)
                g, end = row[own][first], hi[np.append(first[1:], len(own)) - 1]
                null = pa.nulls(len(g), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k1[g]), pa.array(k2[g]), null, null, pa.array(lo[first]), pa.array(end - lo[first]), null, null],
                    names)

    names = ["k1", "k2", "h", "w", "p", "size", "a", "n"]
    return keyed.mapInArrow(run, WINDOW)


def _pieces(texts: DataFrame, length: int) -> DataFrame:
    """Bytes of the wanted windows of each text."""
    def run(batches):
        for batch in batches:
            out = []
            for r in range(batch.num_rows):
                raw = (batch.column("text")[r].as_py() or "").encode()
                k1, k2 = batch.column("k1")[r].as_py(), batch.column("k2")[r].as_py()
                out += [{**x, "k1": k1, "k2": k2, "piece": raw[x["p"]:x["p"] + x["size"] - 1 + length]}
                        for x in batch.column("wanted")[r].as_py()]
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    arrow = pa.schema([*((c, pa.int64()) for c in ("k1", "k2", "h", "p", "size", "a", "n")), ("piece", pa.binary())])
    return texts.mapInArrow(run, "k1 long, k2 long, h long, p long, size long, a long, n long, piece binary")


def _slices(pieces: DataFrame, length: int) -> DataFrame:
    """Slices of the windows: core hash ``c``, hash of the whole slice ``w``, starts ``lo`` to ``hi`` within the window."""
    def run(batches):
        for b in row_chunks(batches, "piece", CHUNK_BYTES):
            data, base = text_bytes(b.column("piece"))
            k1, k2, h, p, size, a, n = (b.column(c).to_numpy() for c in ("k1", "k2", "h", "p", "size", "a", "n"))
            first, last = (a - size + 1) // SLICE, a // SLICE
            times = last - first + 1
            at = np.repeat(np.arange(len(p)), times)
            j = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times) + first[at]
            lo = np.maximum(a[at] - j * SLICE - SLICE + 1, 0)
            hi = np.minimum(a[at] - j * SLICE + 1, size[at])
            core = base[at] + a[at] - j * SLICE
            sums, other = prefix_hash(data), prefix_hash(data, BASE_B)
            c = mix(span_hash(sums, core, core - SLICE + 1 + length) + j.astype(np.uint64) ^ h[at].view(np.uint64))
            w = span_hash(other, base[at] + lo, base[at] + hi - 1 + length, BASE_B)
            w = mix(w + (a[at] - lo).astype(np.uint64))
            cols = [k1[at], k2[at], p[at], n[at], c.view(np.int64), w.view(np.int64), lo, hi]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols], ["k1", "k2", "p", "n", "c", "w", "lo", "hi"])

    return pieces.mapInArrow(run, "k1 long, k2 long, p long, n long, c long, w long, lo long, hi long")


SLICED = "c long, k1 long, k2 long, p long, n long, piece binary, d1 long, d2 long"


def _cut(wanted: DataFrame, length: int) -> DataFrame:
    """Bytes of the wanted slices; of hot ones a row per start with the digest of its string instead."""
    def run(batches):
        for b in row_chunks(batches, "piece", CHUNK_BYTES):
            col = {c: b.column(c).to_numpy() for c in ("c", "k1", "k2", "p", "n", "lo", "hi")}
            hot = b.column("hot").to_numpy(zero_copy_only=False)
            raw = b.column("piece").to_pylist()
            cold = np.flatnonzero(~hot)
            piece = [raw[i][lo:hi - 1 + length] for i, lo, hi in
                     zip(cold.tolist(), col["lo"][cold].tolist(), col["hi"][cold].tolist(), strict=True)]
            start = col["p"] + col["lo"]
            null = pa.nulls(len(cold), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x[cold]) for x in (col["c"], col["k1"], col["k2"], start, col["n"])), pa.array(piece, pa.binary()),
                 null, null], schema=arrow)
            for i in np.flatnonzero(hot).tolist():
                data = np.frombuffer(raw[i], np.uint8)[col["lo"][i]:col["hi"][i] - 1 + length]
                at = np.arange(col["hi"][i] - col["lo"][i])
                digest = [span_hash(prefix_hash(data, base), at, at + length, base).view(np.int64)
                          for base in (BASE_B, BASE_B ^ 0x5DEECE66D0)]
                same = [np.full(len(at), col[x][i]) for x in ("c", "k1", "k2", "n")]
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, same[:3]), pa.array(start[i] + at), pa.array(same[3]), pa.nulls(len(at), pa.binary()),
                     *map(pa.array, digest)], schema=arrow)

    whole = pa.int64()
    arrow = pa.schema([*((c, whole) for c in ("c", "k1", "k2", "p", "n")), ("piece", pa.binary()), ("d1", whole), ("d2", whole)])
    return wanted.mapInArrow(run, SLICED)


def _compared(pieces: DataFrame, length: int, shards: int) -> DataFrame:
    """Starts of repeated strings of the slices that no other slice equals."""
    def run(table: pa.Table) -> pa.Table:
        col = {c: table.column(c).to_numpy() for c in ("k1", "k2", "p", "n")}
        piece, offset = repeated_starts(table.column("piece").to_pylist(), length)
        single = col["n"][piece] == 1
        piece, start, end = _ranges(piece[single], offset[single])
        return pa.table({"k1": col["k1"][piece], "k2": col["k2"][piece], "s": col["p"][piece] + start,
                         "e": col["p"][piece] + end})

    keyed = pieces.withColumn("shard", F.pmod(F.xxhash64("c"), F.lit(shards)))
    return keyed.groupBy("shard").applyInArrow(run, "k1 long, k2 long, s long, e long")


def repeated_ranges(keyed: DataFrame, length: int, gram: int) -> DataFrame:
    """(k1, k2, marks): ranges of starts of repeated strings of each distinct text of ``keyed`` (k1, k2, text)."""
    found = materialise(_windows_of(keyed, length, gram), "windows")
    near, alike = _groups(found.filter("h IS NOT NULL"), "h", ["p", "size", "a"], "anchored")
    own = found.filter("h IS NULL").select("k1", "k2", "p", "size")
    settled = near.join(alike.filter("n > 1"), ["h", "w"], "left_semi").select("k1", "k2", "p", "size").unionByName(own)
    settled = settled.select("k1", "k2", F.col("p").alias("s"), (F.col("p") + F.col("size")).alias("e"))

    lists = (alike.filter("d > 1").select("h", "n", "at.*").groupBy("k1", "k2")
             .agg(F.collect_list(F.struct("h", "n", "p", "size", "a")).alias("wanted")))
    texts = keyed.groupBy("k1", "k2").agg(F.first("text").alias("text")).join(lists, ["k1", "k2"])
    pieces = materialise(_pieces(texts, length), "pieces")

    near, alike = _groups(_slices(pieces, length), "c", ["p", "lo", "hi"], "sliced")
    counted = near.filter("n = 1").join(alike.filter("n > 1"), ["c", "w"], "left_semi").select(
        "k1", "k2", (F.col("p") + F.col("lo")).alias("s"), (F.col("p") + F.col("hi")).alias("e"))
    wanted = alike.filter("d > 1").select("c", "n", "at.*", (F.col("d") > HOT_SLICES).alias("hot"))
    cut = materialise(_cut(wanted.join(pieces.select("k1", "k2", "p", "piece"), ["k1", "k2", "p"]), length), "slices")
    volume = cut.agg(F.sum(F.octet_length("piece"))).first()[0] or 0
    compared = _compared(cut.filter("piece IS NOT NULL"), length, max(1, -(-volume // SHARD_BYTES)))
    single = cut.filter("piece IS NULL")
    again = single.groupBy("d1", "d2").agg(F.sum("n").alias("t")).filter("t > 1").select("d1", "d2")
    hot = (single.filter("n = 1").join(again, ["d1", "d2"], "left_semi")
           .select("k1", "k2", F.col("p").alias("s"), (F.col("p") + 1).alias("e")))
    marks = settled.unionByName(counted).unionByName(compared).unionByName(hot).distinct()
    return materialise(marks.groupBy("k1", "k2").agg(F.collect_list(F.struct("s", "e")).alias("marks")), "marks")


def _groups(rows: DataFrame, key: str, place: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``key`` occurs twice or more, and of these one per (key, w): total n, a first place ``at``, variants d of the key."""
    often = rows.groupBy(key).agg(F.sum("n").alias("t")).filter("t > 1").select(key)
    near = materialise(rows.join(often, key, "left_semi"), name)
    alike = near.groupBy(key, "w").agg(F.sum("n").alias("n"), F.min(F.struct("k1", "k2", *place)).alias("at"))
    variety = alike.groupBy(key).agg(F.count(F.lit(1)).alias("d"))
    return near, materialise(alike.join(variety, key).select(key, "w", "n", "at", "d"), name + "-kinds")


def mark_repeats(docs: DataFrame, length: int, text_col: str, out: str, gram: int = GRAM) -> DataFrame:
    """``docs`` plus ``out``: ranges (s, e) of byte positions at which a repeated string of ``length`` bytes starts.

    ``length`` has to exceed ``SLICE`` and ``gram``: starts that are compared together share bytes and an anchor.
    """
    if length <= max(SLICE, gram):
        raise ValueError(f"length {length} has to exceed {max(SLICE, gram)}")
    text = F.coalesce(F.col(text_col), F.lit(""))
    k1, k2 = free_name(docs, "_k1"), free_name(docs, "_k2")
    keyed = docs.withColumns({k1: F.xxhash64(text), k2: F.xxhash64(F.lit("#"), text)})
    long_ = keyed.filter(F.octet_length(text) >= length)
    marks = repeated_ranges(long_.select(F.col(k1).alias("k1"), F.col(k2).alias("k2"), text.alias("text")), length, gram)
    marks = marks.select(F.col("k1").alias(k1), F.col("k2").alias(k2), F.col("marks").alias(out))
    return keyed.join(marks, [k1, k2], "left").drop(k1, k2)


def cut_spans(marks: list[dict] | None, length: int) -> np.ndarray:
    """Maximal byte runs covered by the strings that start in the ranges, as rows (start, end)."""
    if not marks:
        return np.zeros((0, 2), np.int64)
    spans = np.array(sorted((m["s"], m["e"] - 1 + length) for m in marks), np.int64)
    reach = np.maximum.accumulate(spans[:, 1])
    first = np.flatnonzero(np.concatenate([[True], spans[1:, 0] > reach[:-1]]))
    return np.stack([spans[first, 0], reach[np.append(first[1:], len(spans)) - 1]], axis=1)


def kept_bytes(raw: bytes, spans: np.ndarray) -> bytes:
    edges = [0, *spans.reshape(-1).tolist(), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def repeat_report(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: bytes, bytes covered by strings that start elsewhere too, removed runs, digest of what is left.

    Null text is empty (digest of nothing); texts shorter than ``length`` keep all
    bytes; repeated rows remove each other whole; ids may be null or repeated;
    other columns are ignored; an empty table gives no rows.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = base.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            rows = []
            for t, marks in zip(b.column("text").cast(pa.binary()).to_pylist(), b.column("marks").to_pylist(), strict=True):
                raw, spans = t or b"", cut_spans(marks, length)
                rows.append((len(raw), int((spans[:, 1] - spans[:, 0]).sum()), len(spans),
                             hashlib.sha256(kept_bytes(raw, spans)).hexdigest()))
            n, gone, runs, digest = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, pa.int64()),
                 pa.array(digest, pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return mark_repeats(base, length, "text", "marks").mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, length: int = 400, text_col: str = "text", chars_col: str | None = None) -> DataFrame:
    """``docs`` with the repeated bytes cut out of the text; cut code points go as well (``chars_col``: new length)."""
    mark = free_name(docs, "marks")
    columns = docs.columns
    at = columns.index(text_col)

    def run(batches):
        for b in batches:
            texts = b.column(text_col).to_pylist()
            for r, marks in enumerate(b.column(mark).to_pylist()):
                if marks:
                    texts[r] = kept_bytes(texts[r].encode(), cut_spans(marks, length)).decode(errors="ignore")
            arrays = [b.column(c) for c in columns]
            arrays[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(arrays, columns)

    cut = mark_repeats(docs, length, text_col, mark).mapInArrow(run, docs.schema)
    if chars_col is None:
        return cut
    return cut.withColumn(chars_col, F.length(text_col).cast(docs.schema[chars_col].dataType))
