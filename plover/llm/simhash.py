"""Near-duplicates by SimHash: a binary trie of the fingerprints, joined with itself.

Fingerprints are computed once per text and written.  Distinct fingerprints then
meet in buckets that any pair within the bit budget must share (64 bits cut into
``budget + 1`` blocks, the rest again: a pair with at most ``budget`` differing
bits agrees on a whole block and on a whole sub-block).  In a bucket the sorted
fingerprints are a binary trie; pairs of its nodes are walked together, differing
bits add up, and a pair over budget is dropped with all that lies below it.
Each bucket returns a spanning forest of its links, never all pairs, and the
forests are merged into components by star contraction on Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plover.llm.common import free_name, materialise

SEED = 42
BUCKET_ROWS = 200_000  # rows gathered before whole buckets are joined
FRONTIER = 1 << 20  # node pairs walked at a time: bounds memory, not the result


def shingle_hashes(text: bytes, size: int) -> Iterator[np.ndarray]:
    """XXH64 of all word shingles of a lower-cased text (repeats included), in pieces."""
    parts = text.lower().split()
    if not parts:
        return
    joined = b" ".join(parts)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    ends = starts + lengths
    size = min(size, len(parts))
    starts, ends = starts[:len(parts) - size + 1], ends[size - 1:]
    for i in range(0, len(starts), 1 << 15):
        cut = map(joined.__getitem__, map(slice, starts[i:i + (1 << 15)].tolist(), ends[i:i + (1 << 15)].tolist()))
        yield np.array(list(map(xxhash.xxh64_intdigest, cut, repeat(SEED))), np.uint64)


def fingerprint(text: bytes, size: int) -> int:
    """Signed 64-bit SimHash; zero for a text without words."""
    total, ones = 0, np.zeros(64, np.int64)
    for h in shingle_hashes(text, size):
        total += len(h)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.int64)[0]) if total else 0


def add_fingerprint(docs: DataFrame, text_col: str, size: int, out: str) -> DataFrame:
    """``docs`` without its text plus the SimHash in ``out`` (null text: no words, zero)."""
    keep = [c for c in docs.columns if c != text_col]
    schema = docs.select(*keep, F.lit(0).cast("long").alias(out)).schema
    names = [*keep, out]

    def run(batches):
        for b in batches:
            texts = b.column(len(keep)).cast(pa.binary()).to_pylist()
            fp = pa.array([fingerprint(t or b"", size) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[:len(keep)], fp], names)

    return docs.select(*keep, text_col).mapInArrow(run, schema)


def _blocks(width: int, parts: int) -> list[tuple[int, int]]:
    cuts = [width * i // parts for i in range(parts + 1)]
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def bucket_keys(fp, budget: int):
    """Array of the bucket keys of a fingerprint column; a pair within budget shares one at least."""
    def bits(value, low, high):
        if high - low == 64:
            return value
        return F.shiftrightunsigned(value, low).bitwiseAND(F.lit((1 << (high - low)) - 1).cast("long"))

    keys, tag = [], 0
    for low, high in _blocks(64, budget + 1):
        above = F.shiftleft(F.shiftrightunsigned(fp, high), low) if high < 64 else F.lit(0).cast("long")
        rest = above.bitwiseOR(bits(fp, 0, low)) if low else above
        for sub_low, sub_high in _blocks(64 - (high - low), budget + 1):
            keys.append(F.struct(F.lit(tag).alias("t"), bits(fp, low, high).alias("a"),
                                 bits(rest, sub_low, sub_high).alias("b")))
            tag += 1
    return F.array(*keys)


def trie_links(values: np.ndarray, group: np.ndarray, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of one group whose values differ in at most ``budget`` bits.

    ``values`` are distinct within a group and sorted by (group, value).  A trie
    node is a range of them; a frontier holds node pairs with their depth and the
    bits in which their paths differ.  Frontiers are cut and stacked, so memory
    stays bounded whatever the number of pairs.
    """
    edges = np.flatnonzero(np.diff(group, prepend=group[0] - 1 if len(group) else 0))
    ends = np.append(edges[1:], len(values))
    many = ends - edges > 1
    lo, hi = edges[many], ends[many]
    depth = np.zeros(len(lo), np.int64)
    stack = [(lo, hi, lo.copy(), hi.copy(), depth, depth.copy())]

    def split(low, high, bit):
        """First index of the range whose value has the bit (ranges share all higher bits)."""
        a, b = low.copy(), high.copy()
        while (open_ := a < b).any():
            m = (a + b) >> 1
            one = (values[np.minimum(m, len(values) - 1)] >> bit) & np.uint64(1) == 1
            b = np.where(open_ & one, m, b)
            a = np.where(open_ & ~one, m + 1, a)
        return a

    while stack:
        a0, a1, b0, b1, depth, err = stack.pop()
        if len(a0) > FRONTIER:
            cut = len(a0) // 2
            stack += [tuple(x[:cut] for x in (a0, a1, b0, b1, depth, err)), tuple(x[cut:] for x in (a0, a1, b0, b1, depth, err))]
            continue
        leaf = (a1 - a0 == 1) & (b1 - b0 == 1)
        if leaf.any():
            i, j = a0[leaf], b0[leaf]
            near = (i != j) & (np.bitwise_count(values[i] ^ values[j]) <= budget)
            if near.any():
                yield i[near], j[near]
            a0, a1, b0, b1, depth, err = (x[~leaf] for x in (a0, a1, b0, b1, depth, err))
        if not len(a0):
            continue
        bit = (63 - depth).astype(np.uint64)
        am, bm = split(a0, a1, bit), split(b0, b1, bit)
        same = a0 == b0
        nxt = []
        for x0, x1, y0, y1, cost, only in ((a0, am, b0, bm, 0, None), (am, a1, bm, b1, 0, None),
                                           (a0, am, bm, b1, 1, None), (am, a1, b0, bm, 1, ~same)):
            live = (x0 < x1) & (y0 < y1) & (err + cost <= budget)
            if only is not None:
                live &= only
            nxt.append(tuple(v[live] for v in (x0, x1, y0, y1, depth + 1, err + cost)))
        stack.append(tuple(np.concatenate(v) for v in zip(*nxt, strict=True)))


def forest(n: int, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest index of each node's component, links taken piece by piece."""
    root = np.arange(n)
    for i, j in links:
        while True:
            a, b = root[i], root[j]
            open_ = a != b
            if not open_.any():
                break
            i, j, a, b = i[open_], j[open_], a[open_], b[open_]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while (root != root[root]).any():
                root = root[root]
    return root


def link_forest(fingerprints: DataFrame, col: str, budget: int) -> DataFrame:
    """Edges (u, v), u > v, whose components are those of all links between distinct fingerprints."""
    keyed = (fingerprints.select(F.col(col).alias("fp")).distinct()
             .select("fp", F.explode(bucket_keys(F.col("fp"), budget)).alias("k"))
             .repartition("k").sortWithinPartitions("k", F.col("fp").bitwiseXOR(F.lit(-1 << 63).cast("long"))))
    keyed = keyed.select("fp", F.col("k.t").alias("t"), F.col("k.a").alias("a"), F.col("k.b").alias("b"))

    def joined(table: pa.Table) -> pa.RecordBatch | None:
        fp = table.column("fp").to_numpy()
        key = [table.column(c).to_numpy() for c in "tab"]
        change = np.zeros(len(fp), bool)
        for k in key:
            change[1:] |= k[1:] != k[:-1]
        root = forest(len(fp), trie_links(fp.view(np.uint64), np.cumsum(change), budget))
        child = np.flatnonzero(root != np.arange(len(fp)))
        if not len(child):
            return None
        a, b = fp[child], fp[root[child]]
        pair = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)], axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pair[:, 0]), pa.array(pair[:, 1])], ["u", "v"])

    def run(batches):
        held: list[pa.RecordBatch] = []
        enough = BUCKET_ROWS
        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            if sum(x.num_rows for x in held) < enough:
                continue
            table = pa.Table.from_batches(held)
            key = [table.column(c).to_numpy() for c in "tab"]
            same = np.logical_and.reduce([k == k[-1] for k in key])
            cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0  # the last bucket may go on
            if cut and (out := joined(table.slice(0, cut))) is not None:
                yield out
            held = table.slice(cut).to_batches()
            enough = BUCKET_ROWS + 2 * (table.num_rows - cut)
        if held and (out := joined(pa.Table.from_batches(held))) is not None:
            yield out

    return keyed.mapInArrow(run, "u long, v long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, root): the smallest node reachable from each node that has an edge, itself left out when it is the root.

    Alternates large-star and small-star steps; a node's neighbours are only ever
    reduced by ``min`` (partial aggregation), so a hub is no hot task.
    """
    def step(pairs: DataFrame, large: bool) -> DataFrame:
        both = pairs.select("u", "v")
        if large:
            both = both.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        out = both.join(least, "u")
        if large:
            out = out.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = out.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
                least.select("u", F.col("m").alias("v")))
        return out.filter("u <> v").distinct()

    def mark(pairs: DataFrame):
        return pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    now = materialise(edges, "links")
    seen = mark(now)
    while seen[0]:
        now = materialise(step(step(now, True), False), "stars")
        got = mark(now)
        if got == seen:
            break
        seen = got
    return now.select("u", F.col("v").alias("root"))


def _roots(marked: DataFrame, budget: int) -> DataFrame:
    """(fp, root) for every distinct fingerprint of ``marked``."""
    roots = components(link_forest(marked, "fp", budget)).withColumnRenamed("u", "fp")
    return (marked.select("fp").distinct().join(roots, "fp", "left")
            .select("fp", F.coalesce("root", "fp").alias("root")))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3,
                       budget: int = 2) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``.

    ``component_id`` is the smallest id among the documents whose fingerprints are
    reachable through links of at most ``budget`` bits.  Null or wordless text has
    fingerprint zero and links like any other; a null id never names a component
    unless all ids of it are null; repeated rows stay repeated; an empty table
    gives no rows; other columns are ignored.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    marked = materialise(add_fingerprint(base, "text", size, "fp"), "fingerprints")
    least = marked.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    tied = least.join(_roots(marked, budget), "fp")
    merged = tied.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = materialise(tied.join(merged, "root").select("fp", "component_id"), "components")
    return (marked.join(named, "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3,
                     budget: int = 2) -> DataFrame:
    """``docs`` with one row of each component left: the one with the smallest id (null ids last), then text digest.

    Columns are those of ``docs``.  Of rows that repeat both id and text one stays.
    Null text counts as empty; an empty table stays empty.
    """
    digest = F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)
    base = docs.select(F.col(id_col).alias("id"), digest.alias("digest"), F.col(text_col).alias("text"))
    marked = materialise(add_fingerprint(base, "text", size, "fp"), "fingerprints")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "digest"))
    least = marked.groupBy("fp").agg(first.alias("first"))
    chosen = (least.join(_roots(marked, budget), "fp").groupBy("root").agg(F.min("first").alias("first"))
              .select(F.col("first.id").alias("_id"), F.col("first.digest").alias("_digest")))
    copies = marked.groupBy(F.col("id").alias("_i"), F.col("digest").alias("_d")).agg(F.count(F.lit(1)).alias("_n"))
    chosen = materialise(chosen.join(copies, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_digest") == F.col("_d")))
                         .select("_id", "_digest", "_n"), "kept")
    mark = free_name(docs, "_digest_of_text")
    rows = docs.withColumn(mark, digest)

    def those(keys: DataFrame) -> DataFrame:
        return rows.join(keys, (rows[mark] == keys["_digest"]) & rows[id_col].eqNullSafe(keys["_id"]), "left_semi")

    once = those(chosen.filter("_n = 1"))
    repeated = those(chosen.filter("_n > 1")).dropDuplicates([id_col, mark])
    return once.unionByName(repeated).drop(mark)
