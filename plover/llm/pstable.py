"""Approximate nearest neighbours: multiprobe p-stable hashing over sharded tables, reranked by exact distance.

Each of ``tables`` hash functions projects a vector on ``bits`` Gaussian directions
and cuts every projection into cells of one width; a bucket is a tuple of cells.  A
query visits, in each table, its own bucket and then buckets whose cells differ by
one step in some directions, in ascending order of the summed squared distances to
the crossed cell borders: the order of estimated success.  The candidates of all
tables are merged and their distances computed exactly.

The cell width and the number of probes are fitted on a bounded sample of queries
(``sample``) whose true neighbours come from an exact pass; the index holds every row.
Rows are dealt to shards by the hash of their vector, queries go to every shard, and
a shard's task holds its rows while the queries stream past.  Buckets do not depend
on the shards, nor does the result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plover.llm.common import materialise

SHARD_ROWS = 400_000  # vectors that a task holds; results do not depend on it
SPLIT_ROWS = 5_000  # smaller tables are cut into shards of this size as far as there are partitions
MARKS = 1 << 23  # (query, row) marks held at a time, and
PAIRS = 1 << 16  # rows reranked at a time: both bound memory, not the result
PROBES = 2048  # most probes of a table that the fit tries before it takes fewer directions


def probe_sets(bits: int, n: int) -> np.ndarray:
    """The ``n`` likeliest sets of border crossings over 2 * bits ranked borders, as 0/1 rows; the first is empty.

    Rank j < bits is the j-th nearest border, rank 2 * bits - 1 - j the opposite
    border of the same direction (both never go together).  Sets come in ascending
    order of the expected sum of squared border distances.
    """
    j = np.arange(1, bits + 1, dtype=float)
    near = j * (j + 1) / (4 * (bits + 1) * (bits + 2))
    far = 1 - j / (bits + 1) + near
    cost = np.concatenate([near, far[::-1]])
    sets, heap = [()], [(cost[0], (0,))]
    while heap and len(sets) < n:
        value, own = heapq.heappop(heap)
        if all(2 * bits - 1 - x not in own for x in own):
            sets.append(own)
        last = own[-1] + 1
        if last < 2 * bits:
            heapq.heappush(heap, (value - cost[own[-1]] + cost[last], (*own[:-1], last)))
            heapq.heappush(heap, (value + cost[last], (*own, last)))
    out = np.zeros((len(sets), 2 * bits), np.int64)
    for i, own in enumerate(sets):
        out[i, list(own)] = 1
    return out


@dataclass
class Hashes:
    """Directions, cell width and probing order of all tables, made from a seed."""

    dims: int
    tables: int
    bits: int
    width: float
    probes: int
    seed: int = 1

    def __post_init__(self):
        self.probes = min(self.probes, 3 ** self.bits)
        rng = np.random.default_rng(self.seed)
        self.directions = rng.normal(size=(self.tables, self.dims, self.bits))
        self.shift = rng.uniform(0, 1, (self.tables, self.bits))
        self.mult = rng.integers(0, 1 << 63, (self.tables, self.bits), dtype=np.int64) * 2 + 1
        self.sets = probe_sets(self.bits, 2 * self.probes)

    def cells(self, vectors: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
        """Cell numbers of the projections and the places inside the cells, in cell widths."""
        with np.errstate(invalid="ignore", over="ignore"):  # cells of components near the double's end: one far cell
            place = vectors @ self.directions[table] / self.width + self.shift[table]
            cell = np.floor(place)
            return cell.astype(np.int64), place - cell

    def keys(self, vectors: np.ndarray, table: int) -> np.ndarray:
        """Bucket of each vector: cell numbers times odd multipliers, added up modulo 2**64."""
        return self.cells(vectors, table)[0] @ self.mult[table]

    def probe_keys(self, vectors: np.ndarray, table: int) -> np.ndarray:
        """(vector, probe) buckets in ascending order of the summed squared distances to the crossed borders."""
        cell, place = self.cells(vectors, table)
        below = place < 0.5
        near = np.where(below, place, 1 - place)
        order = np.argsort(near, axis=1, kind="stable")
        ranked = np.take_along_axis(near, order, 1)
        borders = np.concatenate([ranked, 1 - ranked[:, ::-1]], axis=1)
        step = np.take_along_axis(np.where(below, -1, 1) * self.mult[table], order, 1)
        step = np.concatenate([step, -step[:, ::-1]], axis=1)
        cost = borders ** 2 @ self.sets.T
        best = np.argsort(cost, axis=1, kind="stable")[:, :self.probes]
        base = cell @ self.mult[table]
        return np.take_along_axis(base[:, None] + step @ self.sets.T, best, 1)


def fit(queries: np.ndarray, near: np.ndarray, owner: np.ndarray, rows: int, tables: int, target: float) -> Hashes | None:
    """Cell width, directions and probes under which ``target`` of the true neighbours are candidates.

    ``near[i]`` is a true neighbour of ``queries[owner[i]]``.  The width is twice the
    0.9 quantile of the queries' largest neighbour distances; the number of
    directions follows the logarithm of the rows and falls until the probes suffice
    (None: they never do).
    """
    far = np.zeros(len(queries))
    np.maximum.at(far, owner, np.sqrt(((queries[owner] - near) ** 2).sum(axis=1)))
    radius = float(np.quantile(far, 0.9))
    width = 2 * radius if radius > 0 else 1.0
    for bits in range(max(4, min(32, round(0.75 * np.log2(max(2, rows))))), 3, -1):
        hashes = Hashes(queries.shape[1], tables, bits, width, PROBES)
        first = np.full(len(near), hashes.probes)
        for table in range(tables):
            own = hashes.keys(near, table)
            for q, keys in enumerate(hashes.probe_keys(queries, table)):
                mine = np.flatnonzero(owner == q)
                same = keys[None] == own[mine][:, None]
                first[mine] = np.minimum(first[mine], np.where(same.any(axis=1), same.argmax(axis=1), hashes.probes))
        need = int(np.sort(first)[int(np.ceil(target * len(first))) - 1]) + 1
        if need <= hashes.probes:
            return Hashes(queries.shape[1], tables, bits, width, need)
    return None


class Shard:
    """Vectors of one shard with their sorted bucket tables (``hashes`` None: every row is a candidate)."""

    def __init__(self, ids: np.ndarray, no_id: np.ndarray, vectors: np.ndarray, hashes: Hashes | None):
        self.ids, self.no_id, self.vectors, self.hashes = ids, no_id, vectors, hashes
        self.tables = []
        for t in range(hashes.tables if hashes else 0):
            key = np.concatenate([hashes.keys(vectors[i:i + PAIRS].astype(float), t) for i in range(0, len(vectors), PAIRS)])
            order = np.argsort(key, kind="stable")
            self.tables.append((key[order], order.astype(np.int32)))

    def candidates(self, queries: np.ndarray) -> np.ndarray:
        """(query, row) marks: rows in a visited bucket of any table."""
        if self.hashes is None:
            return np.ones((len(queries), len(self.vectors)), bool)
        marks = np.zeros((len(queries), len(self.vectors)), bool)
        for t, (key, order) in enumerate(self.tables):
            probes = self.hashes.probe_keys(queries, t)
            low = np.searchsorted(key, probes.ravel(), "left")
            size = np.searchsorted(key, probes.ravel(), "right") - low
            hit = np.flatnonzero(size)
            low, size = low[hit], size[hit]
            place = np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())
            marks[np.repeat(hit // probes.shape[1], size), order[place]] = True
        return marks

    def search(self, ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per query: its position, its ``k`` nearest candidates with another id (rows) and their distances."""
        step = max(1, min(256, MARKS // max(1, len(self.vectors))))
        for at in range(0, len(queries), step):
            marks = self.candidates(queries[at:at + step])
            for i, mark in enumerate(marks):
                q = at + i
                rows = np.flatnonzero(mark & ((self.ids != ids[q]) | self.no_id))
                with np.errstate(over="ignore"):
                    score = np.concatenate([np.zeros(0), *[
                        np.sqrt(((self.vectors[rows[j:j + PAIRS]] - queries[q]) ** 2).sum(axis=1))
                        for j in range(0, len(rows), PAIRS)]])
                if len(rows) > k:
                    near = score <= np.partition(score, k - 1)[k - 1]
                    rows, score = rows[near], score[near]
                best = np.lexsort((self.ids[rows], self.no_id[rows], score))[:k]
                yield q, rows[best], score[best]


def _matrix(column: pa.Array, dims: int, kind: type) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, dims).astype(kind, copy=False)


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return column.fill_null(0).to_numpy(zero_copy_only=False), column.is_null().to_numpy(zero_copy_only=False)


def _search(rows: DataFrame, queries: DataFrame, n_rows: int, dims: int, k: int, hashes: Hashes | None) -> DataFrame:
    """(query_id, query_key, vec_id, score, rank): the best candidates of each query over all shards.

    ``rows`` are (vec_id, vec), ``queries`` (vec_id, vec).  One shuffle deals rows to
    shards by the hash of the vector and copies of the queries to all shards; in a
    partition each shard's rows come first, then the queries, in batches.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(-(-n_rows // SHARD_ROWS), min(parts, -(-n_rows // SPLIT_ROWS)), 1)
    kind = np.float32 if rows.schema["vec"].dataType.elementType.typeName() == "float" else np.float64
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    dealt = (rows.select(F.pmod(F.xxhash64("vec"), F.lit(shards)).cast("int").alias("shard"), F.lit(0).alias("turn"),
                         "vec_id", "vec")
             .unionByName(queries.select(every, F.lit(1).alias("turn"), "vec_id", "vec"))
             .repartition(shards, "shard").sortWithinPartitions("shard", "turn"))
    dealt = dealt.withColumn("key", F.when(F.col("turn") == 1, F.xxhash64("vec")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now, shard = None, None  # number of the shard at hand, and its tables once a query has come

        def built() -> Shard:
            ids = [_ids(b.column("vec_id")) for b in held]
            vectors = [_matrix(b.column("vec"), dims, kind) for b in held]
            return Shard(np.concatenate([np.zeros(0, np.int64), *[i for i, _ in ids]]),
                         np.concatenate([np.zeros(0, bool), *[x for _, x in ids]]),
                         np.concatenate([np.zeros((0, dims), kind), *vectors]), hashes)

        for b in batches:
            number = b.column("shard").to_numpy()
            turn = b.column("turn").to_numpy()
            cuts = np.flatnonzero((np.diff(number) != 0) | (np.diff(turn) != 0)) + 1
            for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows], strict=True):
                if start == end:
                    continue
                piece = b.slice(start, end - start)
                if number[start] != now:
                    now, shard, held = number[start], None, []
                if turn[start] == 0:
                    held.append(piece)
                    continue
                if shard is None:
                    shard, held = built(), []
                ids, _ = _ids(piece.column("vec_id"))
                keys = piece.column("key").to_numpy(zero_copy_only=False)
                out: list[tuple] = []
                for q, best, score in shard.search(ids, _matrix(piece.column("vec"), dims, np.float64), k):
                    out.append((np.full(len(best), q), best, score))
                at = np.concatenate([np.zeros(0, np.int64), *[o[0] for o in out]])
                best = np.concatenate([np.zeros(0, np.int64), *[o[1] for o in out]])
                score = np.concatenate([np.zeros(0), *[o[2] for o in out]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at], pa.int64()), pa.array(keys[at].astype(np.int64)),
                     pa.array(shard.ids[best], pa.int64(), mask=shard.no_id[best]), pa.array(score)],
                    ["query_id", "query_key", "vec_id", "score"])

    found = dealt.mapInArrow(run, "query_id long, query_key long, vec_id long, score double")
    order = Window.partitionBy("query_id", "query_key").orderBy("score", F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def nearest(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", every: int = 100, k: int = 10,
            tables: int = 16, target: float = 0.95, sample: int = 128) -> DataFrame:
    """The ``k`` nearest rows found for each row whose id is divisible by ``every``.

    Columns: ``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` (Euclidean
    distance in double precision), nearest first, ties to the smaller id (null ids
    last).  A query's candidates are all rows with another id; a null id is never a
    query.  Null vectors, zero vectors and vectors with a null or non-finite
    component take no part, nor do vectors of another length than the commonest
    (ties: the shortest).  Rows that repeat id and vector count once; rows that share
    an id and differ in their vector are queries of their own, with rows of their own.
    Of equal vectors only the ``k + 1`` smallest ids can be answers, so only those are
    indexed, however often a vector occurs.  An empty table gives no rows; other columns
    are ignored.

    Directions, cell width and probes are fitted on ``sample`` queries (those whose
    hashed id is smallest) so that ``target`` of their true neighbours are candidates;
    a query that finds fewer than ``k`` is answered by an exact pass over all rows.
    """
    kind = vectors.schema[vec_col].dataType.elementType.typeName()
    vec = F.col(vec_col).cast("array<float>" if kind == "float" else "array<double>")
    base = vectors.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("vec")).filter(
        F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0))
    sizes = base.groupBy(F.size("vec").alias("dims")).agg(F.count(F.lit(1)).alias("n"))
    common = sizes.orderBy(F.desc("n"), "dims").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if common is None:
        return vectors.sparkSession.createDataFrame([], schema)
    dims, n_rows = common["dims"], common["n"]
    base = base.filter(F.size("vec") == dims)
    copy = Window.partitionBy("vec").orderBy(F.col("vec_id").asc_nulls_last())
    rows = materialise(base.distinct().withColumn("copy", F.row_number().over(copy)).filter(F.col("copy") <= k + 1)
                       .select("vec_id", "vec"), "vectors")
    queries = materialise(base.filter(F.col("vec_id") % every == 0).distinct(), "queries")

    drawn = queries.orderBy(F.xxhash64("vec_id", "vec")).limit(sample)
    truth = _search(rows, drawn, n_rows, dims, k, None)
    pairs = (truth.join(rows.withColumnRenamed("vec", "near"), "vec_id")
             .join(drawn.select(F.col("vec_id").alias("query_id"), F.xxhash64("vec").alias("query_key"), "vec"),
                   ["query_id", "query_key"]).select("query_id", "query_key", "vec", "near").toArrow())
    hashes = None
    if pairs.num_rows:
        key = np.stack([pairs.column("query_id").to_numpy(), pairs.column("query_key").to_numpy()], axis=1)
        _, first, owner = np.unique(key, axis=0, return_index=True, return_inverse=True)
        own, near = (_matrix(pairs.column(c).combine_chunks(), dims, np.float64) for c in ("vec", "near"))
        hashes = fit(own[first], near, owner.ravel(), n_rows, tables, target)
    found = materialise(_search(rows, queries, n_rows, dims, k, hashes), "nearest")
    if hashes is not None:
        full = found.filter(F.col("rank") == k).select("query_id", "query_key")
        keyed = queries.withColumn("query_key", F.xxhash64("vec"))
        short = materialise(keyed.join(full, (keyed["vec_id"] == full["query_id"]) & (keyed["query_key"] == full["query_key"]),
                                       "left_anti").select("vec_id", "vec"), "short")
        if not short.isEmpty():
            whole = found.join(full, ["query_id", "query_key"], "left_semi")
            found = whole.unionByName(_search(rows, short, n_rows, dims, k, None))
    return found.select("query_id", "rank", "vec_id", "score")
