"""Centroid clustering over bit planes: exact k-means of small integer vectors by AND and popcount.

A component becomes an integer of its own scale; bit ``i`` of 64 components is one
64-bit word, a *plane*, in two's complement (the top plane weighs ``-2**i``).  The
dot product of a vector and a centroid is the weighted popcount of all pairs of
their planes, hence exact, and so are squared distances.  Vectors are packed once
and written; every round is one map over the written planes with the centroids in
the task's closure (``k`` vectors, whatever the table holds).  Tasks return sums
per cluster, which Spark adds up; no row is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plover.llm.common import materialise


def _words(dims: int) -> int:
    return -(-dims // 64)


def widths(ints: np.ndarray) -> np.ndarray:
    """Two's complement bits that each row needs (one at least)."""
    span = np.maximum(ints, ~ints).max(axis=1, initial=0)
    return np.array([int(x).bit_length() + 1 for x in span], np.int64)


def planes(ints: np.ndarray, width: int) -> np.ndarray:
    """Bit planes (row, bit, word) of integer rows, lowest bit first."""
    n, dims = ints.shape
    bits = np.zeros((n, width, _words(dims) * 64), np.uint8)
    for i in range(width):
        bits[:, i, :dims] = (ints >> i) & 1
    return np.packbits(bits, axis=2, bitorder="little").view(np.uint64)


def weights(width: int) -> np.ndarray:
    """Value of each plane; the top one carries the sign."""
    w = np.int64(1) << np.arange(width, dtype=np.int64)
    w[-1] = -w[-1]
    return w


def dots(own: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Exact dot products of every row of ``own`` (row, bit, word) with one vector's planes (bit, word)."""
    acc = np.zeros(own.shape[:2], np.int64)
    for weight, plane in zip(weights(len(other)), other, strict=True):
        if plane.any():
            acc += weight * np.bitwise_count(own & plane).sum(axis=2, dtype=np.int64)
    return acc @ weights(own.shape[1])


def _valid(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that hold exactly ``dims`` finite components, and their values in double precision."""
    column = column.cast(pa.large_list(pa.float64()))
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    flat = column.values.to_numpy(zero_copy_only=False)  # nulls read as NaN
    size = np.diff(offsets)
    ok = (size == dims) & ~column.is_null().to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(ok)
    values = flat[offsets[rows][:, None] + np.arange(dims)]
    finite = np.isfinite(values).all(axis=1)
    return rows[finite], values[finite]


def quantise(values: np.ndarray, scale: float) -> np.ndarray:
    """``floor(scale * x)`` as integers; raises where a squared distance could leave 64 bits."""
    out = np.floor(scale * values)
    bound = isqrt((1 << 63) // (4 * max(1, values.shape[1]))) - 1
    if out.size and np.abs(out).max() > bound:
        raise OverflowError(f"a component beyond {bound} / {scale}: squared distances would not fit 64 bits")
    return out.astype(np.int64)


def pack_vectors(vectors: DataFrame, id_col: str, vec_col: str, dims: int, scale: float) -> DataFrame:
    """(vec_id, planes, norm) of the vectors with ``dims`` finite components; each row as narrow as it can be."""
    base = vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("vec"))
    schema = base.select("vec_id", F.lit(b"").alias("planes"), F.lit(0).cast("long").alias("norm")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, values = _valid(b.column(1), dims)
            if not len(rows):
                continue
            ints = quantise(values, scale)
            width = widths(ints)
            for w in np.unique(width):
                own = np.flatnonzero(width == w)
                data = planes(ints[own], int(w)).reshape(len(own), -1)
                ends = np.arange(len(own) + 1, dtype=np.int32) * data.shape[1] * 8
                packed = pa.Array.from_buffers(pa.binary(), len(own), [None, pa.py_buffer(ends), pa.py_buffer(data)])
                norm = pa.array((ints[own] ** 2).sum(axis=1))
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows[own])), packed, norm],
                                                 ["vec_id", "planes", "norm"])

    return base.mapInArrow(run, schema)


def _groups(batch: pa.RecordBatch, words: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of a packed batch by width: positions and planes (row, bit, word)."""
    column = batch.column("planes").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(column.buffers()[2], np.uint8)
    size = np.diff(offsets)
    for s in np.unique(size):
        rows = np.flatnonzero(size == s)
        own = data[offsets[rows][:, None] + np.arange(s)]
        yield rows, own.view(np.uint64).reshape(len(rows), -1, words)


class Centroids:
    """Integer centroids with their planes; small enough for every task's closure (k vectors)."""

    def __init__(self, values: list[list[int]]):
        self.values = values
        self.words = _words(len(values[0])) if values else 1
        ints = np.array(values, np.int64).reshape(len(values), len(values[0]) if values else 0)
        self.planes = [planes(row[None], int(w))[0] for row, w in zip(ints, widths(ints), strict=True)]
        self.norms = (ints ** 2).sum(axis=1)

    def nearest(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """Cluster and squared distance of each row; ties go to the smaller number."""
        cluster, distance = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
        norm = batch.column("norm").to_numpy()
        for rows, own in _groups(batch, self.words):
            square = norm[rows][:, None] + self.norms[None]
            for c, other in enumerate(self.planes):
                square[:, c] -= 2 * dots(own, other)
            cluster[rows] = best = square.argmin(axis=1)
            distance[rows] = square[np.arange(len(rows)), best]
        return cluster, distance

    def texts(self) -> list[str]:
        return [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in self.values]


def _totals(packed: DataFrame, now: Centroids) -> dict[int, tuple[int, int, list[int]]]:
    """Rows, summed distance and component sums per cluster: partial sums per task, added up on Spark."""
    dims, words = len(now.values[0]), now.words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(now.values)
        count, inertia, sums = np.zeros(k, np.int64), [0] * k, np.zeros((k, dims), object)
        for b in batches:
            cluster, distance = now.nearest(b)
            count += np.bincount(cluster, minlength=k)
            for c in np.unique(cluster):
                inertia[c] += sum(distance[cluster == c].tolist())
            for rows, own in _groups(b, words):
                order = np.argsort(cluster[rows], kind="stable")
                present, starts = np.unique(cluster[rows][order], return_index=True)
                bits = np.unpackbits(own[order].view(np.uint8), axis=2, bitorder="little")[:, :, :dims]
                ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int64)  # (cluster, bit, component)
                sums[present] += np.einsum("cbd,b->cd", ones, weights(own.shape[1])).astype(object)
        held = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held, pa.int32()), pa.array(count[held]), pa.array([str(inertia[c]) for c in held], pa.string()),
             pa.array([[str(x) for x in sums[c]] for c in held], pa.list_(pa.string()))],
            ["cluster", "n", "inertia", "sums"])

    parts = packed.mapInArrow(run, "cluster int, n long, inertia string, sums array<string>")
    number = "decimal(38,0)"
    rows = parts.groupBy("cluster").agg(
        F.sum("n").alias("n"), F.sum(F.col("inertia").cast(number)).alias("inertia"),
        *[F.sum(F.element_at("sums", i + 1).cast(number)).alias(f"s{i}") for i in range(dims)]).collect()
    return {r["cluster"]: (int(r["n"]), int(r["inertia"]), [int(r[f"s{i}"]) for i in range(dims)]) for r in rows}


def _integers(packed: bytes, dims: int) -> list[int]:
    own = np.frombuffer(packed, np.uint64).reshape(-1, _words(dims))
    bits = np.unpackbits(own.view(np.uint8), axis=1, bitorder="little")[:, :dims]
    return (weights(len(own)) @ bits.astype(np.int64)).tolist()


def centroid_clusters(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dims: int = 64,
                      scale: float = 64.0, k: int = 16, rounds: int = 3, salt: str = "1") -> DataFrame:
    """One row per kept vector: ``vec_id``, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia``
    and ``centroid_sha256`` (of the cluster's final integer components, comma-joined).

    Kept are vectors with exactly ``dims`` components, none null or non-finite; a
    component x counts as ``floor(scale * x)``.  Centroids start as the ``k`` kept
    vectors whose ``sha256("<salt>:<id>")`` is smallest (null ids last; rows that
    share an id by squared length, then planes); fewer vectors give fewer
    clusters.  Each round moves a non-empty centroid to the componentwise
    ``floor(sum / count)`` of its vectors, ties going to the smaller number.
    Repeated rows count and return as often as they occur; other columns are
    ignored; an empty table gives no rows.  Components whose squared distances
    would leave 64 bits raise an error rather than give a wrong number.
    """
    packed = materialise(pack_vectors(vectors, id_col, vec_col, dims, scale), "planes")
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    first = packed.orderBy(digest.asc_nulls_last(), "norm", "planes").limit(k).collect()
    now = Centroids([_integers(bytes(r["planes"]), dims) for r in first])
    found: dict[int, tuple[int, int, list[int]]] = {}
    for step in range(rounds + 1 if first else 0):
        found = _totals(packed, now)
        if step < rounds:
            now = Centroids([[s // found[c][0] for s in found[c][2]] if c in found else old
                             for c, old in enumerate(now.values)])
    digests = now.texts()
    own = [found[c][1] if c in found else 0 for c in range(len(digests))]
    total = sum(own)
    if total >= 1 << 63:
        raise OverflowError("the sum of squared distances does not fit 64 bits")
    schema = packed.select("vec_id", F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(c) for c in (
        "distance", "cluster_inertia", "inertia")], F.lit("").alias("centroid_sha256")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inertia, text = np.array(own, np.int64), pa.array(digests, pa.string())
        for b in batches:
            if not b.num_rows:
                continue
            cluster, distance = now.nearest(b)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(distance), pa.array(inertia[cluster]),
                 pa.array(np.full(b.num_rows, total, np.int64)), text.take(pa.array(cluster))], schema.names)

    return packed.mapInArrow(run, schema)
