import hashlib
import math

import numpy as np
import pytest
from conftest import SF_SMALL

from plover.llm import bitplanes as B


def brute(rows, dims=64, scale=64, k=16, rounds=3):
    """k-means over Python integers, straight from the contract."""
    kept = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(),
                                        sum(x * x for x in r[1])))
    now = [list(v) for _, v in order[:k]]

    def assign():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in now]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        got = assign()
        for c in range(len(now)):
            own = [v for (_, v), (g, _) in zip(kept, got, strict=True) if g == c]
            if own:
                now[c] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    got = assign()
    return sorted(((i is None, i or 0, g, d, sum(e for h, e in got if h == g), sum(e for _, e in got),
                    hashlib.sha256(",".join(map(str, now[g])).encode()).hexdigest())
                   for (i, _), (g, d) in zip(kept, got, strict=True)))


def result(df):
    return sorted((r.vec_id is None, r.vec_id or 0, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256)
                  for r in df.collect())


def frame(spark, rows, kind="float"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    return df.selectExpr("*", "'x' AS cluster", "1 AS planes", "2 AS norm", "3 AS vec", "4 AS n")  # clashing names


def test_dot_products_are_exact():
    rng = np.random.default_rng(3)
    for dims in (1, 5, 64, 100):
        for high in (1, 2, 40, 1 << 20):
            a, b = (rng.integers(-high, high + 1, (30, dims)) for _ in range(2))
            a[0], b[0] = -high, high
            wide = int(max(B.widths(a).max(), B.widths(b).max()))
            for row in b:
                other = B.planes(row[None], int(B.widths(row[None])[0]))[0]
                assert (B.dots(B.planes(a, wide), other) == a @ row).all()
            assert [B._integers(B.planes(r[None], wide).tobytes(), dims) for r in a] == a.tolist()


def test_edges(spark):
    rng = np.random.default_rng(4)
    nan, inf = float("nan"), float("inf")
    rows = [(i, rng.normal(0, 0.2, 64).astype(np.float32).tolist()) for i in range(120)]
    rows += [(7, rows[7][1])] * 40 + [(None, rows[3][1]), (500, None), (501, []), (502, [0.0] * 63), (503, [0.0] * 65),
                                      (504, [None] * 64), (505, [nan] + [0.0] * 63), (506, [inf] + [0.0] * 63),
                                      (507, [0.0] * 64), (508, [-0.001] * 64), (509, [900.5] * 64), (510, [-1000.25] * 64)]
    for parts in (1, 7):
        assert result(B.centroid_clusters(frame(spark, rows).repartition(parts))) == brute(rows)
    few = rows[:5] + rows[120:125]
    assert result(B.centroid_clusters(frame(spark, few))) == brute(few)
    empty = B.centroid_clusters(frame(spark, rows).limit(0))
    assert empty.collect() == []
    assert empty.dtypes == [("vec_id", "bigint"), ("cluster", "int"), ("distance", "bigint"), ("cluster_inertia", "bigint"),
                            ("inertia", "bigint"), ("centroid_sha256", "string")]
    assert B.centroid_clusters(frame(spark, [(1, None), (2, [])])).collect() == []


def test_other_sizes(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, 3, 70).tolist()) for i in range(60)]
    got = B.centroid_clusters(frame(spark, rows, "double"), dims=70, scale=8, k=4, rounds=2)
    assert result(got) == brute(rows, 70, 8, 4, 2)


def test_too_large_components_are_refused():
    with pytest.raises(OverflowError):
        B.quantise(np.full((1, 64), 1e30), 64)


def test_query_on_tables(spark):
    import __spark_entry__ as entry

    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    assert result(entry.queries()["op11_centroid_clusters"](spark, SF_SMALL)) == brute(rows)
