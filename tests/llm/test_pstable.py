import math

import numpy as np
from conftest import SF_SMALL

from plover.llm import pstable as P


def brute(rows, k=10, every=100):
    """Exact neighbours per (query id, vector); candidates as the docstring says."""
    ok = [(i, v) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    if not ok:
        return {}
    sizes = [len(v) for _, v in ok]
    dims = min(set(sizes), key=lambda s: (-sizes.count(s), s))
    own = sorted({(i is None, i or 0, tuple(np.float32(v).tolist())) for i, v in ok if len(v) == dims})
    mat = np.array([v for _, _, v in own])
    out = {}
    for null, i, v in own:
        if null or i % every:
            continue
        d = np.sqrt(((mat - np.array(v)) ** 2).sum(axis=1))
        near = sorted((x, n, j) for x, (n, j, _) in zip(d.tolist(), own, strict=True) if n or j != i)
        out[i, v] = [(None if n else j, x) for x, n, j in near[:k]]
    return out


def result(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


def frame(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return df.selectExpr("*", "1 AS vec", "2 AS shard", "3 AS rank", "4 AS query_id", "5 AS score")


def recall(got, want):
    hit = sum(len({j for _, j, _ in got.get(i, [])} & {j for j, _ in near}) for (i, _), near in want.items())
    return hit / sum(len(x) for x in want.values())


def test_probe_order():
    for bits in (2, 4, 7):
        sets = P.probe_sets(bits, 3 ** bits)
        assert len(sets) == 3 ** bits == len(np.unique(sets, axis=0)) and not sets[0].any()
        assert not (sets[:, :bits] & sets[:, :bits - 1:-1]).any()  # never both borders of a direction
    hashes = P.Hashes(20, 3, 5, 2.0, 3 ** 5)
    v = np.random.default_rng(1).normal(size=(40, 20))
    for t in range(3):
        keys, (cell, place) = hashes.probe_keys(v, t), hashes.cells(v, t)
        assert (keys[:, 0] == hashes.keys(v, t)).all()
        for i in range(40):  # all buckets one step away, in ascending order of the crossed borders' distances
            step = np.stack(np.meshgrid(*[[-1, 0, 1]] * 5), -1).reshape(-1, 5)
            cost = (np.where(step < 0, place[i], np.where(step > 0, 1 - place[i], 0)) ** 2).sum(axis=1)
            want = dict(zip(((cell[i] + step) @ hashes.mult[t]).tolist(), cost.tolist(), strict=True))
            got = [want[x] for x in keys[i].tolist()]
            assert len(set(keys[i].tolist())) == 3 ** 5 and (np.diff(got) >= -1e-12).all()


def test_edges(spark):
    rng = np.random.default_rng(2)
    nan, inf = float("nan"), float("inf")
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(400)]
    hot = rows[100][1]
    rows += [(1000 + i, hot) for i in range(300)]  # equal vectors: the smallest ids, whatever their number
    rows += [rows[0]] * 50 + [(None, rows[5][1]), (200, rows[7][1])]  # repeated rows, null id, an id with two vectors
    rows += [(2000, None), (2100, []), (2200, [0.0] * 8), (2300, [nan] * 8), (2400, [inf] * 8), (2500, [None] * 8),
             (2600, [1.0] * 9), (2700, [1e30] * 8)]
    want = brute(rows)
    for parts in (1, 5):
        got = result(P.nearest(frame(spark, rows).repartition(parts)))
        assert set(got) == {i for i, _ in want}
        for (i, _), near in want.items():
            if i == 200:
                assert sorted(r for r, _, _ in got[i]) == sorted([*range(1, 11)] * 2)
                continue
            assert [r for r, _, _ in got[i]] == list(range(1, 11))
            assert [s for _, _, s in got[i]] == sorted(s for _, _, s in got[i])
        assert recall({i: g for i, g in got.items() if i != 200}, {k: v for k, v in want.items() if k[0] != 200}) >= 0.9
        assert [j for _, j, _ in got[1000]] == [100, *range(1001, 1010)] and got[1000][0][2] == 0.0
    few = rows[:7]
    assert result(P.nearest(frame(spark, few))) == {0: [(n + 1, j, s) for n, (j, s) in enumerate(brute(few)[0, tuple(few[0][1])])]}
    assert P.nearest(frame(spark, rows).limit(0)).collect() == []
    assert P.nearest(frame(spark, [(1, None), (100, [0.0])])).collect() == []
    assert P.nearest(frame(spark, [(100, [1.0, 2.0])])).collect() == []


def test_shards_do_not_change_the_result(spark, monkeypatch):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(5, 12))
    rows = [(i, (centres[i % 5] + rng.normal(0, 0.1 + (i % 3) / 3, 12)).astype(np.float32).tolist()) for i in range(1500)]
    one = result(P.nearest(frame(spark, rows), every=10))
    monkeypatch.setattr(P, "SPLIT_ROWS", 100)
    monkeypatch.setattr(P, "SHARD_ROWS", 130)
    monkeypatch.setattr(P, "MARKS", 500)
    monkeypatch.setattr(P, "PAIRS", 50)
    assert result(P.nearest(frame(spark, rows), every=10)) == one
    assert recall(one, brute(rows, every=10)) >= 0.9


def test_short_queries_are_answered_exactly(spark, monkeypatch):
    """With one probe of narrow cells most queries find too few candidates; the exact pass answers them."""
    monkeypatch.setattr(P, "fit", lambda *a: P.Hashes(8, 1, 8, 0.05, 1))
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(300)]
    got = result(P.nearest(frame(spark, rows)))
    assert {i: [(j, s) for _, j, s in g] for i, g in got.items()} == {i: near for (i, _), near in brute(rows).items()}


def test_recall_on_tables(spark):
    import __spark_entry__ as entry

    for sf in (SF_SMALL, "/root/testdata/sf0.01"):
        rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
        got = result(entry.queries()["op12_nearest"](spark, sf))
        assert recall(got, brute(rows)) >= 0.9
