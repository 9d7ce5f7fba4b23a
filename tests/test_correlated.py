"""The correlation graph and its greedy elimination."""

import itertools
import random

import numpy as np

from plover.operators import correlated as C


def test_chain_drops_the_middle(spark):
    rng = np.random.default_rng(1)
    a, c = rng.normal(size=(2, 400))
    rows = [(float(x), float((x + y) / 2), float(y), 7.0, "k") for x, y in zip(a, c, strict=True)]
    rows += [(None, 1.0, 1.0, 7.0, "k"), (float("nan"), 1.0, 1.0, 7.0, "k")]
    df = spark.createDataFrame(rows, "a double, b double, c double, still double, key string")
    kept, decisions = C.drop_correlated(df, ["a", "b", "c", "still"], 0.6)
    assert kept.columns == ["a", "c", "still", "key"] and kept.count() == 402
    b = decisions[1]
    assert (b.column, b.kept, b.step, b.n_links) == ("b", False, 0, 2) and b.partner in ("a", "c")
    assert all(d.kept for d in decisions if d.column != "b")
    assert C.drop_correlated(df.limit(0), ["a", "b", "c", "still"], 0.6)[0].columns == df.columns


def test_thinning_leaves_no_link_and_follows_column_order():
    rng = random.Random(2)
    for _ in range(200):
        cols = [f"c{i}" for i in range(rng.randrange(1, 8))]
        edges = {p: rng.choice([0.6, -0.7, 0.9]) for p in itertools.combinations(cols, 2) if rng.random() < 0.4}
        out = C.thin(cols, edges)
        assert [d.column for d in out] == cols
        kept = {d.column for d in out if d.kept}
        assert not any(a in kept and b in kept for a, b in edges)
        gone = sorted((d for d in out if not d.kept), key=lambda d: d.step)
        left = set(cols)
        for d in gone:
            links = {c: sum(1 for a, b in edges if c in (a, b) and {a, b} <= left) for c in left}
            assert links[d.column] == d.n_links == max(links.values()) > 0
            assert d.column == max((c for c in left if links[c] == d.n_links), key=cols.index)
            left.remove(d.column)
    assert [d.column for d in C.thin(["x", "y"], {("x", "y"): 1.0}) if d.kept] == ["x"]


def test_wide_tables_give_the_same_graph(spark, monkeypatch):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(300, 12))
    x = base @ rng.normal(size=(12, 50))
    cols = [f"c{i}" for i in range(50)]
    df = spark.createDataFrame(x.tolist(), ", ".join(f"{c} double" for c in cols))
    wide = C.correlation_edges(df, cols, 0.5)
    want = {(cols[i], cols[j]) for i in range(50) for j in range(i + 1, 50) if abs(np.corrcoef(x.T)[i, j]) >= 0.5}
    assert set(wide) == want and want
    monkeypatch.setattr(C, "WIDE", 100)
    some = cols[:20]
    narrow = C.correlation_edges(df, some, 0.5)
    assert set(narrow) == {(a, b) for a, b in want if a in some and b in some}
