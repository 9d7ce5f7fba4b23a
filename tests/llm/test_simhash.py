import numpy as np
import xxhash
from conftest import SF_SMALL
from llm_data import make_docs

from plover.llm import simhash as S


def brute_fingerprint(text, size=3):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    grams = [b" ".join(w[i:i + size]) for i in range(max(1, len(w) - size + 1))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, ids, budget=2):
    label = dict(enumerate(range(len(fps))))
    changed = True
    while changed:
        changed = False
        for i in range(len(fps)):
            for j in range(len(fps)):
                if (fps[i] ^ fps[j]).bit_count() <= budget and label[j] < label[i]:
                    label[i] = label[j]
                    changed = True
    out = []
    for i in range(len(fps)):
        mine = [ids[j] for j in range(len(fps)) if label[j] == label[i] and ids[j] is not None]
        out.append(min(mine) if mine else None)
    return out


def check(df, rows):
    got = sorted((r.doc_id is None, r.doc_id or 0, r.fingerprint, r.component_id) for r in df.collect())
    fps = [brute_fingerprint(t) for _, t, _ in rows]
    comp = brute_components(fps, [i for i, _, _ in rows])
    want = sorted((i is None, i or 0, f"{f:016x}", c) for (i, _, _), f, c in zip(rows, fps, comp, strict=True))
    assert got == want


def test_edges(spark, edge_docs, no_docs):
    from llm_data import EDGES

    check(S.simhash_components(edge_docs), EDGES)
    assert S.simhash_components(no_docs).count() == 0
    kept = S.drop_near_copies(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(x for x in ids if x is not None) == [1, 2, 5, 6, 7]  # 3 and 4 link with 2 (no words); one row of id 1
    assert ids.count(None) == 1  # the row with words of its own
    assert S.drop_near_copies(no_docs).count() == 0


def test_near_copies_form_chains(spark):
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in rng.integers(0, 5000, 400)]
    rows = []
    for k in range(60):
        w = list(base)
        for _ in range(k % 7):
            w[rng.integers(0, len(w))] = "changed"
        rows.append((100 - k, " ".join(w), "en"))
    rows += [(1000 + k, " ".join(f"v{i}" for i in rng.integers(0, 5000, 50)), "en") for k in range(30)]
    check(S.simhash_components(make_docs(spark, rows)), rows)


def test_trie_finds_all_pairs():
    rng = np.random.default_rng(2)
    for budget in (1, 2, 3):
        seeds = rng.integers(0, 2**63, 20, dtype=np.uint64)
        many = np.unique(np.concatenate([seeds, *[s ^ (np.uint64(1) << rng.integers(0, 64, 30, dtype=np.uint64)) for s in seeds]]))
        group = np.zeros(len(many), np.int64)
        got = {tuple(sorted(p)) for a, b in S.trie_links(many, group, budget) for p in zip(a.tolist(), b.tolist(), strict=True)}
        want = {(i, j) for i in range(len(many)) for j in range(i + 1, len(many))
                if int(many[i] ^ many[j]).bit_count() <= budget}
        assert got == want


def test_bucket_border(spark, monkeypatch):
    """Buckets that go on from batch to batch are joined whole."""
    monkeypatch.setattr(S, "BUCKET_ROWS", 1)
    fps = spark.createDataFrame([((1 << 40) + (1 << b),) for b in range(30)] + [(1 << 40,)], "fp long")
    roots = S.components(S.link_forest(fps, "fp", 2)).collect()
    assert {r.root for r in roots} == {1 << 40} and len(roots) == 30


def test_query_on_tables(spark):
    import __spark_entry__ as entry

    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    check(entry.queries()["op6_simhash_components"](spark, SF_SMALL), docs)
