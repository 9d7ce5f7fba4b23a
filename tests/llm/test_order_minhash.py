import hashlib
import struct

import pytest
import xxhash
from conftest import SF_SMALL
from llm_data import EDGES, make_docs

from plover.llm import order_minhash as O


def xx(*values):
    """Spark's xxhash64: each value hashed with the hash before as the seed (nulls skipped)."""
    h = 42
    for v in values:
        if v is None:
            continue
        raw = v if isinstance(v, bytes) else struct.pack("<q", v) if isinstance(v, int) else struct.pack("<i", v[0])
        h = xxhash.xxh64_intdigest(raw, h)
    return h


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def brute(text, k=5, bins=64):
    w = [signed(xx(x.encode())) for x in [x for x in __import__("re").split(r"[ \t-\r]+", text or "") if x]]
    grams = [signed(xx(*w[i:i + k])) for i in range(max(len(w) - k + 1, 1))] if w else []
    seen, marked = {}, []
    for place, g in enumerate(grams):
        time = seen.get(g, 0)
        seen[g] = time + 1
        marked.append((xx(g, (time,)) >> 24, place))
    out = []
    for b in range(bins):
        # signed order: hashes with the top bit set come first, which keeps bins whole
        low = sorted(m for m in marked if m[0] >> 34 == b)[:2]
        if not low:
            continue
        low.sort(key=lambda m: m[1])
        out.append(b << 24 | xx(*[m[0] for m in low]) & 0xFFFFFF)
    return set(out)


def rows_of(df):
    return [(r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next)
            for r in df.collect()]


def expected(rows):
    texts = sorted(((i is not None, i or 0, t or "") for i, t, _ in rows))
    prints, out = [brute(t) for _, _, t in texts], []

    def like(a, b):
        bins = {x >> 24 for x in a} | {x >> 24 for x in b}
        return len(a & b) / len(bins) if bins else 1.0

    for n, (has, i, t) in enumerate(texts):
        nxt = (n + 1) % len(texts)
        e = len(t) // 4
        edited = t[:len(t) - e] + texts[nxt][2][:e]
        other = brute(edited)
        out.append((i if has else None, len(t), hashlib.sha256(edited.encode()).hexdigest(), prints[n], other,
                    like(prints[n], other), like(prints[n], prints[nxt])))
    return out


def parse(text):
    return {int(text[i:i + 8], 16) for i in range(0, len(text), 8)}


def check(df, rows):
    key = lambda x: (x[0] is None, x[0] or 0, x[1], x[2])
    got = sorted(((i, n, sha, parse(a), parse(b), x, y) for i, n, sha, a, b, x, y in rows_of(df)), key=key)
    want = sorted(expected(rows), key=key)
    for g, w in zip(got, want, strict=True):
        assert g[:5] == w[:5] and g[5:] == pytest.approx(w[5:])


def test_edges_against_brute_force(spark, edge_docs, no_docs):
    check(O.edit_report(edge_docs), EDGES)
    assert O.edit_report(no_docs).count() == 0


def test_tables_against_brute_force(spark):
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    import __spark_entry__ as entry

    check(entry.queries()["op4_order_minhash"](spark, SF_SMALL), rows)


def test_order_matters_and_single_row(spark):
    a = " ".join(f"w{i}" for i in range(400))
    moved = " ".join([f"w{i}" for i in range(200, 400)] + [f"w{i}" for i in range(200)])
    docs = make_docs(spark, [(1, a, "en"), (2, moved, "en")])
    first = O.edit_report(docs).orderBy("doc_id").collect()[0]
    assert first.near_next < 0.9  # a set of shingles would call these 0.98 alike
    alone = O.edit_report(make_docs(spark, [(7, a, "en")])).collect()[0]
    assert alone.near_next == 1.0 and alone.doc_id == 7


def test_no_python_in_the_plan(spark, edge_docs):
    plan = O.edit_report(edge_docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
