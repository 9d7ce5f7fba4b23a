import re

import pytest
from llm_data import EDGES, make_docs

from plover.llm import decontaminate as D

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(docs, items, size=10):
    windows = {}
    for i, t in items:
        w = WORD.findall((t or "").encode().lower())
        n = min(size, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k:k + n]), set()).add(i)
    out = []
    for i, t, _ in docs:
        w, hit, found = WORD.findall((t or "").encode().lower()), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (own := windows.get(tuple(w[k:k + n]))) is not None:
                    found |= own
                    hit.update(range(k, k + n))
        ids = sorted(str(x) for x in found if x is not None)
        out.append((i, len(w), len(hit), ids))
    return out


ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today."), (2, "short item"), (3, "one"),
    (4, None), (5, "..."), (None, "null id item words"), (2, "short item"),
    (10, "a b a b a b a b a b a b a b"), (11, "Ärger über Größe und 漢字 im Text der Frage neun zehn elf"),
]
DOCS = [
    (1, "x the QUICK brown fox; jumps over the lazy dog near the river bank! today y", "en"),
    (2, "quick brown fox jumps over the lazy dog near the", "en"), (3, "brown fox jumps over the lazy dog near", "en"),
    (4, "Short-Item and a short\nitem", "en"), (5, "a b " * 40, "en"), (6, "b a " * 4 + "c a b", "en"),
    (7, "über Größe und 漢字 im Text der Frage neun zehn", "de"), (8, "one two one", "en"), (9, "null id item words", "en"),
    (10, "one " * 3000, "en"), *EDGES,
]


@pytest.mark.parametrize("block", [32 << 20, 40])
def test_against_brute_force(spark, monkeypatch, block):
    """Also with the benchmark searched in several blocks."""
    monkeypatch.setattr(D, "BLOCK_BYTES", block)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = make_docs(spark, [(k, t, x) for k, (_, t, x) in enumerate(DOCS)])
    got = {r.doc_id: (r.doc_id, r.leak_.n_words, r.leak_.n_hit, r.leak_["items"])
           for r in D.scan_leaks(docs, items, out="leak_").collect()}
    want = brute([(k, t, x) for k, (_, t, x) in enumerate(DOCS)], ITEMS)
    assert [got[k] for k in range(len(DOCS))] == want


def test_random_texts(spark):
    import random

    rng = random.Random(3)
    items = [(i, " ".join(rng.choice("abc") for _ in range(rng.randrange(0, 14)))) for i in range(12)]
    docs = [(i, " ".join(rng.choice("abcd") for _ in range(rng.randrange(0, 200))), "en") for i in range(60)]
    got = D.contamination(make_docs(spark, docs), spark.createDataFrame(items, "item_id long, text string"), size=5)
    want = {w[0]: w for w in brute(docs, items, 5)}
    import hashlib

    for r in got.collect():
        _, n, hit, ids = want[r.doc_id]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hit, len(ids), hit > 0)
        assert r.items_sha256 == hashlib.sha256(",".join(ids).encode()).hexdigest()


def test_removal_and_empty_tables(spark, edge_docs, no_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = make_docs(spark, DOCS[:1])
    row = D.remove_leaks(docs, items, chars_col="n_chars").collect()[0]
    assert row.text == "x  y" and row.n_chars == 4
    assert D.remove_leaks(edge_docs, items).columns == edge_docs.columns
    assert D.contamination(no_docs, items).count() == 0
    assert D.contamination(edge_docs, items.limit(0)).filter("contaminated").count() == 0


def test_index_finds_and_locates():
    import numpy as np

    rng = np.random.default_rng(1)
    seq = rng.integers(0, 4, 400)
    seq[-1] = 0
    index = D.FMIndex(seq, 3)
    for n in (1, 2, 4):
        phrases = np.unique(rng.integers(1, 4, (30, n)), axis=0)
        which, low, high = index.search(phrases)
        got = {(w, int(p)) for w, a, b in zip(which.tolist(), low, high, strict=True) for p in index.locate(np.arange(a, b))}
        want = {(w, i) for w, x in enumerate(phrases.tolist()) for i in range(len(seq) - n + 1) if seq[i:i + n].tolist() == x}
        assert got == want
