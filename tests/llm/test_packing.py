import itertools
import random

import numpy as np
import public_tokenizers
import tokenizers
from llm_data import EDGES, make_docs

from plover.llm import packing as P
from plover.llm.queries import TOKENIZER
from plover.llm.tokens import token_counts


def test_boundaries_are_optimal():
    rng = random.Random(5)
    for _ in range(200):
        n = rng.randrange(1, 9)
        length, count, k = rng.sample(range(40), n), [rng.randrange(1, 9) for _ in range(n)], rng.randrange(1, 6)

        def padding(b, length=length, count=count):
            return sum(c * (min(x for x in b if x >= v) - v) for v, c in zip(length, count, strict=True))

        others = sorted(set(length) - {max(length)})
        best = min(padding([*s, max(length)]) for r in range(min(k, n)) for s in itertools.combinations(others, r))
        got = P.boundaries(np.array(length), np.array(count), k)
        assert padding(got) == best and len(got) <= k
    assert P.boundaries(np.zeros(0, int), np.zeros(0, int), 3) == []


def test_batches(spark, edge_docs, no_docs):
    rng = random.Random(6)
    rows = [(i, "w " * rng.randrange(0, 130), "en") for i in range(700)] + [(900, "w " * 500, "en"), (901, "w " * 500, "en")]
    got = P.pack(P.spaced_words(make_docs(spark, rows)), budget=256, buckets=4).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        assert r.padding == r.bucket_len - r.n_tokens >= 0
        by.setdefault((r.bucket, r.batch), []).append(r)
    for (bucket, batch), own in by.items():
        if own[0].n_tokens > 256:
            assert len(own) == 1 and own[0].padding == 0
            continue
        full = 256 // own[0].bucket_len
        last = max(b for k, b in by if k == bucket)
        assert len(own) == full if batch < last else len(own) <= full
    for bucket in {k for k, _ in by}:  # batches are numbered without gaps
        assert sorted(b for k, b in by if k == bucket) == list(range(sum(1 for k, _ in by if k == bucket)))
    assert P.pack(P.spaced_words(no_docs)).count() == 0
    edge = P.pack(P.spaced_words(edge_docs)).collect()
    assert len(edge) == len(EDGES)
    assert sorted(r.n_tokens for r in edge) == sorted(len((t or "").split(" ")) if t and t.strip() else 0 for _, t, _ in EDGES)


def test_batches_hold_library_tokens(spark, edge_docs):
    path = public_tokenizers.path(TOKENIZER)
    tokenizer = tokenizers.Tokenizer.from_file(path)
    got = P.pack(token_counts(edge_docs, path), budget=64).collect()
    assert sorted(r.n_tokens for r in got) == sorted(
        len(tokenizer.encode(t or "", add_special_tokens=False).ids) for _, t, _ in EDGES)
    assert all(r.n_tokens > 64 or (r.batch >= 0 and 64 // max(r.bucket_len, 1) >= 1) for r in got)


def test_null_lengths_are_empty(spark):
    got = P.pack(spark.createDataFrame([(1, None), (2, 5), (None, 0)], "doc_id long, n_tokens long")).collect()
    assert sorted(r.n_tokens for r in got) == [0, 0, 5]
