import hashlib
import random

import pytest
from llm_data import EDGES, make_docs

from plover.llm import repeats as R


def brute(texts, length):
    """(bytes, removed, runs, digest of the rest) of every text, straight from the definition."""
    raw = [(t or "").encode() for t in texts]
    count = {}
    for x in raw:
        for p in range(len(x) - length + 1):
            count[x[p:p + length]] = count.get(x[p:p + length], 0) + 1
    out = []
    for x in raw:
        gone = bytearray(len(x))
        for p in range(len(x) - length + 1):
            if count[x[p:p + length]] > 1:
                gone[p:p + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        kept = bytes(b for b, g in zip(x, gone, strict=True) if not g)
        out.append((len(x), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def check(spark, rows, length, gram):
    rows = [(i, t, x) for i, (_, t, x) in enumerate(rows)]
    got = R.repeat_report(make_docs(spark, rows), length) if gram == R.GRAM else None
    if got is None:
        docs = make_docs(spark, rows)
        marked = R.mark_repeats(docs, length, "text", "found", gram).select("doc_id", "text", "found").collect()
        got = {}
        for r in marked:
            raw = (r.text or "").encode()
            spans = R.cut_spans([m.asDict() for m in r.found] if r.found else None, length)
            got[r.doc_id] = (len(raw), int((spans[:, 1] - spans[:, 0]).sum()), len(spans),
                             hashlib.sha256(R.kept_bytes(raw, spans)).hexdigest())
    else:
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect()}
    want = brute([t for _, t, _ in rows], length)
    assert [got[i] for i in range(len(rows))] == want


def texts(seed, n=60):
    rng = random.Random(seed)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(300))
    out = []
    for _ in range(n):
        body = "".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(0, 400)))
        if rng.random() < 0.5:
            a = rng.randrange(0, 200)
            cut = list(passage[a:a + rng.randrange(1, 200)])
            if rng.random() < 0.5:
                cut[rng.randrange(len(cut))] = "é"
            body = body[:50] + "".join(cut) + body[50:]
        if rng.random() < 0.2:
            body += "xy" * rng.randrange(1, 120)
        out.append((0, body, "en"))
    return out + [out[0], out[3]]


@pytest.mark.parametrize("hot", [1000, 1])
def test_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(R, "HOT_SLICES", hot)
    monkeypatch.setattr(R, "SLICE", 16)
    check(spark, texts(1), 60, 8)


def test_small_chunks_cut_long_texts(spark, monkeypatch):
    rows = texts(2) + [(0, texts(3)[0][1] * 9, "en")]
    monkeypatch.setattr(R, "CHUNK_BYTES", 500)
    monkeypatch.setattr(R, "SLICE", 16)
    check(spark, rows, 60, 8)
    data = R.np.frombuffer("".join(t for _, t, _ in rows).encode(), R.np.uint8)
    whole = R.windows(data, R.np.array([0, len(data)]), 60, 8)
    assert whole[2].sum() == len(data) - 59  # every start has one window


def test_edges(spark, edge_docs, no_docs):
    check(spark, EDGES, 400, R.GRAM)
    assert R.repeat_report(no_docs).count() == 0
    kept = R.remove_repeats(edge_docs, 400, chars_col="n_chars")
    assert kept.columns == edge_docs.columns and kept.count() == len(EDGES)
    assert R.repeat_report(edge_docs).count() == len(EDGES)


@pytest.mark.parametrize("length", [R.SLICE, 40, 1])
def test_short_lengths_are_refused(edge_docs, length):
    with pytest.raises(ValueError, match="exceed"):
        R.repeat_report(edge_docs, length)
    with pytest.raises(ValueError, match="exceed"):
        R.remove_repeats(edge_docs, length)


def test_interval_expansion():
    rng = random.Random(4)
    for _ in range(40):
        base = bytes(rng.choice(b"abc") for _ in range(200))
        pieces = [base[a:a + rng.randrange(1, 90)] for a in (rng.randrange(0, 150) for _ in range(rng.randrange(1, 9)))]
        length = rng.choice([3, 10, 30])
        places = {}
        for i, x in enumerate(pieces):
            for o in range(len(x) - length + 1):
                places.setdefault(x[o:o + length], []).append((i, o))
        want = sorted(p for v in places.values() if len(v) > 1 for p in v)
        assert sorted(zip(*map(list, R.repeated_starts(pieces, length)), strict=True)) == want
