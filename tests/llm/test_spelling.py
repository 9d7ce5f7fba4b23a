import random
import re
import zlib
from collections import Counter

import pytest
from conftest import SF_SMALL
from llm_data import EDGES, make_docs

from plover.llm import spelling as S


def count(rows, noise=199):
    n = Counter()
    for i, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if noise and h % noise == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            n[run] += 1
    return n


def brute(rows, least=6, enough=5, ratio=5, noise=199):
    n = {w: c for w, c in count(rows, noise).items() if len(w) >= least and c >= enough}
    holes = {}  # word with one letter masked or taken out -> words
    for w in n:
        for i in range(len(w)):
            holes.setdefault((w[:i], w[i + 1:], 1), set()).add(w)
            holes.setdefault((w[:i] + w[i + 1:],), set()).add(w)
    near = {w: set() for w in n}
    for key, own in holes.items():
        if len(key) == 3:
            for w in own:
                near[w] |= own - {w}
        elif key[0] in n:
            near[key[0]] |= own
            for w in own:
                near[w].add(key[0])
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def typo_rows():
    rng = random.Random(7)
    stems = ["anchor", "Überfluß", "garçons", "kitten", "kitchens", "a" * 9, "abababab", "straße", "thÿmes", "öäüöäü", "x" * 700]
    rows = []
    for d in range(300):
        words = []
        for _ in range(80):
            w = rng.choice(stems)
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
                i, c = rng.randrange(len(w)), rng.choice("abÀÿx")
                w = rng.choice([w[:i] + w[i + 1:], w[:i] + c + w[i:], w[:i] + c + w[i + 1:], w + c])
            words.append(rng.choice([w, w.upper() if w.isascii() else w]))
        rows.append((rng.choice([None, d, d]), rng.choice([" ", "1", ", ", "_"]).join(words), "en"))
    return rows


def test_variants(spark, typo_rows):
    docs = make_docs(spark, typo_rows)
    want = brute(typo_rows)
    assert result(S.spelling_variants(docs)) == want
    assert any(r[1] and r[2] != r[1] for r in want)  # a chain of forms
    assert result(S.spelling_variants(docs.repartition(7), noise=3, count=4, ratio=2)) == brute(typo_rows, 6, 4, 2, 3)


def test_large_groups_and_block_borders(spark, typo_rows, monkeypatch):
    monkeypatch.setattr(S, "GROUP_WORDS", 3)
    monkeypatch.setattr(S, "BLOCK_WORDS", 2)
    monkeypatch.setattr(S, "SET_BYTES", 64)
    assert result(S.spelling_variants(make_docs(spark, typo_rows))) == brute(typo_rows)


def test_edges(spark, edge_docs, no_docs):
    assert result(S.spelling_variants(edge_docs, least=3, count=1)) == brute(EDGES, 3, 1)
    assert S.spelling_variants(no_docs).collect() == []
    assert S.spelling_variants(make_docs(spark, [(1, None, None), (2, "", None)])).collect() == []
    assert S.spelling_variants(no_docs).dtypes == [("word", "string"), ("form", "string"), ("root", "string"), ("n", "bigint"),
                                                   ("n_near", "bigint"), ("form_n", "bigint")]


def test_query_on_tables(spark):
    import __spark_entry__ as entry

    rows = [(r.doc_id, r.text, None) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert result(entry.queries()["op13_spelling_variants"](spark, SF_SMALL)) == brute(rows)
