import public_tokenizers
import pytest
from llm_data import EDGES, LONG
from tokenizers import Tokenizer

from plover.llm import tokens as K

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "", "a", "aaa aaaa", "a" * 5000, "x<|endoftext|>y<|endoftext|>", "<|endoftext|>", "we'll they've 's 12 3½ Ⅷ",
    " \n\n \t x  ", "漢字かな交じり文 😀👩‍👩‍👧", "ᣘ8 \U00018d88\U00018db6 a", "=" * 300, LONG,
]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    return lambda text: len(t.encode(text, add_special_tokens=False).ids)


def test_counts_equal_the_library(library):
    count = K.Counter(K.MergeTable(PATH))
    assert count(TEXTS) == [library(t) for t in TEXTS]
    assert K.PATTERN == public_tokenizers.PATTERN


def test_full_cache_is_emptied(library, monkeypatch):
    monkeypatch.setattr(K, "CACHE_BYTES", 10)
    count = K.Counter(K.MergeTable(PATH))
    assert [count([t])[0] for t in TEXTS] == [library(t) for t in TEXTS]


def test_operator(spark, edge_docs, no_docs, library):
    got = K.token_counts(edge_docs, PATH).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1], x[2])
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=key) == sorted(
        ((i, len((t or "").encode()), library(t or "")) for i, t, _ in EDGES), key=key)
    assert all(r.over_limit == (r.n_tokens > 512) for r in got)
    assert K.token_counts(no_docs, PATH).count() == 0
