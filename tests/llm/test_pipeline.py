from conftest import SF_SMALL

import corpus_pipeline as C
from llm_data import make_docs
from plover.llm.simhash import simhash_components


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    before = docs.count()
    for name, stage in C.STAGES[:-1]:
        out = C.materialise(stage(spark, docs, SF_SMALL), "test-" + name)
        assert out.columns == docs.columns and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
        assert 0 < out.count() <= before
        if name == "simhash_near_dedup":
            assert out.count() == simhash_components(docs).select("component_id").distinct().count()
        assert out.filter("n_chars <> length(text)").count() == 0
        docs, before = out, out.count()
    packed = C.STAGES[-1][1](spark, docs, SF_SMALL)
    assert packed.count() == before


def test_stages_on_empty_and_odd_rows(spark, edge_docs):
    plain = edge_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in C.STAGES:
        assert stage(spark, plain, SF_SMALL).count() >= 0
        assert stage(spark, make_docs(spark, [(1, "x", "en")], clashes=False).limit(0), SF_SMALL).count() == 0


def test_repeat_stage_cuts_passages_of_over_fifty_words(spark):
    passage = " ".join(f"word{chr(97 + i % 26)}" for i in range(51))  # 305 bytes, fewer than operator 3's 400
    rows = [(i, f"start {i} of its own {i * 7919} {passage} end {i * 104729} of the text", "en") for i in range(6)]
    rows += [(10 + i, " ".join(f"q{i}z{j}" for j in range(80)), "en") for i in range(4)]
    docs = make_docs(spark, rows, clashes=False)
    got = {r.doc_id: r.text for r in dict(C.STAGES)["suffix_array_dedup"](spark, docs, SF_SMALL).collect()}
    assert all(got[i] == f"start {i} of its own {i * 7919}{i * 104729} of the text" for i in range(6))
    assert all(got[10 + i] == rows[6 + i][1] for i in range(4))


def test_quality_stage_keeps_the_same_rows_when_the_model_is_in_shards(spark, monkeypatch):
    """A model beyond the bounds of the tasks is as whole as one below: no gram is left out, and the stage's rows are the same."""
    from plover.llm import gram_shards, quality

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = sorted(map(repr, C.quality(spark, docs, SF_SMALL).collect()))
    for module, name, value in ((quality, "MOST_WORDS", 50), (quality, "MOST_GRAMS", 60), (gram_shards, "SHARD_TOKENS", 1 << 13),
                                (gram_shards, "CHUNK_TOKENS", 1 << 13)):
        monkeypatch.setattr(module, name, value)
    got = C.quality(spark, docs, SF_SMALL)
    assert got.columns == docs.columns and sorted(map(repr, got.collect())) == want and 0 < len(want) < docs.count()
