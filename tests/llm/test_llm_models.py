import collections
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_SMALL
from llm_data import EDGES, make_docs

import __spark_entry__ as entry
from plover.llm import gram_shards, langid, neural_lm, quality
from plover.llm.common import SPACED_WORD, text_bytes, words
from plover.llm.ngrams import KneserNey, gram_counts, padded


def sequence(texts, order):
    symbol = np.array([ord(c) for t in texts for c in t], np.uint64)
    row = np.array([i for i, t in enumerate(texts) for _ in t], np.int64)
    return padded(symbol, row, len(texts), order)


def test_kneser_ney_sums_to_one():
    texts = ["abracadabra", "abcabcabc", "dabba", "cab"]
    model = KneserNey([gram_counts(*sequence(texts, 3), 3)], 3)
    for start in ("", "a", "ab", "zz", "da"):
        total = 0.0
        for c in [*"abcdr", None]:
            seq, owner = sequence([start + (c or "")], 3)
            place = len(start) if c is None else len(start)
            total += math.exp(model.log_probabilities(seq, owner)[place, 0])
        unknown = math.exp(model.log_probabilities(*sequence([start + "q"], 3))[len(start), 0])
        assert total + unknown == pytest.approx(1.0, abs=1e-5)


def test_models_share_one_table():
    """Two models in one table score as each alone (but for the shared unknown-symbol floor)."""
    a, b = ["banana band", "bandana"], ["cocoa coconut", "cocoon"]
    order = 3
    both = KneserNey([gram_counts(*sequence(t, order), order) for t in (a, b)], order)
    seq, owner = sequence(["banana", "cocoa"], order)
    total, count = both.row_sums(seq, owner, 2)
    assert count.tolist() == [7, 6] and total[0, 0] > total[0, 1] and total[1, 1] > total[1, 0]
    pieces, _ = both.row_sums(seq, owner, 2, piece=3)
    assert np.allclose(total, pieces)


def test_language_held_out_accuracy(spark):
    got = entry.queries()["op8_language"](spark, SF_SMALL).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) >= 0.95


def test_language_edges(spark, edge_docs, no_docs):
    got = langid.language_report(edge_docs).collect()
    assert len(got) == len(EDGES)
    for r in got:
        assert r.lang_pred in ("de", "en", "fr", "und")
    blank = langid.identify(edge_docs, langid.train(edge_docs, "text", "lang")).filter("lang_pred = 'und'").collect()
    assert len(blank) == sum(1 for _, t, _ in EDGES if not any(c.isalpha() for c in t or "")) and all(r.score == 0 for r in blank)
    assert langid.language_report(no_docs).count() == 0
    nothing = langid.identify(edge_docs, langid.train(no_docs, "text", "lang")).select("lang_pred").distinct().collect()
    assert [r.lang_pred for r in nothing] == ["und"]


def test_every_language_is_learned(spark):
    """One text in hundreds of copies, twenty texts that each exceed the bound, and a language of one short text."""
    rng = np.random.default_rng(5)
    say = lambda words, n: " ".join(words[x] for x in rng.integers(0, len(words), n))
    rows = [("en", say(["the", "house", "with", "garden", "river"], 40)) for _ in range(300)]
    rows += [("fr", say(["maison", "avec", "jardin", "fleuve", "toujours"], 40)) for _ in range(300)]
    rows += [("xx", "zuqq wokk pyxx qazz " * 50)] * 400 + [("yy", "hjå ðvø þæk ")]
    rows += [("zz", say(["bdgb", "kptk", "vwmv"], 6000)) for _ in range(20)]
    docs = spark.createDataFrame([(i, t, x) for i, (x, t) in enumerate(rows)], "doc_id long, text string, lang string")
    model = langid.train(docs, "text", "lang", sample_bytes=20_000)
    assert model.languages == ["en", "fr", "xx", "yy", "zz"]
    got = langid.identify(docs, model).join(docs, "doc_id").groupBy("lang").agg({"lang_pred": "max", "*": "count"})
    assert all(r["max(lang_pred)"] == r["lang"] for r in got.collect())
    assert langid.identify(docs, model).join(docs, "doc_id").filter("lang_pred <> lang").count() == 0


@pytest.mark.parametrize("bound,fewest", [(0, 1), (500, 3), (10_000, 5), (10**9, 5)])
def test_hash_sample_against_brute_force(spark, bound, fewest):
    rng = np.random.default_rng(bound + fewest)
    rows = [(x, int(u), int(u) % 900 + 1) for x, n in (("a", 3000), ("b", 40), ("c", 2)) for u in rng.integers(0, 1 << 63, n)]
    rows += rows[:500] + [("d", 0, 7), ("d", (1 << 63) - 1, 7)]
    want = set()
    for key in "abcd":
        size = 0
        for i, (u, n) in enumerate(sorted({r[1:] for r in rows if r[0] == key})):
            if size < bound or i < fewest:
                want.add((key, u))
            size += n
    df = spark.createDataFrame(rows, "lang string, u long, size long")
    got = langid.hash_sample(df, "lang", bound, fewest).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_quality_rejects_junk_and_keeps_clean(spark):
    rng = np.random.default_rng(3)
    word = [f"word{i}" for i in range(60)]
    clean = [(i, " ".join(word[x] for x in rng.zipf(1.5, 80) % 60), "en") for i in range(400)]
    junk = [(1000 + i, " ".join(f"J{rng.integers(0, 10**9)}!!" for _ in range(60)), "en") for i in range(40)]
    docs = make_docs(spark, clean + junk + EDGES)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 400, 2)] + [(1001, 0, 0), (None, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    kept = {r.doc_id for r in quality.quality_report(docs, labels).collect() if r["keep"]}
    assert len([i for i in range(400) if i in kept]) >= 392 and not [i for i in range(1000, 1040) if i in kept]
    rows = quality.keep_good(docs, labels)
    assert rows.columns == docs.columns and rows.filter("doc_id < 400").count() >= 392


def test_quality_learns_every_language(spark):
    """A language of one trusted text in many copies, whichever fold its hash falls into, next to larger ones."""
    say = lambda seed, n: " ".join(f"k{x}" for x in np.random.default_rng(seed).integers(0, 50, n))
    rows = [(i, say(i, 60), "en") for i in range(200)]
    alone = {x: f"{x} sole text of its kind, written again and again " * 4 for x in "abcdefgh"}
    rows += [(1000 + 50 * k + i, t, x) for k, (x, t) in enumerate(alone.items()) for i in range(40)]
    labels = spark.createDataFrame([(i, 1, 0) for i, _, _ in rows], "doc_id long, quality int, toxic int")
    docs = make_docs(spark, rows)
    ppl = {r.id: r.ppl for r in quality.fit(docs, labels, sample_bytes=2_000).scores.collect()}
    # a learned text is far likelier than words in a random order
    assert max(ppl[i] for i in ppl if i >= 1000) < np.median([ppl[i] for i in ppl if i < 200])


def test_quality_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, None)], "doc_id long, quality int, toxic int")
    got = quality.quality_report(edge_docs, labels).collect()
    assert len(got) == len(EDGES) and all(r.perplexity > 0 for r in got)
    assert quality.quality_report(no_docs, labels).count() == 0
    free = quality.quality_report(edge_docs, labels.limit(0)).collect()
    assert all(r["keep"] and r.bound is None for r in free)


def brute_base(rows):
    tokens = [(i, [*(t or "").encode().lower().split(), None]) for i, t, _ in rows]
    held = [i is None or zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in tokens]
    count = collections.Counter(w for (_, ws), out in zip(tokens, held, strict=True) if not out for w in ws)
    n, v = sum(count.values()), len(count)
    return [(i, out, len(ws), sum(count[w] > 0 for w in ws), n, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws))
            for (i, ws), out in zip(tokens, held, strict=True)]


@pytest.mark.parametrize("common", [1 << 16, 5])
def test_corpus_counts_are_exact(spark, edge_docs, no_docs, monkeypatch, common):
    """Also where nearly all counts come through the join."""
    monkeypatch.setattr(neural_lm, "COMMON", common)
    got = neural_lm.lm_scores(edge_docs).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[2], x[5])
    mine = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=key)
    for a, b in zip(mine, sorted(brute_base(EDGES), key=key), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5])
    assert all(r.score < 0 or r.train_tokens == 0 for r in got)
    assert neural_lm.lm_scores(no_docs).count() == 0


def test_learning_rows_hold_the_training_tokens_only(spark):
    docs = spark.createDataFrame([(1, False, "b a b"), (2, True, "a a a a"), (3, False, None), (4, True, "c")],
                                 "doc_id long, held_out boolean, text string").coalesce(1)
    blocks = neural_lm._blocks(docs).persist()
    vocab = neural_lm.Words(neural_lm._word_counts(blocks))
    shared = spark.sparkContext.broadcast(vocab)
    (r,) = neural_lm._learning(blocks, shared).collect()
    word = neural_lm._unpack(bytes(r.words), r.n)
    assert (r.texts, r.n, neural_lm._unpack(bytes(r.sizes), 2).tolist()) == (2, 5, [4, 1])
    assert word[0] == word[2] != word[1] and word[3] == word[4] and len(set(word.tolist())) == 3 and word.min() >= 2
    assert neural_lm._learning(blocks.filter("false"), shared).count() == 0
    assert neural_lm._learning(neural_lm._blocks(docs.filter("held_out")), shared).count() == 0


def test_parameters_are_averaged_by_visited_tokens(spark):
    piece = lambda *x: np.array(x, np.float16).tobytes()
    rows = [(0, 0, 1, piece(0, 4)), (0, 0, 3, piece(4, 0)), (0, 1, 4, piece(1, 9)), (8, 1, 2, piece(5))]
    kind = "at long, visited long, part binary"
    df = spark.createDataFrame(rows, "at long, group long, visited long, part binary")
    got = (df.groupBy("at", "group").applyInArrow(neural_lm._average, kind).groupBy("at")
           .applyInArrow(neural_lm._average, kind).orderBy("at").collect())
    assert [(r.at, r.visited, np.frombuffer(r.part, np.float16).tolist()) for r in got] == [(0, 8, [2.0, 5.0]), (8, 2, [5.0])]


def test_model_is_normalised_and_beats_the_base(spark):
    got = entry.queries()["op5_lm_scores"](spark, SF_SMALL).collect()
    rows = [(r.doc_id, r.text, None) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    want = {r[0]: r for r in brute_base(rows)}
    for r in got:
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][1:5]
        assert r.base_score == pytest.approx(want[r.doc_id][5])
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    share = np.array([0.2, 0.0, 0.5, 0.3])
    model = neural_lm.LogBilinear(share)
    wide = neural_lm.VOCABULARY + 2
    for context in (0, 2 * wide + 3, wide + 1):
        p = np.exp(model.log_probabilities(np.full(3, context), np.array([0, 2, 3])))
        assert p.sum() == pytest.approx(1.0, abs=1e-5)


def test_vocabulary_grows_and_words_of_a_class_are_normalised():
    assert neural_lm.least_count(4_000_000) == 20 and neural_lm.least_count(1000) == neural_lm.FEWEST
    rng = np.random.default_rng(1)
    share = np.concatenate([[0.1, 0.0], np.sort(rng.random(1998))[::-1]])
    model = neural_lm.LogBilinear(share / share.sum())
    word = np.tile([1200, 1900], 4000)  # two words beyond the VOCABULARY commonest, each sure after the other
    context = np.full(len(word), neural_lm.START * model.wide) + word[::-1]
    assert model.train(context, word, 0) == len(word)
    every = np.array([i for i in range(2000) if i != neural_lm.START])
    p = {}
    for before in (1200, 1900):
        p[before] = np.exp(model.log_probabilities(np.full(len(every), neural_lm.START * model.wide + before), every))
        assert p[before].sum() == pytest.approx(1.0, abs=1e-3)
    assert (p[1900] != p[1200]).any() and p[1900][every == 1200] > 2 * p[1200][every == 1200]


def small_model(words_=900, seed=4):
    """A model whose classes of several words and parameters differ from their start."""
    rng = np.random.default_rng(seed)
    share = np.concatenate([[0.1, 0.0], np.sort(rng.random(words_ - 2))[::-1]])
    model = neural_lm.LogBilinear(share / share.sum())
    for k in ("out", "inner"):
        table = getattr(model, k)
        table[:, :neural_lm.SIZE] = rng.normal(0, 0.3, (len(table), neural_lm.SIZE))
    return model


def plain_log_probabilities(model, context, word):
    """In double precision, one context at a time."""
    wide = neural_lm.SIZE
    out = []
    for code, w in zip(context.tolist(), word.tolist(), strict=True):
        q = model.near.astype(float) * model.r[code % model.wide] + model.far.astype(float) * model.r[code // model.wide]
        s = model.out[:, :wide].astype(float) @ q + model.out[:, wide]
        s[neural_lm.START] = -np.inf
        c = model.cls[w]
        value = s[c] - s.max() - math.log(np.exp(s - s.max()).sum())
        first, last = model.edges[c:c + 2]
        if last - first > 1:
            t = model.inner[first:last, :wide].astype(float) @ q + model.inner[first:last, wide]
            value += t[w - first] - t.max() - math.log(np.exp(t - t.max()).sum())
        out.append(value)
    return np.array(out)


@pytest.mark.parametrize("steep", [1, 60])
def test_log_probabilities_against_plain_sums(steep):
    """Also where the parts of the two words of a context are beyond single precision."""
    model, rng = small_model(), np.random.default_rng(9)
    model.r[2:40] *= steep
    word = rng.choice([x for x in range(900) if x != neural_lm.START], 3000)
    one, two = rng.integers(0, 900, (2, 3000))
    context = two * model.wide + one
    got, want = model.log_probabilities(context, word), plain_log_probabilities(model, context, word)
    assert np.allclose(got, want, rtol=1e-5, atol=2e-4)


def test_exponentials_are_taken_per_word_and_not_per_context(monkeypatch):
    """40 words before 1600 contexts: far fewer exponentials than contexts times classes."""
    model = small_model(500)
    one, two = (x.reshape(-1) for x in np.meshgrid(np.arange(2, 42), np.arange(2, 42)))
    taken, exp = [], np.exp

    def counted(x, *a, **k):
        taken.append(np.size(x))
        return exp(x, *a, **k)

    monkeypatch.setattr(neural_lm.np, "exp", counted)
    model.log_probabilities(two * model.wide + one, np.full(1600, 7))
    assert sum(taken) < 0.1 * 1600 * len(model.out)


def test_places_are_those_of_a_search():
    rng = np.random.default_rng(2)
    for share in (rng.random(7), np.concatenate([[0.5, 0.0], rng.pareto(1, 3000)]), np.concatenate([np.ones(3), np.full(2000, 1e-9)])):
        upto = np.concatenate([[0.0], np.cumsum(share / share.sum())])
        x = np.concatenate([rng.random(5000), upto, rng.random(500) * 1e-6, 1 - rng.random(500) * 1e-6])
        x = np.minimum(x, upto[-1])
        assert np.array_equal(neural_lm._Places(upto)(x), np.searchsorted(upto, x, "right") - 1)


def test_a_step_sums_repeated_rows():
    model = small_model(600)
    model.train(np.full(4, neural_lm.START * model.wide + 2), np.full(4, 3), 0)
    at = np.array([5, 9, 5, 2, 5, 9])
    grad = np.arange(6 * neural_lm.SIZE, dtype=np.float32).reshape(6, -1)
    before = model.rows["r"].copy()
    want = before.copy()
    for row in set(at.tolist()):
        g = grad[at == row].sum(axis=0) / neural_lm.BATCH
        want[row, neural_lm.SIZE:] += g * g
        want[row, :neural_lm.SIZE] += neural_lm.RATE * g / np.sqrt(want[row, neural_lm.SIZE:])
    model._step("r", at, before[at], grad)
    assert np.allclose(model.rows["r"], want, rtol=1e-5, atol=1e-6) and np.shares_memory(model.r, model.rows["r"])


def test_groups_hold_every_row_in_order():
    assert [list(x) for x in neural_lm._groups([3, 1, 4, 1, 5], int, 4)] == [[3, 1], [4], [1, 5]]
    assert list(neural_lm._groups([1, 2], int, 9)) == [[1, 2]] and not list(neural_lm._groups([], int, 9))


@pytest.mark.parametrize("scored", [1, 1 << 20])
def test_scores_do_not_depend_on_the_blocks_scored_together(spark, edge_docs, monkeypatch, scored):
    monkeypatch.setattr(neural_lm, "CHUNK_BYTES", 40)
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.n_tokens, r.base_score)
    want = [r.score for r in sorted(neural_lm.lm_scores(edge_docs.coalesce(1)).collect(), key=key)]
    monkeypatch.setattr(neural_lm, "SCORED", scored)
    got = [r.score for r in sorted(neural_lm.lm_scores(edge_docs.coalesce(1)).collect(), key=key)]
    assert got == pytest.approx(want, rel=1e-4)


def test_training_visits_every_token():
    before = neural_lm.PARTS * neural_lm.ROUNDS * neural_lm.STEPS * neural_lm.BATCH
    for tokens in (1, 40_000, 4_000_000, 80_000_000, 5 * 10**9):
        n = neural_lm.passes(tokens)
        assert n >= 1 and (n * tokens >= before or n == neural_lm.MOST_PASSES)
    model = neural_lm.LogBilinear(np.array([0.2, 0.0, 0.5, 0.3]))
    assert model.train(np.full(5000, neural_lm.START * model.wide + 2), np.full(5000, 3), 0, 3) == 15_000
    every = np.array([0, 2, 3])
    p = np.exp(model.log_probabilities(np.full(3, neural_lm.START * model.wide + 2), every))
    assert p[2] > 0.5 and p.sum() == pytest.approx(1.0, abs=1e-3)


def test_quality_rejects_one_word_repeated(spark):
    rng = np.random.default_rng(5)
    word = [f"word{i}" for i in range(60)]
    clean = [(i, " ".join(word[x] for x in rng.zipf(1.5, 80) % 60), "en") for i in range(800)]
    dull = [(1000 + i, " ".join([word[1]] * (100 + i)), "en") for i in range(60)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 800)] + [(1000 + i, 0, 0) for i in range(40)],
                                   "doc_id long, quality int, toxic int")
    kept = {r.doc_id for r in quality.quality_report(make_docs(spark, clean + dull), labels).collect() if r["keep"]}
    assert not [i for i in range(1000, 1060) if i in kept] and len([i for i in range(800) if i in kept]) >= 760


def zipf_texts(n, seed=11):
    rng = np.random.default_rng(seed)
    return [" ".join(f"v{x}" for x in rng.zipf(1.3, 50) % 400) for _ in range(n)]


def word_sequence(texts):
    symbol, row, _ = words(*text_bytes(pa.array(texts)), SPACED_WORD)
    return padded(symbol, row, len(texts), 3)


def test_quality_counts_every_trusted_text(spark):
    """Without bounds in the way the model is the Kneser-Ney model of all texts, computed at once."""
    texts = zipf_texts(300)
    got = quality._model(spark.createDataFrame([(t,) for t in texts], "text string").repartition(5))
    want = KneserNey([gram_counts(*word_sequence(texts), 3)], 3)
    probe = [*texts[:20], *zipf_texts(20, 12), "never seen words", "", "v1 v1 v1"]
    a, b = (m.log_probabilities(*word_sequence(probe)) for m in (got.grams, want))
    assert got.rare == 0 and np.allclose(a, b, atol=1e-4)


def test_quality_fit_is_not_bounded_by_bytes(spark):
    """Over 1 MB of trusted text in a language; the old model learned from the first megabyte only."""
    texts = [f"lead{i} " + "filler text of many words " * 60 + f"mark{i} mark{i} mark{i}" for i in range(1200)]
    assert sum(map(len, texts)) > 1_500_000
    docs = make_docs(spark, [(i, t, "en") for i, t in enumerate(texts)])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(len(texts))], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels).arrays.value
    taught = {r.id for r in docs.selectExpr("doc_id AS id", "pmod(xxhash64(text), 5) AS f").filter("f <> 0").collect()}
    known = lambda i: bool(model.grams.knows(words(*text_bytes(pa.array([f"mark{i}"])), SPACED_WORD)[0])[0])
    assert [known(i) for i in range(len(texts))] == [i in taught for i in range(len(texts))]


def token_logs(model, text):
    """Log probability of each word of the text and of its end."""
    symbol, row, _ = words(*text_bytes(pa.array([text])), SPACED_WORD)
    known = model.grams.knows(symbol) if model.rare else np.ones(len(symbol), bool)
    out = model.grams.log_probabilities(*padded(np.where(known, symbol, quality.RARE), row, 1, 3))[:, 0].astype(float)
    out[:-1][~known] -= np.log(model.rare + 1)
    return out


@pytest.mark.parametrize("most_words,most_grams", [(50, 1 << 20), (1 << 19, 300), (60, 200), (3, 4)])
def test_pruned_quality_model_sums_to_one(spark, monkeypatch, most_words, most_grams):
    texts = zipf_texts(200)
    monkeypatch.setattr(quality, "MOST_WORDS", most_words)
    monkeypatch.setattr(quality, "MOST_GRAMS", most_grams)
    model = quality._model(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3))
    every = sorted({w for t in texts for w in t.split()})
    assert len(model.grams.keys[2]) <= most_grams and (model.rare > 0) == (len(every) > most_words)
    for start in ("", "v1", "v1 v2", "v2 v1", "other", texts[0]):
        n = len(start.split())
        p = [math.exp(token_logs(model, f"{start} {w}")[n]) for w in [*every, "other"]]
        assert sum(p) + math.exp(token_logs(model, start)[-1]) == pytest.approx(1.0, abs=1e-4)
    assert model.perplexities(pa.array(texts[:3])) == pytest.approx([np.exp(-token_logs(model, t).mean()) for t in texts[:3]])


def test_least_kept_is_the_smallest_that_fits():
    assert quality.least_kept({}, 5) == 1 and quality.least_kept({1: 3, 2: 2}, 5) == 1
    assert quality.least_kept({1: 3, 2: 2}, 4) == 2 and quality.least_kept({1: 3, 7: 5}, 4) == 8
    assert quality.least_kept({8192: 5, 4095: 1}, 4) == 16384 and quality.least_kept({8192: 4, 3: 1}, 4) == 4


def labelled(spark, texts):
    rows = [(i if i % 9 else None, t, None if i % 7 == 0 else "en" if i % 2 else "de") for i, t in enumerate(texts)]
    labels = spark.createDataFrame([(i, int(i % 5 > 0), 0) for i in range(0, len(texts), 2)], "doc_id long, quality int, toxic int")
    return make_docs(spark, rows), labels


@pytest.mark.parametrize("hot", [2, 4096])
def test_quality_leaves_no_gram_out_beyond_the_bounds(spark, monkeypatch, hot):
    """Perplexities of a model that is too large for the tasks are those of all words and grams."""
    texts = [*zipf_texts(300), "", None, "never seen words", "v1 v1 v1", "v1", *zipf_texts(3)]
    docs, labels = labelled(spark, texts)
    by = lambda df: sorted(((r.doc_id, r.lang, r["keep"], r.perplexity, r.bound) for r in df.collect()), key=repr)
    want = by(quality.quality_report(docs, labels))
    kept = sorted(map(repr, quality.keep_good(docs, labels).collect()))
    for name, value in (("MOST_WORDS", 3), ("MOST_GRAMS", 4)):
        monkeypatch.setattr(quality, name, value)
    for name, value in (("SHARD_TOKENS", 700), ("CHUNK_TOKENS", 1500), ("CHUNK_BYTES", 1000), ("ASKED_BYTES", 4000), ("PART_WORDS", 50), ("HOT", hot)):
        monkeypatch.setattr(gram_shards, name, value)
    got = by(quality.quality_report(docs, labels))
    assert len(want) == len(texts) and [x[:2] for x in got] == [x[:2] for x in want]
    assert np.allclose([x[3:] for x in got], [x[3:] for x in want], rtol=1e-5)
    assert [x[2] for x in got] == [x[2] for x in want]
    assert sorted(map(repr, quality.keep_good(docs, labels).collect())) == kept and 0 < len(kept) < len(texts)


def test_gram_records_hold_their_grams():
    rng = np.random.default_rng(3)
    pair, u = rng.integers(4, 40, 900) << 32 | rng.integers(2, 30, 900), rng.integers(1, 6000, 900)
    grams, count = gram_shards._distinct(pair, u)
    want = collections.Counter(zip(pair.tolist(), u.tolist(), strict=True))
    got = {}
    for s, two, three in grams.split(7):
        back = gram_shards.Grams.of_record(grams.part(two, three).record(s, gram_shards.TEACH))
        assert (gram_shards.dealt(back.pairs, 7) == s).all()
        got |= dict(zip(zip(back.pairs[back.of].tolist(), back.u.tolist(), strict=True), count[three].tolist(), strict=True))
    assert got == want
