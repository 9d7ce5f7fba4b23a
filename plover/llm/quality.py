"""Quality classifier: perplexity under a word-trigram modified Kneser-Ney model of trusted text.

The model learns from every distinct trusted text (one fifth, by hash, is kept apart for
calibration).  Words, bigrams and trigrams of all of them are counted on Spark, and none is left out.  While
there are no more than ``MOST_WORDS`` words and ``MOST_GRAMS`` trigrams as they come, each task holds the whole
model (``_model``).  A larger one stays on Spark in shards, which the texts ask for their counts
(``gram_shards``): the probabilities are the same.
A text is kept while its perplexity lies between a low and a high
quantile of the trusted texts of its language.  Both quantiles are chosen from
``LOWER`` and ``UPPER`` on the calibration texts and held-out texts labelled bad.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plover.llm.common import SPACED_WORD, free_name, materialise, mix, row_chunks, text_bytes, words
from plover.llm.gram_shards import FIRST_WORD, GramShards
from plover.llm.gram_shards import pack as _pack
from plover.llm.gram_shards import unpack as _unpack
from plover.llm.langid import hash_sample
from plover.llm.ngrams import RARE, START, SYMBOL_BITS, KneserNey, discounts, padded
from plover.session import fresh_path, remove_path

ORDER = 3
CHUNK_BYTES = 1 << 20
PART_BYTES = 4 << 20  # bytes of the model in one row on its way to the driver
LOWER = (0.0, 0.005, 0.01, 0.02)  # 0: no lower bound
UPPER = (0.99, 0.98, 0.95)
LEAST_TEXTS = 5  # distinct texts that a language teaches, whatever their bytes
MOST_WORDS, MOST_GRAMS = 1 << 19, 1 << 20  # of a model that each task holds; words fit SYMBOL_BITS
HELD_TOKENS = 1 << 22  # tokens of a task that are counted at once
SHARD_TOKENS = 1 << 22  # tokens whose trigrams a shard holds, as they come
FEWEST = 30  # calibration texts below which a language takes the bound of all languages together


class TrustedGrams:
    """The model, and the number of rare words that share the probability of their symbol."""

    def __init__(self, grams: KneserNey, rare: int):
        self.grams, self.rare = grams, rare

    def perplexities(self, column: pa.Array) -> np.ndarray:
        data, offsets = text_bytes(column)
        symbol, row, _ = words(data, offsets, SPACED_WORD)
        lost = np.zeros(len(column))
        if self.rare:
            known = self.grams.knows(symbol)
            symbol = np.where(known, symbol, RARE)
            lost = np.bincount(row[~known], minlength=len(column)) * np.log(self.rare + 1)
        total, count = self.grams.row_sums(*padded(symbol, row, len(column), ORDER), len(column))
        return np.exp(np.minimum((lost - total[:, 0]) / count, 700.0))


def _counted(batches, values_of):
    """Sorted distinct values of ``values_of(text column)`` and how often they came, HELD_TOKENS at a time."""
    held, size = [], 0
    for b in row_chunks(batches, "text", CHUNK_BYTES):
        held.append(values_of(b.column("text")))
        size += len(held[-1])
        if size >= HELD_TOKENS:
            yield np.unique(np.concatenate(held), return_counts=True)
            held, size = [], 0
    if size:
        yield np.unique(np.concatenate(held), return_counts=True)


def _pack_sorted(values: np.ndarray) -> bytes:
    return _pack(np.diff(values, prepend=values.dtype.type(0)))


def _unpack_sorted(raw: bytes, n: int) -> np.ndarray:
    return np.cumsum(_unpack(raw, n))


#: Counts up to 4096 as they are, larger ones as the power of two below: each is the least count of its level.
_LEVEL = "if(c < 4096, c, shiftleft(1L, cast(floor(log2(c)) as int)))"


def _levels(count: np.ndarray) -> np.ndarray:
    return np.where(count < 4096, count, 1 << np.log2(np.maximum(count, 1)).astype(np.int64))


def least_kept(levels: dict[int, int], most: int) -> int:
    """Least level such that no more than ``most`` have it or a higher one; ``levels``: how many have each level."""
    for level in sorted(levels, reverse=True):
        most -= levels[level]
        if most < 0:
            return level + 1 if level < 4096 else 2 * level
    return 1


def _word_counts(taught: DataFrame) -> DataFrame:
    """(h, c): hash and occurrences of each word."""
    def run(batches):
        def hashes(column):
            return words(*text_bytes(column), SPACED_WORD)[0]

        for value, count in _counted(batches, hashes):
            yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(count)], ["h", "c"])

    counts = taught.mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))
    return materialise(counts, "words")


def _words(counts: DataFrame) -> tuple[np.ndarray, int, int]:
    """Sorted hashes of the words of the vocabulary, the number of the other words, and of all tokens."""
    levels = {r["level"]: r for r in counts.groupBy(F.expr(_LEVEL).alias("level")).agg(F.count(F.lit(1)).alias("n"),
                                                                                      F.sum("c").alias("c")).collect()}
    least = least_kept({k: r["n"] for k, r in levels.items()}, MOST_WORDS)
    chosen = counts.filter(F.col("c") >= least).select("h").toArrow().column("h").to_numpy().view(np.uint64)
    return np.sort(chosen), sum(r["n"] for r in levels.values()) - len(chosen), sum(r["c"] for r in levels.values())


def _shard(table: pa.Table, least: int) -> pa.Table:
    """The trigrams of one shard counted: its bigrams with distinct symbols before them and occurrences, and the trigrams
    with ``least`` occurrences."""
    rows = zip(*(table.column(c).to_pylist() for c in ("n", "keys", "counts")), strict=True)
    keys, counts = zip(*((_unpack_sorted(k, n), _unpack(c, n)) for n, k, c in rows), strict=True)
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    key, count = key[first], np.add.reduceat(count, first)
    pair = key >> SYMBOL_BITS
    first = np.flatnonzero(np.diff(pair, prepend=-1))
    before, times = np.diff(first, append=len(pair)), np.add.reduceat(count, first)
    often = count >= least
    out = {"pairs": _pack_sorted(pair[first]), "before": _pack(before), "times": _pack(times),
           "keys": _pack_sorted(key[often]), "counts": _pack(count[often])}
    sizes = {"shard": table.column("shard")[0].as_py(), "two": len(first), "three": int(often.sum()), "once": int((count == 1).sum())}
    return pa.Table.from_pylist([sizes | out], pa.schema([*((k, pa.int64()) for k in sizes), *((k, pa.binary()) for k in out)]))


_SHARD = "shard long, two long, three long, once long, pairs binary, before binary, times binary, keys binary, counts binary"


def _model(taught: DataFrame, counts: DataFrame | None = None) -> TrustedGrams:
    """The model of the texts as arrays; ``fit`` asks for it only where ``MOST_WORDS`` and ``MOST_GRAMS`` leave nothing out.

    Beyond the bounds the rarest words are one symbol, whose probability is shared by their number, and what the rarest
    grams held goes to the back-off weight of their context; discounts and totals come from all counts.

    Words are numbered, so a trigram is one long.  Its last two symbols deal it to a shard, which has
    the occurrences of trigrams and bigrams and the distinct symbols before a bigram after one shuffle of packed
    keys; the number of shards grows with the tokens.  One task, which the
    bounds keep small, turns the kept counts into the model, so that the driver only ever holds the finished arrays.
    """
    vocabulary, rare, tokens = _words(_word_counts(taught) if counts is None else counts)
    shared = taught.sparkSession.sparkContext.broadcast(vocabulary)
    mask, shards = (1 << SYMBOL_BITS) - 1, max(1, -(-tokens // SHARD_TOKENS))

    def run(batches):
        known = shared.value

        def trigrams(column):
            symbol, row, _ = words(*text_bytes(column), SPACED_WORD)
            number = np.full(len(symbol), RARE, np.uint64)
            if len(known):
                at = np.minimum(np.searchsorted(known, symbol), len(known) - 1)
                number = np.where(known[at] == symbol, at.astype(np.uint64) + np.uint64(FIRST_WORD), RARE)
            seq, owner = padded(number, row, len(column), ORDER)
            real = np.flatnonzero(owner >= 0)
            bits = np.uint64(SYMBOL_BITS)
            return ((seq[real - 1] << bits | seq[real]) << bits | seq[real - 2]).view(np.int64)

        for key, count in _counted(batches, trigrams):
            # a bigram is in one shard, a symbol's bigrams in no more than 64
            pair = key >> SYMBOL_BITS
            to = (mix(((pair >> SYMBOL_BITS) << 6 | pair & 63).view(np.uint64)) % np.uint64(shards)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(to[order])) + 1):
                yield pa.RecordBatch.from_arrays([pa.array([to[own[0]]]), pa.array([len(own)]), pa.array([_pack_sorted(key[own])]),
                                                  pa.array([_pack(count[own])])], ["shard", "n", "keys", "counts"])

    least = 1 if tokens <= MOST_GRAMS else 2  # below the bound no gram is left out
    grams = taught.mapInArrow(run, "shard long, n long, keys binary, counts binary")
    table = materialise(grams.groupBy("shard").applyInArrow(lambda t: _shard(t, least), _SHARD), "grams")

    def rows_of(pick, kind, names):
        """``pick`` of every shard: columns of longs."""
        def run(batches):
            for b in batches:
                for r in b.to_pylist():
                    pairs, keys = _unpack_sorted(r["pairs"], r["two"]), _unpack_sorted(r["keys"], r["three"])
                    columns = pick(pairs, _unpack(r["before"], r["two"]), _unpack(r["times"], r["two"]), keys, _unpack(r["counts"], r["three"]))
                    for at in range(0, len(columns[0]), 1 << 18):
                        yield pa.RecordBatch.from_arrays([pa.array(x[at:at + (1 << 18)]) for x in columns], names)

        return table.mapInArrow(run, kind)

    def level_counts(pairs, before, times, keys, counts):
        got = [np.unique(_levels(c), return_counts=True) for c in (before, counts)]
        return [np.repeat([2, 3], [len(x) for x, _ in got]), *(np.concatenate(x) for x in zip(*got, strict=True))]

    levels: list[dict[int, int]] = [{}, {}]
    for r in rows_of(level_counts, "n long, level long, k long", ["n", "level", "k"]).groupBy("n", "level").agg(F.sum("k").alias("k")).collect():
        levels[r["n"] - 2][r["level"]] = r["k"]
    levels[1][1] = table.agg(F.coalesce(F.sum("once"), F.lit(0))).first()[0]
    kept = least_kept(levels[0], MOST_GRAMS), max(least, least_kept(levels[1], MOST_GRAMS))

    def sums(pairs, before, times, keys, counts):
        """Of each symbol: as the first of a bigram, occurrences and sum of the counts; as the last, number of bigrams."""
        v, place = np.unique(pairs >> SYMBOL_BITS, return_inverse=True)
        w, number = np.unique(pairs & mask, return_counts=True)
        first = [np.bincount(place, weights=x, minlength=len(v)).astype(np.int64) for x in (times, before)]
        return [np.repeat([0, 1], [len(v), len(w)]), np.concatenate([v, w]), np.concatenate([first[0], np.zeros(len(w), np.int64)]),
                np.concatenate([first[1], number])]

    def often(pairs, before, times, keys, counts):
        two, three = (before >= kept[0]) | (times >= kept[1]), counts >= kept[1]
        return [np.repeat([2, 3], [two.sum(), three.sum()]), np.concatenate([pairs[two], keys[three] >> SYMBOL_BITS]),
                np.concatenate([times[two], keys[three] & mask]), np.concatenate([before[two], counts[three]])]

    names, kind = ["n", "pair", "before", "c"], "n long, pair long, before long, c long"
    each = rows_of(sums, kind, names).groupBy("n", "pair").agg(F.sum("before").alias("before"), F.sum("c").alias("c"))
    grams = materialise(rows_of(often, kind, names), "kept")
    two, three = grams.filter("n = 2"), grams.filter("n = 3")
    # a bigram stays by its own count, or as the context or suffix of a trigram
    context = F.shiftleft("before", SYMBOL_BITS).bitwiseOR(F.shiftright("pair", SYMBOL_BITS))
    used = three.select("pair").union(three.select(context.alias("pair"))).distinct().withColumn("used", F.lit(1))
    two = two.join(used, "pair", "left").filter(f"c >= {kept[0]} OR used = 1").select(*names)
    rows = each.select(*names).unionByName(two).unionByName(three)
    times = [[x.get(k, 0) for k in range(1, 5)] for x in levels]

    def build(batches):
        held = [[b.column(c).to_numpy() for c in ("n", "pair", "before", "c")] for b in batches]
        n, pair, before, c = (np.concatenate(x) for x in zip([np.zeros(0, np.int64)] * 4, *held, strict=True))
        symbols = np.concatenate([np.arange(FIRST_WORD, dtype=np.uint64), shared.value])
        whole, texts, count = np.zeros(len(symbols), np.int64), 0, np.zeros(len(symbols), np.int64)
        whole[pair[n == 0]] = c[n == 0]
        texts = int(before[(n == 0) & (pair == int(START))].sum())
        count[pair[n == 1]] = c[n == 1]
        found = [discounts([int((count == k).sum()) for k in range(1, 5)]), *map(discounts, times)]
        pairs = tuple(x[n == 2] for x in (pair, c, before))
        model = KneserNey.pruned(symbols, count, pairs, tuple(x[n == 3] for x in (pair, before, c)), whole, texts, kept, found)
        for name, k, data in model.parts():
            for at in range(0, max(1, len(data)), PART_BYTES):
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([k], pa.int32()), pa.array([at], pa.int64()),
                                                  pa.array([data[at:at + PART_BYTES]], pa.binary())], ["part", "n", "at", "data"])

    rows = materialise(rows.repartition(1).mapInArrow(build, "part string, n int, at long, data binary"), "model")
    parts: dict[tuple[str, int], bytes] = {}
    for r in rows.orderBy("part", "n", "at").toLocalIterator():
        parts[r["part"], r["n"]] = parts.get((r["part"], r["n"]), b"") + bytes(r["data"])
    shared.unpersist()
    if not parts:  # no gram, no task
        none = np.zeros(0, np.uint64)
        return TrustedGrams(KneserNey([[(none, none, none, np.zeros(0, np.int64))] * ORDER], ORDER), 0)
    return TrustedGrams(KneserNey.from_parts(parts, ORDER), rare)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids that are labelled good and not toxic (every label of the id must say so)."""
    return (labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id"))
            .agg(F.min("quality").alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t")).filter("q = 1 AND t = 0").select("id"))


def bad_ids(labels: DataFrame) -> DataFrame:
    """Ids with a label of low quality."""
    return labels.filter("doc_id IS NOT NULL AND quality = 0").select(F.col("doc_id").alias("id")).distinct()


def add_perplexity(docs: DataFrame, model, text_col: str, out: str) -> DataFrame:
    """``docs`` plus the perplexity of the text (an empty or null text is its end symbol alone)."""
    schema = docs.withColumn(out, F.lit(0.0)).schema
    names = schema.names

    def run(batches):
        for b in row_chunks(batches, text_col, CHUNK_BYTES):
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(model.value.perplexities(b.column(text_col)))], names)

    return docs.mapInArrow(run, schema)


class QualityModel:
    """A fitted model: its broadcast arrays (None: it is in shards), the scores of the rows it was fitted on, and the perplexity
    bounds by language (null: all languages together)."""

    def __init__(self, arrays, scores: DataFrame, bounds: DataFrame):
        self.arrays, self.scores, self.bounds = arrays, scores, bounds


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        lower: tuple = LOWER, upper: tuple = UPPER, sample_bytes: int | None = None) -> QualityModel:
    """Model and bounds from the trusted rows of ``docs``.

    Trusted rows are found by id, text hash and size; the ids of those that teach meet the
    documents again, whose texts are written once, and the bounds come from the scores
    of all rows.  A text counts once however often it is copied.  A language whose
    trusted texts are all kept apart teaches those.  With ``sample_bytes`` only the first
    distinct texts of a language in hash order teach, until they hold so many bytes, at least ``LEAST_TEXTS``.
    """
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.coalesce(F.col(lang_col), F.lit("")).alias("lang"), F.xxhash64(text_col).alias("u"))
    small = base.filter("text <> ''").select("id", "lang", "u", F.octet_length("text").alias("size"))
    trusted = materialise(small.join(trusted_ids(labels), "id", "left_semi"), "trusted")
    teaching = trusted.filter(F.pmod("u", F.lit(5)) != 0)
    others = trusted.join(teaching.select("lang").distinct(), "lang", "left_anti").select(*trusted.columns)
    teaching = teaching.unionByName(others)
    if sample_bytes is not None:
        order = F.col("u").bitwiseAND(F.lit((1 << 63) - 1))  # without the sign
        drawn = hash_sample(teaching.select("lang", order.alias("u"), "size"), "lang", sample_bytes, LEAST_TEXTS)
        teaching = teaching.withColumn("_order", order).join(drawn.withColumnRenamed("u", "_order"), ["lang", "_order"], "left_semi")
    chosen = teaching.groupBy("lang", "u", "id").agg(F.count(F.lit(1)).alias("n"))
    chosen = chosen.groupBy("lang", "u").agg(F.min(F.struct("id", "n")).alias("first")).select("lang", "u", "first.*")
    chosen = materialise(chosen, "teaching-ids")
    arrays, scores = _scored(base, *_taught(base, chosen))
    # texts that taught the model have the lowest perplexities: the low quantiles are of all trusted texts, the high ones of the calibration texts
    held = F.pmod("u", F.lit(5)) == 0
    known = scores.join(trusted.select("id", "u").distinct(), ["id", "u"], "left_semi")
    cubes = known.cube("lang").agg(
        F.concat(F.percentile_approx("ppl", list(lower), 10_000),
                 F.percentile_approx(F.when(held, F.col("ppl")), list(upper), 10_000)).alias("at"),
        F.count(F.when(held, 1)).alias("n"), F.grouping("lang").alias("all"))
    cubes = materialise(cubes.filter((F.col("all") == 1) | (F.col("n") >= FEWEST)).select(
        F.when(F.col("all") == 0, F.col("lang")).alias("lang"), "at"), "quantiles")
    low, high = _choose(known.filter(held), scores.filter(held).join(bad_ids(labels), "id", "left_semi"), cubes, lower, upper)
    floor = F.col("at")[low] if lower[low] > 0 else F.lit(0.0)
    bounds = cubes.select("lang", floor.alias("floor"), F.col("at")[len(lower) + high].alias("bound"))
    return QualityModel(arrays, scores, materialise(bounds, "bounds"))


def _scored(base: DataFrame, taught: DataFrame, path: str) -> tuple:
    """The model of the ``taught`` texts as broadcast arrays, if it is small, and the perplexities of ``base``; the texts go."""
    spark = base.sparkSession
    counts = _word_counts(taught)
    n, tokens = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("c"), F.lit(0))).first()
    tokens += taught.count()  # and an end for each text
    if n <= MOST_WORDS and tokens <= MOST_GRAMS:
        arrays = spark.sparkContext.broadcast(_model(taught, counts))
        remove_path(spark, path)
        return arrays, materialise(add_perplexity(base, arrays, "text", "ppl").select("id", "lang", "u", "ppl"), "scores")
    size = base.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    model = GramShards.learn(taught, counts, tokens, size)
    remove_path(spark, path)
    return None, model.scores(base)


def _taught(base: DataFrame, chosen: DataFrame) -> tuple[DataFrame, str]:
    """The texts of the ``chosen`` rows (lang, u, id, n), written once, and where.

    Where the ids are too many to broadcast, Spark drops most other rows by a Bloom filter of them before it shuffles texts.
    Only a text whose row is in the table more than once is grouped.
    """
    spark = base.sparkSession
    items = max(1, chosen.count())
    filters = {"applicationSideScanSizeThreshold": "0", "creationSideThreshold": "1g", "expectedNumItems": str(items),
               "maxNumItems": str(items), "numBits": str(10 * items)}
    filters = {f"spark.sql.optimizer.runtime.bloomFilter.{k}": v for k, v in filters.items()}
    before = {k: spark.conf.get(k) for k in filters}
    text = base.join(chosen.filter("n = 1"), ["id", "lang", "u"], "left_semi").select("text")
    if not chosen.filter("n > 1").isEmpty():
        more = base.join(chosen.filter("n > 1"), ["id", "lang", "u"], "left_semi")
        text = text.unionByName(more.groupBy("lang", "u").agg(F.min("text").alias("text")).select("text"))
    path = fresh_path(spark, "taught")
    try:
        for k, v in filters.items():
            spark.conf.set(k, v)
        text.write.option("compression", "zstd").parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return spark.read.schema("text string").parquet(path), path


def _choose(good: DataFrame, poor: DataFrame, cubes: DataFrame, lower: tuple, upper: tuple) -> tuple[int, int]:
    """Places of the quantiles with the largest rejected share of held-out bad texts less that of good ones (ties, and no bad
    text: the fewest good texts lost)."""
    rest = F.broadcast(cubes.filter("lang IS NULL").agg(F.first("at").alias("rest")))
    own = cubes.filter("lang IS NOT NULL")
    rows = good.withColumn("good", F.lit(1)).unionByName(poor.withColumn("good", F.lit(0)))
    rows = rows.join(own, "lang", "left").crossJoin(rest).withColumn("at", F.coalesce("at", "rest"))
    pairs = [(i, j) for i in range(len(lower)) for j in range(len(upper))]

    def out(i, j):
        over = F.col("ppl") > F.col("at")[len(lower) + j]
        return F.avg(((over | (F.col("ppl") < F.col("at")[i])) if lower[i] > 0 else over).cast("int")).alias(f"r{i}_{j}")

    share = {r["good"]: r for r in rows.groupBy("good").agg(*[out(i, j) for i, j in pairs]).collect()}
    of = lambda kind, i, j: (share[kind][f"r{i}_{j}"] or 0.0) if kind in share else 0.0
    return max(pairs, key=lambda x: (of(0, *x) - of(1, *x), -of(1, *x), -x[0], -x[1]))


def decide(scored: DataFrame, model: QualityModel, lang: Column, names: dict[str, str]) -> DataFrame:
    """``scored`` plus the bound of its language and the decision."""
    key, low = free_name(scored, "_lang"), free_name(scored, "_floor")
    own = model.bounds.filter("lang IS NOT NULL").select(F.col("lang").alias(key), F.col("bound").alias(names["bound"]),
                                                              F.col("floor").alias(low))
    rest, least = model.bounds.filter("lang IS NULL").agg(F.max("bound"), F.max("floor")).first()  # two numbers
    scored = scored.join(own, F.coalesce(lang, F.lit("")) == F.col(key), "left").drop(key)
    scored = scored.withColumn(names["bound"], F.coalesce(F.col(names["bound"]), F.lit(rest).cast("double")))
    least = F.coalesce(F.col(low), F.lit(least).cast("double"))
    keep = F.coalesce(F.col(names["perplexity"]).between(least, F.col(names["bound"])), F.lit(True))
    return scored.withColumn(names["keep"], keep).drop(low)


def quality_report(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   lang_col: str = "lang") -> DataFrame:
    """``doc_id``, ``lang``, ``perplexity``, ``bound``, ``keep`` of every row.

    Null and empty texts are scored by their end symbol alone, which trusted text
    hardly ever starts with: they are rejected once a model exists.  A null or rare
    language takes the bound of all languages; without trusted rows no bound exists
    and every row is kept.  Repeated rows and null ids stay.
    """
    model = fit(docs, labels, id_col, text_col, lang_col)
    scored = model.scores.select(F.col("id").alias("doc_id"), F.col("lang").alias("lang"), F.col("ppl").alias("perplexity"))
    return decide(scored, model, F.col("lang"), {"perplexity": "perplexity", "bound": "bound", "keep": "keep"}).select(
        "doc_id", F.nullif("lang", F.lit("")).alias("lang"), "perplexity", "bound", "keep")


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that ``quality_report`` keeps, with the columns of ``docs``; whole rows are scored again in place, or
    lose those whose id and text were rejected."""
    model = fit(docs, labels, id_col, text_col, lang_col)
    names = {k: free_name(docs, k) for k in ("perplexity", "bound", "keep")}
    if model.arrays is None:
        scored = model.scores.withColumnRenamed("ppl", names["perplexity"])
        own = {c: free_name(docs, f"_{c}") for c in ("id", "lang", "u")}
        bad = decide(scored, model, F.col("lang"), names).filter(~F.col(names["keep"])).select(
            *[F.col(c).alias(x) for c, x in own.items()]).distinct()
        same = [F.col(id_col).eqNullSafe(F.col(own["id"])), F.coalesce(F.col(lang_col), F.lit("")) == F.col(own["lang"]),
                F.xxhash64(text_col) == F.col(own["u"])]
        return docs.join(bad, same, "left_anti")
    scored = add_perplexity(docs, model.arrays, text_col, names["perplexity"])
    return decide(scored, model, F.col(lang_col), names).filter(names["keep"]).select(*docs.columns)
