"""Order MinHash fingerprints with DataFrame functions only.

The k-mers of a text (``k`` words, numbered by occurrence, so that a repeated k-mer
counts each time) are hashed and dealt to ``bins`` by their leading hash bits.  Each
bin keeps its ``picks`` minimal k-mers, puts them back into text order and hashes
the tuple: moved or replaced text changes tuples, which a plain MinHash would not
notice.  All steps are array functions of the one row: no shuffle, no Python.

Arrays stand in named columns between the steps.  A column that a later lambda
reads is used there more than once, which keeps Spark from inlining it into the
lambda and computing it again for every element.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plover.llm.common import free_name

PLACE_BITS = 24  # of the 64 bits of a hashed k-mer that give way to its place in the text


def _below(n: Column) -> Column:
    """0 .. n-1 as an array, empty for n = 0."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _shift(value: Column, by: Column | int, left: bool = False) -> Column:
    return F.call_function("shiftleft" if left else "shiftrightunsigned", value, by if isinstance(by, Column) else F.lit(by))


def _group_starts(values: str, count: str, key) -> Column:
    """Places of a sorted array at which ``key`` of the element changes."""
    return F.filter(_below(F.col(count)), lambda i: (i == 0) | (key(F.get(values, i)) != key(F.get(values, i - 1))))


def add_fingerprint(df: DataFrame, text: Column, out: str, k: int = 5, bins: int = 64, picks: int = 2) -> DataFrame:
    """``df`` plus ``out``: an int per filled bin, the bin in the upper byte and 24 bits of its tuple's hash below.

    Words are separated by ASCII white space; a text of fewer than ``k`` words is one
    k-mer; null or wordless text gives an empty array.
    """
    assert picks == 2 and bins & (bins - 1) == 0 and bins <= 128, "bins: a power of two up to 128; pairs of k-mers"
    bin_bits = bins.bit_length() - 1
    n = [free_name(df, f"_{out}_{i}") for i in range(9)]
    words, grams, count, width, packed, starts, times, hashed, edges = n
    got = df.withColumn(words, F.transform(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[ \t-\r]+"), ""), lambda w: F.xxhash64(w)))
    size = F.size(words)
    got = got.withColumn(grams, F.transform(
        _below(F.when(size > 0, F.greatest(size - (k - 1), F.lit(1))).otherwise(0)),
        lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(k)])))
    got = got.withColumns({count: F.size(grams), width: F.length(F.bin(F.size(grams)))}).drop(words)
    # occurrence numbers: equal k-mers stand side by side when sorted by (hash, place)
    got = got.withColumn(packed, F.sort_array(F.transform(
        F.col(grams), lambda x, i: _shift(x, F.col(width), left=True).bitwiseOR(i.cast("long")))))
    got = got.withColumn(starts, _group_starts(packed, count, lambda x: _shift(x, F.col(width))))
    got = got.withColumn(times, F.flatten(F.transform(
        F.col(starts), lambda g, j: F.sequence(F.lit(0), F.coalesce(F.get(starts, j + 1), F.col(count)) - g - 1))))
    place_mask = _shift(F.lit(1).cast("long"), F.col(width), left=True) - 1
    coarse = F.greatest(F.col(width) - PLACE_BITS, F.lit(0))

    def pack(x, time):
        place = x.bitwiseAND(place_mask)
        h = F.xxhash64(F.get(grams, place.cast("int")), time)
        return h.bitwiseAND(F.lit(-1 << PLACE_BITS).cast("long")).bitwiseOR(_shift(place, coarse))

    got = got.withColumn(hashed, F.sort_array(F.zip_with(packed, times, pack)))
    got = got.withColumn(edges, _group_starts(hashed, count, lambda x: _shift(x, 64 - bin_bits)))

    def sketch(g, j):
        first, second = F.get(hashed, g), F.get(hashed, g + 1)
        alone = F.coalesce(F.get(edges, j + 1), F.col(count)) - g == 1
        place = F.lit((1 << PLACE_BITS) - 1).cast("long")
        a, b = _shift(first, PLACE_BITS), _shift(second, PLACE_BITS)
        pair = (F.when(alone, F.xxhash64(a))
                .when(first.bitwiseAND(place) <= second.bitwiseAND(place), F.xxhash64(a, b)).otherwise(F.xxhash64(b, a)))
        bin_ = _shift(first, 64 - bin_bits)
        return F.shiftleft(bin_, 24).bitwiseOR(pair.bitwiseAND(F.lit((1 << 24) - 1).cast("long"))).cast("int")

    return got.withColumn(out, F.transform(F.col(edges), sketch)).drop(*n[1:])


def as_text(fingerprint: Column) -> Column:
    """Eight hex digits per filled bin: two for the bin, six for its tuple."""
    return F.array_join(F.transform(fingerprint, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of the bins filled on either side that hold the same tuple; two empty fingerprints are alike."""
    def filled(x):
        return F.transform(x, lambda v: F.shiftrightunsigned(v, 24))

    either = F.size(F.array_union(filled(a), filled(b)))
    return F.when(either == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(either, F.lit(1)))


def with_next(df: DataFrame, id_col: str, text_col: str, carried: dict[str, str]) -> DataFrame:
    """Adds ``carried`` columns of the next row in ascending id (null ids first, equal ids by text); the last row's is the first.

    Rows are dealt to as many id ranges as there are shuffle partitions; each range
    also gets a copy of the row that opens the next one, so one shuffle by range
    is enough and no window spans the table.
    """
    spark = df.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spot, part, guest, opens = (free_name(df, x) for x in ("_spot", "_part", "_guest", "_opens"))
    probs = [i / parts for i in range(1, parts)]
    cuts = sorted(set(df.select(F.col(id_col).cast("double").alias("v")).approxQuantile("v", probs, 1 / (4 * parts)))) if probs else []
    splits = [float("-inf"), *(cuts or [0.0]), float("inf")]
    got = df.withColumn(spot, F.col(id_col).cast("double"))
    got = Bucketizer(splits=splits, inputCol=spot, outputCol=part, handleInvalid="keep").transform(got)
    got = got.withColumn(part, F.when(F.col(id_col).isNull(), -1).otherwise(F.col(part)).cast("int")).drop(spot)
    firsts = sorted((r[0], r[1]) for r in got.groupBy(part).agg(F.min(id_col)).collect())  # at most parts + 1 rows
    if not firsts:
        return got.select(*df.columns, *[F.col(c).alias(o) for c, o in carried.items()])
    before = [(v, firsts[i - 1][0], p) for i, (p, v) in enumerate(firsts)]
    kind = df.schema[id_col].dataType.simpleString()
    opening = F.broadcast(spark.createDataFrame(before, f"v {kind}, {opens} int, p int"))
    got = got.join(opening, (got[part] == opening["p"]) & got[id_col].eqNullSafe(opening["v"]), "left").drop("v", "p")
    def place(copy: bool, to: str):
        return F.struct(F.lit(copy).alias("copy"), F.col(to).alias("to"))

    places = F.when(F.col(opens).isNull(), F.array(place(False, part))).otherwise(
        F.array(place(False, part), place(True, opens)))
    got = got.withColumn(opens, F.explode(places)).select(
        *df.columns, F.col(opens)["copy"].alias(guest), F.col(opens)["to"].alias(part))
    w = Window.partitionBy(part).orderBy(guest, F.col(id_col).asc_nulls_first(), F.col(text_col).asc_nulls_first())
    return (got.withColumns({o: F.lead(c).over(w) for c, o in carried.items()})
            .filter(~F.col(guest)).drop(guest, part))


def edit_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, bins: int = 64) -> DataFrame:
    """Fingerprints of every text and of its edited form, and how alike they and the next document's are.

    The edited text has its last quarter (code points, rounded down) replaced by the
    opening of the next document's.  Null text is empty; repeated rows stay; rows of
    one id follow each other by text; a table of one row is its own next; an empty
    table gives no rows; other columns are ignored.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    own = add_fingerprint(base, F.col("text"), "own", k, bins)
    paired = with_next(own, "doc_id", "text", {"text": "next_text", "own": "next_own"})
    quarter = F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(F.call_function("left", F.col("text"), F.length("text") - quarter),
                      F.call_function("left", F.col("next_text"), quarter))
    paired = paired.select("doc_id", F.length("text").cast("long").alias("n_chars"), edited.alias("edited"), "own", "next_own")
    both = add_fingerprint(paired.withColumn("edited_sha256", F.sha2("edited", 256)), F.col("edited"), "other", k, bins)
    return both.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("own")).alias("fingerprint"),
                       as_text(F.col("other")).alias("edited_fingerprint"),
                       likeness(F.col("own"), F.col("other")).alias("near_edited"),
                       likeness(F.col("own"), F.col("next_own")).alias("near_next"))
