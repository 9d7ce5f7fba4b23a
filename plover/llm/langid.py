"""Language identification by interpolated Kneser-Ney character models, one per language, in shared sorted hash arrays.

Letters are lower-cased, everything else is a space.  A text gets the language of
the lowest cross-entropy per symbol.  The models learn from a bounded sample of the
labelled rows (``sample_bytes`` of distinct whole texts per language, in the order of
a hash of the text); every row is scored in place, without a shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plover.llm.common import materialise, row_chunks
from plover.llm.ngrams import KneserNey, gram_counts, padded

CHUNK_BYTES = 1 << 20
SPACE = 32
CALIBRATION = 5  # every so-manieth sampled text (by hash) calibrates instead of training
ACCEPTED = 0.995  # share of calibration texts of a language that its entropy bound accepts


def letter_table() -> np.ndarray:
    """Code point of the lower-case letter for letters, a space for all else."""
    out = np.full(0x110000, SPACE, np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def symbols(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters of the texts with single spaces between words, and the text of each symbol."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    code = table[np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)]
    row = np.repeat(np.arange(len(texts)), size)
    blank = code == SPACE
    keep = ~blank
    keep[1:] |= blank[1:] & ~blank[:-1] & (row[1:] == row[:-1])  # a space after a word stays
    return code[keep].astype(np.uint64) + np.uint64(16), row[keep]


class LanguageModel:
    def __init__(self, languages: list[str], texts: list[list[str]], order: int):
        """``texts[i]``: whole sample texts of ``languages[i]``, every ``CALIBRATION``-th kept for calibration."""
        self.languages, self.table, self.order = languages, letter_table(), order
        counts = []
        for own in texts:
            train = [t for i, t in enumerate(own) if i % CALIBRATION or len(own) < CALIBRATION]
            seq, owner = padded(*symbols(train, self.table), len(train), order)
            counts.append(gram_counts(seq, owner, order))
        self.model = KneserNey(counts, order) if languages else None
        self.scale, self.bound = 8.0, np.full(len(languages), np.inf)
        if not languages:
            return
        held = [t for own in texts for t in own[::CALIBRATION]]
        truth = np.array([i for i, own in enumerate(texts) for _ in own[::CALIBRATION]])
        entropy, letters = self.entropies(held)
        entropy, truth = entropy[letters], truth[letters]
        if len(truth):
            gain = entropy - entropy.min(axis=1, keepdims=True)
            grid = [0.5, 1, 2, 4, 8, 16, 32]
            loss = [np.mean(s * gain[np.arange(len(truth)), truth] + np.log(np.exp(-s * gain).sum(axis=1))) for s in grid]
            self.scale = float(grid[int(np.argmin(loss))])
        for i in range(len(languages)):
            own = entropy[truth == i, i]
            if len(own):
                self.bound[i] = np.quantile(own, ACCEPTED, method="higher")

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Nats per symbol under each language, and whether the text has a letter."""
        symbol, row = symbols(texts, self.table)
        seq, owner = padded(symbol, row, len(texts), self.order)
        total, count = self.model.row_sums(seq, owner, len(texts))
        return -total / np.maximum(count, 1)[:, None], np.bincount(row[symbol != SPACE + 16], minlength=len(texts)) > 0

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language (``und`` without a letter), confidence 0..1, and whether the calibrated entropy bound accepts it."""
        if self.model is None:
            return ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        entropy, letters = self.entropies(texts)
        best = entropy.argmin(axis=1)
        least = entropy[np.arange(len(texts)), best]
        share = 1 / np.exp(-self.scale * (entropy - least[:, None])).sum(axis=1)
        return ([self.languages[b] if ok else "und" for b, ok in zip(best.tolist(), letters.tolist(), strict=True)],
                np.where(letters, share, 0.0), letters & (least <= self.bound[best]))


def hash_sample(rows: DataFrame, key: str, sample_bytes: int, fewest: int) -> DataFrame:
    """(``key``, u) of the first distinct texts of every key in the order of their hash ``u``, until they hold
    ``sample_bytes``; always at least ``fewest`` of them, or all.  ``rows`` have ``key``, ``u`` (not negative) and ``size``.

    Copies count once.  The leading zeros of the hash are levels that halve from one
    to the next, so the totals per level say which rows can be drawn at all: about
    twice the bound, whatever the size of the key.
    """
    level = F.lit(63) - F.length(F.bin("u"))
    texts = materialise(rows.groupBy(key, "u").agg(F.max("size").alias("size")), "texts").withColumn("level", level)
    totals = texts.groupBy(key, "level").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("b"))

    def short(order, n, size):
        before = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return ((F.coalesce(F.sum(size).over(before), F.lit(0)) < sample_bytes)
                | (F.coalesce(F.sum(n).over(before), F.lit(0)) < fewest))

    needed = totals.withColumn("needed", short(F.desc("level"), "n", "b")).filter("needed")
    least = materialise(needed.groupBy(key).agg(F.min("level").alias("least")), "levels")  # a row per key
    near = texts.join(least, key).filter("level >= least").withColumn("one", F.lit(1))
    return near.withColumn("drawn", short(F.asc("u"), "one", "size")).filter("drawn").select(key, "u")


def train(labelled: DataFrame, text_col: str, lang_col: str, order: int = 4, sample_bytes: int = 1 << 20) -> LanguageModel:
    """Models of all non-null languages of ``labelled``, each from the first distinct texts in hash order until they
    hold ``sample_bytes``; at least ``CALIBRATION`` texts, or all.  Only drawn texts are shuffled or reach the driver."""
    rows = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter("text <> '' AND lang IS NOT NULL")
    rows = rows.withColumn("u", F.xxhash64("text").bitwiseAND(F.lit((1 << 63) - 1)))
    sizes = rows.select("lang", "u", F.octet_length("text").alias("size"))
    drawn = materialise(hash_sample(sizes, "lang", sample_bytes, CALIBRATION), "drawn")
    chosen = rows.join(drawn, ["lang", "u"]).groupBy("lang", "u").agg(F.min("text").alias("text"))
    got = chosen.toArrow().to_pylist()
    got.sort(key=lambda r: (r["lang"], r["u"]))
    languages = sorted({r["lang"] for r in got})
    return LanguageModel(languages, [[r["text"] for r in got if r["lang"] == x] for x in languages], order)


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score``, ``accepted`` of every row.

    Null text and text without a letter get ``und``, score 0 and no acceptance; so
    does every text when nothing was learned.  ``accepted`` is false where the best
    entropy lies above the language's calibrated bound; the prediction stays.
    Repeated rows and null ids stay; ties go to the first language by name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in row_chunks(batches, "text", CHUNK_BYTES):
            lang, score, ok = shared.value.predict([t or "" for t in b.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(lang, pa.string()), pa.array(score), pa.array(ok)],
                                             ["doc_id", "lang_pred", "score", "accepted"])

    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = base.schema["doc_id"].dataType.simpleString()
    return base.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, accepted boolean")


def held_out(id_col: str, folds: int, fold: int):
    """Whether crc32 of the id as text falls into the fold; rows without an id are always held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(True))


def language_report(docs: DataFrame, folds: int = 5, id_col: str = "doc_id", text_col: str = "text",
                    lang_col: str = "lang") -> DataFrame:
    """Predictions for all rows by a model that never saw fold 0; see ``identify``."""
    model = train(docs.filter(~held_out(id_col, folds, 0)), text_col, lang_col)
    got = identify(docs, model, id_col, text_col)
    return got.select("doc_id", held_out("doc_id", folds, 0).alias("held_out"), "lang_pred", "score", "accepted")
