"""Corpus pipeline: quality classifier, near-duplicates, repeated passages, benchmark passages, packing.

Each stage takes ``(spark, docs, sf_dir)``; its rows are written as Parquet and
read back as the next one's ``docs``.  All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plover.llm.common import materialise
from plover.llm.decontaminate import remove_leaks
from plover.llm.packing import pack
from plover.llm.quality import keep_good
from plover.llm.queries import TOKENIZER
from plover.llm.repeats import remove_repeats
from plover.llm.simhash import drop_near_copies
from plover.llm.tokens import token_counts
from plover.sources.tables import scan

REPEAT_BYTES = 256  # about 50 English words; the query of operator 3 has 400 by its contract


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents above their language's perplexity bound go."""
    return keep_good(docs, scan(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near-duplicates by SimHash (3-word shingles, 2 bits): one document of each group stays."""
    return drop_near_copies(docs, size=3, budget=2)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Suffix-array dedup: bytes of 256-byte strings that start elsewhere too are cut out of the texts."""
    return remove_repeats(docs, length=REPEAT_BYTES, chars_col="n_chars")


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: words inside 10-word windows of benchmark items are cut out of the texts."""
    return remove_leaks(docs, scan(spark, sf_dir, "benchmark"), size=10, chars_col="n_chars")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: optimal length buckets and token-budget batches, in the tokens of operator 9."""
    import public_tokenizers

    return pack(token_counts(docs, public_tokenizers.path(TOKENIZER)))


STAGES = [
    ("quality_classifier", quality),
    ("simhash_near_dedup", near_copies),
    ("suffix_array_dedup", repeats),
    ("benchmark_decontamination", leaks),
    ("packing", packing),
]

#: The stages fit models, walk tries and build suffix arrays; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's rows are written to the shared folder."""
    docs = scan(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
