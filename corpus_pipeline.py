"""A corpus pipeline of five operators: from raw documents to token ids.

Each stage takes the session, the documents that the stage before it kept, and the folder
of the source tables; it returns documents with the same columns (the last stage: ids and
digests).  ``run`` applies them in order; each result is written to the shared folder and
read again, so a lost executor costs one stage at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from lithosense.llm import bpe, decontaminate, line_dedup, near_dedup, quality
from lithosense.llm.common import table, written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity under the model of trusted text is not above their language's limit."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line repeats.

    A document that had lines and keeps none is a copy of earlier text and goes; one that had
    none stays.  ``n_chars`` follows the text.
    """
    cleaned = line_dedup.remove_duplicate_lines(docs)
    left = cleaned.filter("n_dropped = 0 OR n_dropped < n_lines").drop("n_lines", "n_dropped")
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns) if "n_chars" in docs.columns else left


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar ones: five-word shingles, similarity of 0.8 or more."""
    return near_dedup.keep_one(docs, width=5, threshold=80)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold a benchmark item, in whatever order of its parts."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with their digests."""
    coded = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, digests=True)
    return coded.select("doc_id", "lang", "source", "n_tokens", "ids_sha256", "decoded_sha256", "token_ids")


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", remove_repeated_lines),
    ("MinHash near-dedup", keep_one_of_similar),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("byte-level BPE", tokenize),
]

# Edit-distance joins, n-gram models, similarity components and BPE are beyond SQL;
# tests/llm holds the whole run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
