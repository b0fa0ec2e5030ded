"""A training corpus from raw documents, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept; its result is written as
Parquet and read again. All stages but the last return the columns of ``documents``.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidewell.llm import bpe, decontamination, line_dedup, quality_classifier, simhash_dedup
from tidewell.scratch import stored


def choose_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling against the labelled good ones keeps."""
    return quality_classifier.select_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that ten or more documents hold, but for each line's first occurrence: so a text of many
    copies is not lost with them."""
    bitmaps = line_dedup.keep_bitmaps(docs, min_docs=10, min_chars=1, keep="first")
    return line_dedup.apply(docs, bitmaps)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash links connect."""
    return simhash_dedup.one_of_each(docs, shingle=3, max_bits=3)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no passage with the benchmark."""
    return decontamination.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and whether decoding them gives the text back."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoded = bpe.encode_documents(docs, path, keep=("doc_id", "lang", "source"), verify=True)
    return encoded.select("doc_id", "lang", "source", "n_tokens", "ids", "round_trip")


STAGES = [
    ("quality_classifier", choose_quality),
    ("line_dedup", drop_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_leaks),
    ("bpe", encode),
]

#: SQL can express neither SimHash components nor the fitted classifier; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
