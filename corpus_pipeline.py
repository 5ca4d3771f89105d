"""The corpus pipeline: from documents to token files.

Each stage takes (spark, docs, sf_dir) and returns what the next one reads: all of the columns of
``documents``, for the documents (or, after the mix, copies of documents) that it keeps.  The last
stage writes the token files and returns a digest of each document as read back from them.

Edge cases: a null text is an empty one; documents without words are judged by their site alone, are near no other, hit no benchmark
and weigh nothing in the mix; rows of equal id and text are one document to near-dedup, of which one row stays, and rows of null ids
are told apart by their texts; an empty table gives an empty result; further columns, whatever their names, are passed on by all
stages but the last; texts of any length are processed whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weekcast.llm.common import documents, shared_dir
from weekcast.llm.decontaminate import clean_documents
from weekcast.llm.mixing import mixed_documents
from weekcast.llm.near_dedup import one_of_each
from weekcast.llm.quality_bayes import good_documents
from weekcast.llm.token_files import token_digests


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    return good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: shingles of five words, similarity 0.8."""
    return one_of_each(docs, width=5, threshold=(80, 100))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of ten words of the benchmark."""
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document (and copy) of the mix, from the token files.

    The encoders' caches are small here: this stage runs where the stages before have used the executors' memory."""
    return token_digests(docs, cache_words=50_000)


STAGES = [
    ("quality_classifier", quality),
    ("minhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("mixing", mixing),
    ("token_output", token_output),
]

#: The classifier is fitted by iteration, which SQL can't express; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        out = shared_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return STAGES[-1][1](spark, docs, sf_dir)
