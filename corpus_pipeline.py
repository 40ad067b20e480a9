"""From raw documents to token ids in five stages, each written as Parquet and read again.

1. quality: documents that the classifier rejects go.
2. near_dedup: one document of each group of near copies stays (words in shingles
   of five, similarity of 0.8 or more).
3. substring_dedup: words of passages that start more than once go.
4. mixing: documents are repeated or left out, always whole, so that sources come as near
   to their targets as that allows.
5. encoding: token ids of every text.

Stages 1 to 4 return the columns they get. Nulls, empty texts, repeated rows and
empty tables are handled as the operators say; a text that has lost all its words
stays as an empty one. Columns that a stage doesn't know go through it.
"""

from pyspark.sql import DataFrame, SparkSession

from fleetspan.llm import encoding, minhash, mixing, quality, substring
from fleetspan.plans.shared import staged


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def stage_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.one_of_each(docs)


def stage_substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring.without_repeats(docs)


def stage_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixture(docs, whole=True)


def stage_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encoding.encode_documents(docs)


STAGES = [
    ("quality", stage_quality),
    ("near_dedup", stage_near_dedup),
    ("substring_dedup", stage_substring_dedup),
    ("mixing", stage_mixing),
    ("encoding", stage_encoding),
]

ORACLE_SQL = None
"""A trained classifier and MinHash are no SQL; tests hold the stages against plain versions."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
