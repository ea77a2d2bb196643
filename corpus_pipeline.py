"""Corpus pipeline: quality, language, near duplicates, benchmark passages, mixture.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame with the columns of documents (the last adds the mixture's
topic, tokens and probability); `run` writes each result as Parquet in the shared folder and reads it as the next one's docs.

A null text is kept or rejected like an empty one. Rows with a null doc_id pass the near-duplicate stage, which names documents by
id; of different rows with one id it keeps that whose text has the smallest digest.
Without a usable label, or without a language to learn, the classifying stages keep what they can't judge.
Texts of any length are judged whole. Equal documents are judged alike; of equal texts the smallest doc_id stays. An empty table passes
all stages as an empty one. Columns that documents has besides are carried along; those that the mixture adds replace any of the same name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlark.llm import decontaminate, jaccard_join, language, mixing, quality
from fieldlark.llm._spark import small, stored, table

#: Scores below which a document is rejected.
QUALITY, LANGUAGE = 0.3, 0.5


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality discriminant rejects go."""
    labels = stored(table(spark, sf_dir, "labels").where(~quality.held_out(5, 0) & F.col("doc_id").isNotNull()).select("doc_id", "quality"))
    labelled = docs.join(small(labels.select("doc_id").distinct()), "doc_id", "left_semi")
    model = quality.fit(quality.document_statistics(labelled), labels, "quality")
    return docs if model.mean is None else quality.accepted(docs, model, QUALITY)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no language that was learnt, or without a letter, go."""
    names, matrix = language.train(docs.where(~quality.held_out(3, 1) & F.col("doc_id").isNotNull()))
    return language.identified(docs, names, matrix, LANGUAGE) if names else docs


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays: the one with the smallest id."""
    found = jaccard_join.jaccard_components(docs, links=False)
    gone = stored(found.where("component_id <> doc_id").select("doc_id"))
    kept = docs.join(small(gone), "doc_id", "left_anti")
    again = stored(docs.groupBy("doc_id").count().where("count > 1 and doc_id is not null").select("doc_id"))
    if not again.limit(1).count():
        return kept
    # rows that share an id: the one whose text has the smallest digest, whatever the order of the rows
    order = F.struct(F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256), F.xxhash64(*kept.columns))
    once = kept.join(small(again), "doc_id", "left_semi").groupBy(F.col("doc_id").alias("_key")).agg(F.min_by(F.struct(*kept.columns), order).alias("_row")).select("_row.*")
    return kept.join(small(again), "doc_id", "left_anti").unionByName(once)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose sources, languages and topics have the tempered shares."""
    return mixing.mixed(docs, details=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_stage),
    ("language ID", language_stage),
    ("n-gram Jaccard join", jaccard_stage),
    ("benchmark decontamination", decontaminate_stage),
    ("mixing sources to target weights", mixing_stage),
]

#: The classifiers can't be expressed in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
