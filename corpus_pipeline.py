"""A corpus pipeline: documents of a known language and good quality, without copies, packed.

Every stage takes ``(spark, docs, sf_dir)`` and gives a DataFrame, which is written as Parquet
and read again as the next stage's ``docs``. When a stage is called, the result of the one
before it has been written, so what that one stored on the way is deleted then. From the first
one on, the session hands rows to Python workers in small batches, as the workers of a stage
keep their memory in the next ones; ``run`` puts the setting back at the end.

Documents with null or empty text have no letter and leave in the first stage. Repeated rows
leave in the third. Other columns are kept up to the last stage. An empty table stays empty.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seekloom.llm import exact_dedup, language_id, near_dedup, packing, quality
from seekloom.llm.queries import TOKENIZER, labelled_languages, quality_labels
from seekloom.session import BATCH_BYTES, BATCH_KEY, new_folder, remove_folder, scratch, small_batches

#: Documents with a lower probability of good quality are rejected.
MIN_QUALITY = 0.5
#: What the last stage has stored on its way.
_stored: list[str] = []

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def stage(function: Stage) -> Stage:
    """Keep what a stage stores until the next one is called, and bound the batches it gives to Python."""

    @functools.wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        while _stored:
            remove_folder(spark, _stored.pop())
        # Its result is run by the caller, so the setting has to last.
        spark.conf.set(BATCH_KEY, str(BATCH_BYTES))
        with scratch(spark, function.__name__, delete=False) as folder:
            _stored.append(folder)
            return function(spark, docs, sf_dir)

    return run


@stage
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those without a letter are rejected."""
    samples = language_id.learn_samples(labelled_languages(docs))
    judged = language_id.identify(docs, samples)
    return judged.where(F.col("lang_pred") != language_id.UNDETERMINED).select(*docs.columns)


@stage
def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are likelier of good quality than not."""
    model = quality.learn(docs, quality_labels(spark, sf_dir))
    scored = docs.withColumn("__score", quality.quality_score(F.col("text"), model))
    return scored.where(F.col("__score") >= MIN_QUALITY).select(*docs.columns)


@stage
def drop_exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is equal without white space."""
    return exact_dedup.drop_duplicates(docs)


@stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8."""
    return near_dedup.drop_near_duplicates(docs, words=5, percent=80)


@stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    return packing.pack_documents(docs, TOKENIZER)


STAGES = [
    ("language_id", identify_language),
    ("quality_classifier", classify_quality),
    ("exact_dedup", drop_exact_duplicates),
    ("near_dedup", drop_near_duplicates),
    ("packing", pack),
]

#: Language parsing, the network and packing have no SQL; tests compare them with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each from what the one before has written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    with small_batches(spark):
        for name, function in STAGES:
            path = new_folder(spark, name)
            function(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)
            if before:
                remove_folder(spark, before)
            before = path
    return docs
