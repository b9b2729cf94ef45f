"""Stored index: documents, postings and inverse frequencies.

Postings lie in directories by word hash and are sorted by word in each file, so a
search reads the directories and row groups of its words only. They are shuffled
once, by directory, and partitions of a directory that grew large, as with a word
that most documents hold, are split at run time.

Documents and postings are added batch by batch, each into its own directory that
is overwritten as a whole. Writing a batch again, after a failure, changes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seekloom import schemas
from seekloom.config import IndexConfig
from seekloom.operators import index as ix
from seekloom.session import freed_shuffles


BASE = "base"


@dataclass(frozen=True)
class Index:
    documents: DataFrame
    tf: DataFrame
    idf: DataFrame
    buckets: int | None = None

    @property
    def size(self) -> DataFrame:
        """One row ``(n)``, the number of documents."""
        return ix.corpus_size(self.documents)

    @property
    def words(self) -> DataFrame:
        return ix.vocabulary(self.idf)


def write_documents(documents: DataFrame, path: str, batch: str = BASE) -> None:
    """Sorted by id in each file, so that a lookup of a few ids reads a few pages."""
    sorted_files = documents.sortWithinPartitions("doc_id")
    sorted_files.write.mode("overwrite").parquet(f"{path}/documents/batch={batch}")


class WrongLayout(ValueError):
    """Rows were about to be written in another layout than the index has."""


def stored_buckets(spark: SparkSession, path: str) -> int:
    """In how many directories the postings of an index lie."""
    return spark.read.schema(schemas.LAYOUT).parquet(f"{path}/layout").first()["word_buckets"]


def write_postings(tf: DataFrame, path: str, config: IndexConfig = IndexConfig(), batch: str = BASE) -> None:
    buckets = stored_buckets(tf.sparkSession, path)
    if buckets != config.word_buckets:
        raise WrongLayout(f"the index has {buckets} word buckets, not {config.word_buckets}")
    keys = ("word_bucket", "word", "doc_id")
    laid_out = ix.with_bucket(tf.select("word", "doc_id", "tf"), config.word_buckets)
    dealt = laid_out.hint("rebalance", "word_bucket").sortWithinPartitions(*keys)
    with freed_shuffles(tf.sparkSession):
        dealt.write.mode("overwrite").partitionBy("word_bucket").parquet(f"{path}/tf/batch={batch}")
    written = tf.sparkSession.read.schema(schemas.TERM_FREQUENCIES).parquet(f"{path}/tf/batch={batch}")
    ix.document_frequencies(written).write.mode("overwrite").parquet(f"{path}/df/batch={batch}")


def write_frequencies(spark: SparkSession, path: str) -> None:
    """Compute idf from the batches' document frequencies, which add up; postings are not read.

    It depends on all documents, so it is never patched.
    """
    parts = spark.read.schema(schemas.stored(schemas.DOCUMENT_FREQUENCIES)).parquet(f"{path}/df")
    idf = ix.idf_of_frequencies(parts.groupBy("word").agg(F.sum("df").alias("df")), read_documents(spark, path))
    idf.sortWithinPartitions("word").write.mode("overwrite").parquet(f"{path}/idf")


def read_documents(spark: SparkSession, path: str, without_batch: str | None = None) -> DataFrame:
    stored = spark.read.schema(schemas.stored(schemas.DOCUMENTS)).parquet(f"{path}/documents")
    return (stored if without_batch is None else stored.where(F.col("batch") != without_batch)).drop("batch")


def read_postings(spark: SparkSession, path: str) -> DataFrame:
    schema = schemas.stored(schemas.TERM_FREQUENCIES, "word_bucket")
    return spark.read.schema(schema).parquet(f"{path}/tf").drop("batch")


def read_frequencies(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.INVERSE_FREQUENCIES).parquet(f"{path}/idf")


def read_index(spark: SparkSession, path: str) -> Index:
    """The index at a path, in the layout it was built with."""
    buckets = stored_buckets(spark, path)
    return Index(read_documents(spark, path), read_postings(spark, path), read_frequencies(spark, path), buckets)


def reset_index(spark: SparkSession, path: str, config: IndexConfig = IndexConfig()) -> None:
    """Empty documents, postings and frequencies, and the layout of what will be written.

    Raw pages are kept elsewhere and stay.
    """
    spark.createDataFrame([(config.word_buckets,)], schemas.LAYOUT).write.mode("overwrite").parquet(f"{path}/layout")
    for name, schema in (
        ("documents", schemas.stored(schemas.DOCUMENTS)),
        ("tf", schemas.stored(schemas.TERM_FREQUENCIES, "word_bucket")),
        ("df", schemas.stored(schemas.DOCUMENT_FREQUENCIES)),
    ):
        spark.createDataFrame([], schema).write.mode("overwrite").partitionBy("batch").parquet(f"{path}/{name}")
    spark.createDataFrame([], schemas.INVERSE_FREQUENCIES).write.mode("overwrite").parquet(f"{path}/idf")


def document_count(index: Index) -> DataFrame:
    """One row ``(doc_count)``."""
    return index.documents.agg(F.count("*").alias("doc_count"))
