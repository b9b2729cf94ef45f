"""Streams of pages. The pages table arrives as a stream of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seekloom.catalog.index_queries import _PAGE_TF
from seekloom.catalog.registry import query, table
from seekloom.session import new_folder
from seekloom.streaming import ingest as ing


def _arriving_pages(spark: SparkSession, folder: str) -> DataFrame:
    """All pages as four files, and the English ones once more, two files per batch."""
    path = new_folder(spark, "arriving")
    found = table(spark, folder, "pages").select(F.col("url").alias("link"), "html")
    found.repartition(4).write.parquet(path)
    found.where(F.col("link").contains("/en/")).coalesce(1).write.mode("append").parquet(path)
    return ing.read_page_stream(spark, path, files_per_trigger=2)


@query("stream_one_page_per_link", "SELECT url AS link, length(html) AS n_chars FROM pages")
def stream_one_page_per_link(spark: SparkSession, folder: str) -> DataFrame:
    path, checkpoint = new_folder(spark, "unique"), new_folder(spark, "checkpoint")
    ing.start_unique(_arriving_pages(spark, folder), path, checkpoint).awaitTermination()
    return spark.read.parquet(path).select("link", F.length("html").cast("long").alias("n_chars"))


_INDEXED = (
    f"WITH {_PAGE_TF}, idf AS (SELECT word, log10((SELECT count(*) FROM pages) / count(*)) AS idf FROM tf GROUP BY word) "
    "SELECT url AS link, word, tf, round(idf, 6) AS idf FROM tf JOIN idf USING (word) JOIN pages ON page_id = doc_id"
)


@query("stream_ingest", _INDEXED)
def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    path, checkpoint = new_folder(spark, "index"), new_folder(spark, "checkpoint")
    ing.prepare(spark, path)
    ing.start_ingest(_arriving_pages(spark, folder), path, checkpoint).awaitTermination()
    built = ing.finalize(spark, path)
    rows = built.tf.join(built.idf, "word").join(built.documents.select("doc_id", "link"), "doc_id")
    return rows.select("link", "word", "tf", F.round("idf", 6).alias("idf"))


@query("stream_ingest_twice", _INDEXED)
def stream_ingest_twice(spark: SparkSession, folder: str) -> DataFrame:
    """Two streams with checkpoints of their own fill one index."""
    path = new_folder(spark, "index")
    ing.prepare(spark, path)
    found = table(spark, folder, "pages").select(F.col("url").alias("link"), "html", "page_id")
    for part in (0, 1):
        source = new_folder(spark, "arriving")
        found.where(F.col("page_id") % 2 == part).drop("page_id").write.parquet(source)
        ing.start_ingest(ing.read_page_stream(spark, source), path, new_folder(spark, "checkpoint")).awaitTermination()
    built = ing.finalize(spark, path)
    rows = built.tf.join(built.idf, "word").join(built.documents.select("doc_id", "link"), "doc_id")
    return rows.select("link", "word", "tf", F.round("idf", 6).alias("idf"))
