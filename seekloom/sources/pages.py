"""Raw page store: one row per link, raw HTML, Parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seekloom import schemas
from seekloom.operators.joins import fits_broadcast, without_stored

#: A partition may hold so many times a core's share of the rows.
UNEVEN = 1.25


def one_per_link(pages: DataFrame, first_by: Column | None = None) -> DataFrame:
    """One page per link, null pages dropped.

    With ``first_by`` the first page of a link is kept, else that with the smallest hash, so
    that a repeated run keeps the same one. Links that occur
    more than once are found from the link column alone. Only their pages are
    shuffled, unless those links are too many to send to the scan; copies are
    combined before the shuffle, however many there are.
    """
    valid = pages.where(F.col("html").isNotNull() & F.col("link").isNotNull())
    repeated = pages.groupBy("link").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("link")
    if not fits_broadcast(repeated):
        return _first_of_each(valid, first_by)
    listed = F.broadcast(repeated)
    alone = valid.join(listed, "link", "left_anti").select(pages.columns)
    return alone.unionByName(_first_of_each(valid.join(listed, "link", "left_semi"), first_by).select(pages.columns))


def _first_of_each(pages: DataFrame, first_by: Column | None) -> DataFrame:
    if first_by is None:
        first_by = F.struct(F.xxhash64("html"), "html")
    others = [c for c in pages.columns if c != "link"]
    best = pages.groupBy("link").agg(F.min_by(F.struct(*others), first_by).alias("page"))
    return best.select("link", *[F.col(f"page.{c}").alias(c) for c in others])


def spread(scan: DataFrame) -> DataFrame:
    """Deal the rows of a scan of few files, or of few row groups, out over all cores.

    For work that is heavy per row. A scan whose rows lie in enough partitions stays as it is. A
    row group is read by one task however many partitions its file is cut into, so the rows are
    counted, which reads no column.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    partitions = scan.rdd.getNumPartitions()
    if partitions < cores:
        return scan.repartition(cores)
    held = scan.groupBy(F.spark_partition_id().alias("partition")).agg(F.count("*").alias("n"))
    most, rows = held.agg(F.max("n"), F.sum("n")).first()
    if not rows or most * cores <= UNEVEN * rows:
        return scan
    # Dealt by place, as Spark sorts rows that are dealt in turn.
    dealt = scan.withColumn("_place", F.monotonically_increasing_id()).repartition(partitions, "_place")
    return dealt.drop("_place")


def write_pages(pages: DataFrame, path: str, stored: DataFrame | None = None, mode: str = "append") -> None:
    """Add the pages whose link is not stored yet."""
    fresh = one_per_link(pages.select("link", "html"))
    if stored is not None:
        fresh = without_stored(fresh, stored, "link")
    fresh.write.mode(mode).option("compression", "zstd").parquet(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """All stored pages that are not null."""
    return spark.read.schema(schemas.PAGES).parquet(path).where(F.col("html").isNotNull())


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """Word vectors ``(word, vector)``."""
    return spark.read.schema(schemas.VECTORS).parquet(path)


def vectors_from_text(spark: SparkSession, path: str) -> DataFrame:
    """Word vectors from text lines of a word and its numbers, separated by blanks."""
    parts = F.split("value", " ")
    return spark.read.text(path).select(
        parts[0].alias("word"), F.slice(parts, 2, F.size(parts) - 1).cast("array<float>").alias("vector")
    )
