"""Crawl snapshot: frontier, rejected and done URLs as three tables."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seekloom import schemas
from seekloom.session import cut_lineage


@dataclass(frozen=True)
class CrawlState:
    frontier: DataFrame
    rejected: DataFrame
    done: DataFrame

    @property
    def finished(self) -> bool:
        """Whether nothing is left to visit; else a limit has stopped the crawl."""
        return self.frontier.isEmpty()


def seed_frontier(spark: SparkSession, seeds: Iterable[str]) -> DataFrame:
    """Start URLs in their order."""
    rows = [(url, 0, position) for position, url in enumerate(dict.fromkeys(seeds))]
    return spark.createDataFrame(rows, schemas.FRONTIER)


def start_state(spark: SparkSession, seeds: DataFrame) -> CrawlState:
    return CrawlState(
        seeds, spark.createDataFrame([], schemas.REJECTED), spark.createDataFrame([], schemas.DONE)
    )


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def save_state(state: CrawlState, path: str) -> None:
    """Write a snapshot; the frontier without repeated URLs.

    Rows are stored elsewhere first, as a state may have been read from ``path``.
    """
    first = F.min(F.struct("round", "seq")).alias("at")
    frontier = state.frontier.groupBy("url").agg(first).select("url", "at.round", "at.seq")
    for name, table in (("frontier", frontier), ("rejected", state.rejected), ("done", state.done)):
        cut_lineage(table).write.mode("overwrite").parquet(f"{path}/{name}")


def load_state(spark: SparkSession, path: str, seeds: DataFrame) -> CrawlState:
    """The snapshot at a path; without one, a start from the seeds."""
    if not _exists(spark, f"{path}/done"):
        return start_state(spark, seeds)
    return CrawlState(
        spark.read.schema(schemas.FRONTIER).parquet(f"{path}/frontier"),
        spark.read.schema(schemas.REJECTED).parquet(f"{path}/rejected"),
        spark.read.schema(schemas.DONE).parquet(f"{path}/done"),
    )
