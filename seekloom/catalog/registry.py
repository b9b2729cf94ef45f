"""Registration of queries, and the tables they read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seekloom.plans.build import build_index, titles_and_links
from seekloom.session import new_folder
from seekloom.sources.index_store import Index
from seekloom.sources.pages import spread

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

_built: dict[tuple[str, str], Index] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with its SQL if there is one."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents"))


def pages(spark: SparkSession, folder: str) -> DataFrame:
    """``(page_id, link, html)``."""
    return spread(table(spark, folder, "pages").select("page_id", F.col("url").alias("link"), "html"))


def user_queries(spark: SparkSession, folder: str) -> DataFrame:
    """``(query_id, text)``: what users say in the conversations."""
    turns = table(spark, folder, "conversations").where(F.col("role") == "user")
    return turns.select((F.col("conv_id") * 1000 + F.col("turn")).alias("query_id"), "text")


def document_index(spark: SparkSession, folder: str) -> Index:
    """The stored index of all documents, built once per session and folder."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _built:
        texts = titles_and_links(documents(spark, folder))
        _built[key] = build_index(texts, new_folder(spark, "index"))
    return _built[key]
