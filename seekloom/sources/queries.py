"""Batch queries from a text file, and ranked results to a text file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def parse_query_lines(lines: DataFrame) -> DataFrame:
    """``lines(value)`` of number, blanks, query -> ``(query_id, text)``; blank lines skipped.

    The number is kept as it is written, as it need not be an integer.
    """
    line = F.trim(F.regexp_replace("value", r"^\s+|\s+$", ""))
    parsed = lines.select(line.alias("line")).where(F.col("line") != "")
    return parsed.select(
        F.regexp_extract("line", r"^(\S+)", 1).alias("query_id"),
        F.regexp_extract("line", r"^\S+\s+(.*)$", 1).alias("text"),
    )


def read_queries(spark: SparkSession, path: str) -> DataFrame:
    return parse_query_lines(spark.read.text(path))


def result_lines(results: DataFrame) -> DataFrame:
    """Columns of the result file, in its order: query number, rank, URL, score."""
    return results.select("query_id", "rank", "link", "score").orderBy("query_id", "rank")


def write_results(results: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Tab-separated, no header; the part files are in order of query and rank."""
    result_lines(results).write.mode(mode).option("sep", "\t").option("header", "false").csv(path)
