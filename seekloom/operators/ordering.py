"""Dense positions and first-n rows of a total order, without one big sort task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seekloom.session import cut_lineage

SMALL_LIMIT = 10_000
_INDEX_BITS = 33


def with_position(df: DataFrame, *order: Column, name: str = "position") -> DataFrame:
    """Number the rows 0, 1, 2, ... in an order that must be total.

    Rows are range-sorted and stored. Each keeps its partition and its index in it;
    the number of rows in earlier partitions, one value per partition, is added.
    """
    numbered = df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id())
    stored = cut_lineage(
        numbered.select(
            "*",
            F.shiftright("_at", _INDEX_BITS).cast("int").alias("_part"),
            F.col("_at").bitwiseAND((1 << _INDEX_BITS) - 1).alias("_index"),
        ).drop("_at")
    )
    counts = {r["_part"]: r["count"] for r in stored.groupBy("_part").count().collect()}
    starts, total = [], 0
    for part in sorted(counts):
        starts.append((part, total))
        total += counts[part]
    offsets = df.sparkSession.createDataFrame(starts, "_part int, _start long")
    return (
        stored.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_start") + F.col("_index"))
        .drop("_part", "_index", "_start")
    )


def first_rows(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first ``n`` rows of a total order."""
    if n <= SMALL_LIMIT:
        return df.orderBy(*order).limit(n)
    if df.count() <= n:
        return df
    return with_position(df, *order, name="_position").where(F.col("_position") < n).drop("_position")
