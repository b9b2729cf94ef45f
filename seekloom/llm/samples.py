"""Bounded samples of labelled rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows that pass the first cut for each that is taken; so few never fall short.
_SPARE = 4
_RANGE = 1 << 31


def least_hashed(ids: DataFrame, label: str, key: str, rows: int) -> DataFrame:
    """Up to ``rows`` rows of each value of ``label``, those with the least hashes of ``key``.

    Labels are few; their counts are the only thing the driver gets. A first cut by hash leaves
    a small multiple of the sample, whatever the size of the table; then each label's rows are
    ordered. Rows with a null label or key are left out. The hash is kept as ``order``.
    """
    hashed = ids.where(F.col(label).isNotNull() & F.col(key).isNotNull()).withColumn("order", F.xxhash64(F.col(key).cast("string")))
    counts = hashed.groupBy(label).count().collect()
    place = F.pmod(F.col("order"), F.lit(_RANGE))
    parts = []
    for value, count in sorted(((r[label], r["count"]) for r in counts), key=str):
        bound = min(_RANGE, _RANGE * _SPARE * max(rows, 32) // count)
        parts.append(hashed.where((F.col(label) == value) & (place < bound)).orderBy(place, key).limit(rows))
    return reduce(DataFrame.unionByName, parts) if parts else hashed.limit(0)
