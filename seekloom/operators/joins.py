"""Joins of a large table with a lookup table of unknown size.

A lookup table is broadcast only after its size was measured. Past the bound the
join is a shuffle whose key is salted, so that a word or host which holds a large
share of the rows is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 32


def row_bytes(df: DataFrame) -> Column:
    """Upper estimate of a row's size from its actual strings and arrays."""
    size = F.lit(16)
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(column), F.lit(0)) + 16
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)) + 16
        else:
            size = size + 16
    return size


def measured_bytes(df: DataFrame) -> int:
    """Size of all rows of a table; one small aggregate reaches the driver."""
    return df.agg(F.coalesce(F.sum(row_bytes(df).cast("long")), F.lit(0)).alias("n")).first()["n"]


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    return measured_bytes(df) <= max_bytes


def lookup_join(
    large: DataFrame,
    lookup: DataFrame,
    on: list[str],
    how: str = "inner",
    salt_by: Column | None = None,
    max_bytes: int = BROADCAST_BYTES,
    salts: int = SALTS,
    small: bool | None = None,
) -> DataFrame:
    """Join a large table with a lookup table on equal keys.

    ``how`` is one that keeps the large side: inner, left, left_semi or left_anti.
    ``salt_by`` is a column of the large table that varies within a key. ``small``
    tells the outcome of an earlier measurement; without it the table is measured.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"lookup_join cannot keep the large side for a {how} join")
    if small is None:
        small = fits_broadcast(lookup, max_bytes)
    if small:
        return large.join(F.broadcast(lookup), on, how)
    if salt_by is None:
        return large.join(lookup, on, how)
    salted = large.withColumn("_salt", F.pmod(F.xxhash64(salt_by), F.lit(salts)).cast("int"))
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")


def without_stored(
    new_rows: DataFrame,
    stored: DataFrame,
    key: str,
    max_bytes: int = BROADCAST_BYTES,
    small: bool | None = None,
) -> DataFrame:
    """New rows whose key is not stored yet.

    With few new rows, their keys go to the stored table's scan and only the
    matches come back, so the large stored table is not shuffled.
    """
    keys = new_rows.select(key)
    if small is None:
        small = fits_broadcast(keys, max_bytes)
    if small:
        known = stored.select(key).join(F.broadcast(keys.distinct()), key, "left_semi").distinct()
        return new_rows.join(known, key, "left_anti")
    return new_rows.join(stored.select(key), key, "left_anti")
