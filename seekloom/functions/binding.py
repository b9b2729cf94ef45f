"""Name an intermediate value inside one expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row.

    A column that is named in a projection and used several times after it may be
    computed again for each use, as when a filter on it moves below the projection.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
