"""Every operator as a query over the given tables, with DuckDB SQL to compare.

Importing the modules fills :data:`QUERIES` and :data:`ORACLES`.
"""

from seekloom.catalog.registry import ORACLES, QUERIES

from seekloom.catalog import (  # noqa: E402,F401  isort: skip
    expansion_queries,
    frontier_queries,
    index_queries,
    lemma_queries,
    page_queries,
    presentation_queries,
    ranking_queries,
    stream_queries,
    summary_queries,
    text_queries,
    url_queries,
    vector_queries,
)

__all__ = ["ORACLES", "QUERIES"]
