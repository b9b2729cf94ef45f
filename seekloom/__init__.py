"""Spark-native web-text retrieval: index build, search and presentation."""

from seekloom.config import CrawlConfig, IndexConfig, SearchConfig

__all__ = ["CrawlConfig", "IndexConfig", "SearchConfig"]
