"""Tuning parameters, one frozen dataclass per stage."""

from __future__ import annotations

from dataclasses import dataclass

from seekloom import fixed_values as fv


@dataclass(frozen=True)
class IndexConfig:
    """Text analysis and index layout."""

    stop_words: tuple[str, ...] = fv.STOP_WORDS
    fold_case: bool = True
    # A document over a cap has no tokens at all, so there is none unless asked for.
    max_chars: int | None = None
    max_tokens: int | None = None
    # Postings are stored in this many directories by word hash. A search reads
    # only those its words fall into, so raise it with the corpus (4096 at 100 TB).
    word_buckets: int = 16


@dataclass(frozen=True)
class SearchConfig:
    """Query expansion and ranking."""

    k1: float = 1.5
    b: float = 0.75
    max_synonyms: int = 7
    synonym_decay: float = 0.08
    min_cosine: float = 0.7
    unexpanded_weight: float = 4.0
    limit: int | None = 100


@dataclass(frozen=True)
class CrawlConfig:
    """Page filters and frontier limits."""

    blocked_domains: tuple[str, ...] = fv.BLOCKED_DOMAINS
    languages: tuple[str, ...] = fv.PAGE_LANGUAGES
    required_keywords: tuple[str, ...] = fv.REQUIRED_KEYWORDS
    file_suffixes: tuple[str, ...] = fv.FILE_SUFFIXES
    # Without limits a hop visits the whole queue, and the crawl ends when nothing is left.
    per_host: int | None = None
    batch_size: int | None = None
    max_pages: int | None = None
    max_hops: int | None = None
