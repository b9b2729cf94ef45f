"""Page filters. Each is a condition; ``reject_reason`` applies them in order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seekloom import fixed_values as fv
from seekloom.config import CrawlConfig
from seekloom.functions import urls
from seekloom.functions.language import detected_language


def has_text(text: Column) -> Column:
    return F.coalesce(F.length(text) > 0, F.lit(False))


def not_null(*columns: Column) -> Column:
    """Guard of a stage: all its inputs are there."""
    condition = F.lit(True)
    for column in columns:
        condition = condition & column.isNotNull()
    return condition


def in_language(
    lang: Column, xml_lang: Column, url: Column, detected: Column, languages: tuple[str, ...] = fv.PAGE_LANGUAGES
) -> Column:
    """Any of: declared language, XML language, a piece of the URL, detected language."""
    return (
        F.coalesce(lang.isin(*languages), F.lit(False))
        | F.coalesce(xml_lang.isin(*languages), F.lit(False))
        | F.arrays_overlap(F.split(url, "/"), F.array(*map(F.lit, languages)))
        | F.coalesce(detected.isin(*languages), F.lit(False))
    )


def has_keyword(text: Column, keywords: tuple[str, ...] = fv.REQUIRED_KEYWORDS) -> Column:
    """Whether the lowercase text holds any of the keywords."""
    return F.exists(F.array(*map(F.lit, keywords)), lambda k: F.contains(text, k))


def within_char_cap(text: Column, max_chars: int = 200_000) -> Column:
    return F.length(text) <= max_chars


def within_token_cap(tokens: Column, max_tokens: int = 6_000) -> Column:
    return F.size(tokens) <= max_tokens


def url_reject_reason(url: Column, allowed: Column, config: CrawlConfig = CrawlConfig()) -> Column:
    """Why a URL is not fetched at all; null if it may be."""
    return (
        F.when(~urls.has_http_scheme(url), "scheme")
        .when(urls.is_blocked(url, config.blocked_domains), "blocked domain")
        .when(~allowed, "robots")
    )


def with_reject_reason(parsed: DataFrame, config: CrawlConfig = CrawlConfig(), url: str = "link") -> DataFrame:
    """Add ``reason`` to pages parsed with lang, xml_lang, has_html and page_text.

    Adds ``text``, the lowercase page text, and ``detected`` on the way. Conditions
    are tried in the order of checks, so each page gets the first that fails.
    """
    if "allowed" not in parsed.columns:
        parsed = parsed.withColumn("allowed", F.lit(True))
    link = F.col(url)
    staged = parsed.withColumn("text", F.lower("page_text")).withColumn("detected", detected_language(F.col("text")))
    language = in_language(F.col("lang"), F.col("xml_lang"), link, F.col("detected"), config.languages)
    reason = F.coalesce(
        url_reject_reason(link, F.col("allowed"), config),
        F.when(~has_text(F.col("text")), "empty")
        .when(~F.col("has_html"), "no html element")
        .when(~language, "language")
        .when(~has_keyword(F.col("text"), config.required_keywords), "keywords"),
    )
    return staged.withColumn("reason", reason)
