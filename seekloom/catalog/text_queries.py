"""Cleaning functions and tokenizing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seekloom import fixed_values as fv
from seekloom.catalog import sql
from seekloom.catalog.registry import documents, query, table
from seekloom.functions import text as tx
from seekloom.operators import index as ix
from seekloom.operators.lemmas import lemmatize_terms, plural_lemmas
from seekloom.plans.build import postings
from seekloom.session import cut_lineage


def _cleaned(name: str, function, pattern_sql: str) -> None:
    """A query that applies a cleaning function to all documents."""

    @query(name, f"SELECT doc_id, {pattern_sql} AS cleaned FROM documents")
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return documents(spark, folder).select("doc_id", function(F.col("text")).alias("cleaned"))


_cleaned("squeeze_whitespace", tx.clean_text, sql.squeeze("text"))
_cleaned("spell_in_ascii", tx.remove_unicode, sql.fold("text"))
_cleaned("remove_emails", tx.remove_emails, sql.remove("text", fv.EMAIL_PATTERN))
_cleaned("remove_phone_numbers", tx.remove_phone_number, sql.remove("text", fv.PHONE_PATTERN))
_cleaned("remove_percentages", tx.remove_percentages, sql.remove("text", fv.PERCENT_PATTERN))
_cleaned("remove_emoji", tx.remove_emoji, sql.remove(sql.remove("text", fv.EMOJI_PATTERN), fv.URL_PATTERN))
_cleaned("clean_documents", tx.preprocess_text, sql.clean("text"))
_cleaned(
    "remove_special_characters",
    lambda c: tx.remove_special_characters(tx.remove_unicode(c)),
    sql.remove(sql.fold("text"), fv.SPECIAL_PATTERN, " "),
)
_cleaned(
    "remove_single_characters",
    lambda c: tx.remove_single_character_tokens(tx.remove_unicode(c)),
    sql.remove(sql.fold("text"), fv.SINGLE_PATTERN),
)


def _on_rows(name: str, source: str, key: str, spark_text: str, sql_text: str, function, cleaned_sql) -> None:
    """A query that applies a cleaning function to texts made from a table's rows."""

    @query(
        name,
        f"SELECT {key}, text, {cleaned_sql('text')} AS cleaned FROM (SELECT {key}, {sql_text} AS text FROM {source})",
    )
    def run(spark: SparkSession, folder: str) -> DataFrame:
        texts = table(spark, folder, source).select(key, F.expr(spark_text).alias("text"))
        return texts.select(key, "text", function(F.col("text")).alias("cleaned"))


_UTF16 = "decode(unhex(lpad(hex({}), 4, '0')), 'UTF-16BE')"
_SCRIPT_CODES = ("880 + o_orderkey % 400", "7936 + o_custkey % 256", "12353 + o_orderkey % 191", "44032 + (o_orderkey * 31 + o_custkey) % 11172")
_on_rows(
    "spell_other_scripts",
    "orders",
    "o_orderkey",
    "concat(o_orderpriority, ' ', " + ", ".join(_UTF16.format(code) for code in _SCRIPT_CODES) + ")",
    "o_orderpriority || ' ' || " + " || ".join(f"chr(({code})::INTEGER)" for code in _SCRIPT_CODES),
    tx.remove_unicode,
    sql.fold,
)
_on_rows(
    "remove_dates",
    "orders",
    "o_orderkey",
    "concat(if(o_orderkey % 5 = 0, 'on ', ''), date_format(o_orderdate, case o_orderkey % 3 "
           "when 0 then 'MM/dd/yyyy' when 1 then 'M-d-yy' else 'yyyy-MM-dd' end))",
    "CASE WHEN o_orderkey % 5 = 0 THEN 'on ' ELSE '' END || CASE o_orderkey % 3 "
    "WHEN 0 THEN strftime(o_orderdate, '%m/%d/%Y') WHEN 1 THEN strftime(o_orderdate, '%-m-%-d-%y') "
    "ELSE strftime(o_orderdate, '%Y-%m-%d') END",
    tx.remove_dates,
    lambda e: sql.remove(e, tx.date_pattern()),
)
_on_rows(
    "remove_times",
    "events",
    "event_id",
    "concat('seen ', date_format(ts, case event_id % 3 when 0 then 'h:mm a' when 1 then 'HH:mm:ss' "
           "else 'HH:mm:ss.SSS' end), ' by ', user_id)",
    "'seen ' || CASE event_id % 3 WHEN 0 THEN strftime(ts, '%-I:%M %p') WHEN 1 THEN strftime(ts, '%H:%M:%S') "
    "ELSE strftime(ts, '%H:%M:%S.%g') END"
    " || ' by ' || user_id",
    tx.remove_times,
    lambda e: sql.remove(e, fv.TIME_PATTERN),
)
_on_rows(
    "remove_prices",
    "orders",
    "o_orderkey",
    "concat('paid ', case o_orderkey % 3 when 0 then '$' when 1 then '€ ' else '' end, "
           "cast(cast(o_totalprice as bigint) as string), case o_orderkey % 3 when 2 then ' usd' else '' end, ' net')",
    "'paid ' || CASE o_orderkey % 3 WHEN 0 THEN '$' WHEN 1 THEN '€ ' ELSE '' END || trunc(o_totalprice)::BIGINT "
    "|| CASE o_orderkey % 3 WHEN 2 THEN ' usd' ELSE '' END || ' net'",
    tx.remove_prices,
    lambda e: sql.remove(e, fv.PRICE_PATTERN),
)
_on_rows(
    "remove_degrees",
    "events",
    "event_id",
    "concat('at ', event_id, if(event_id % 2 = 0, ' ', ''), case event_id % 3 when 0 then '°C' "
           "when 1 then '°F' else '°X' end)",
    "'at ' || event_id || CASE event_id % 2 WHEN 0 THEN ' ' ELSE '' END || CASE event_id % 3 WHEN 0 THEN '°C' "
    "WHEN 1 THEN '°F' ELSE '°X' END",
    tx.remove_degrees,
    lambda e: sql.remove(e, fv.DEGREES_PATTERN),
)
_on_rows(
    "remove_urls",
    "pages",
    "page_id",
    "concat('see ', url, ' and www.', substring_index(url, '//', -1), ' too')",
    "'see ' || url || ' and www.' || string_split(url, '//')[2] || ' too'",
    tx.remove_url,
    lambda e: sql.remove(e, fv.URL_PATTERN),
)
_on_rows(
    "remove_tags",
    "pages",
    "page_id",
    "concat(html, ' < open')",
    "html || ' < open'",
    tx.remove_html,
    lambda e: sql.remove(e, fv.TAG_PATTERN),
)


@query(
    "split_tokens",
    f"SELECT doc_id, pos, token FROM (SELECT doc_id, unnest(t) AS token, unnest(range(len(t))) AS pos FROM "
    f"(SELECT doc_id, {sql.split(sql.clean('text'))} AS t FROM documents))",
)
def split_tokens(spark: SparkSession, folder: str) -> DataFrame:
    tokens = documents(spark, folder).select("doc_id", tx.split_tokens(tx.preprocess_text(F.col("text"))).alias("tokens"))
    return ix.token_rows(tokens).select("doc_id", F.col("pos").cast("long").alias("pos"), "token")


@query(
    "drop_stop_words",
    f"SELECT doc_id, len({sql.split('text')}) AS n_tokens, len(list_filter({sql.keep_words(sql.split('text'))}, "
    "lambda w: regexp_matches(w, '[a-zA-Z0-9_]'))) AS n_kept FROM documents",
)
def drop_stop_words(spark: SparkSession, folder: str) -> DataFrame:
    tokens = documents(spark, folder).select("doc_id", tx.split_tokens(F.col("text")).alias("t"))
    kept = tx.drop_stop_words(F.col("t"))
    return tokens.select("doc_id", F.size("t").cast("long").alias("n_tokens"), F.size(kept).cast("long").alias("n_kept"))


@query(
    "lower_tokens",
    f"SELECT doc_id, array_to_string(list_transform({sql.split('text')}, lambda t: lower(t)), ' ') AS tokens "
    "FROM documents",
)
def lower_tokens(spark: SparkSession, folder: str) -> DataFrame:
    tokens = tx.lower_tokens(tx.split_tokens(F.col("text")))
    return documents(spark, folder).select("doc_id", F.array_join(tokens, " ").alias("tokens"))


@query(
    "analyze_documents",
    f"SELECT doc_id, array_to_string({sql.analyze('text')}, ' ') AS tokens FROM documents",
)
def analyze_documents(spark: SparkSession, folder: str) -> DataFrame:
    return documents(spark, folder).select("doc_id", F.array_join(tx.analyze(F.col("text")), " ").alias("tokens"))


_GUESSES = (
    "guesses AS (SELECT word AS surface, 0 AS rank, regexp_replace(word, 'ies$', 'y') AS lemma FROM words "
    "WHERE regexp_matches(word, '[a-z]{2}ies$') "
    "UNION ALL SELECT word, 1, regexp_replace(word, 'es$', '') FROM words "
    "WHERE regexp_matches(word, '[a-z]{2}(?:s|x|z|ch|sh)es$') "
    "UNION ALL SELECT word, 2, regexp_replace(word, 's$', '') FROM words WHERE regexp_matches(word, '[a-z]{2}[^siu]s$')), "
    "lemmas AS (SELECT surface, arg_min(lemma, rank) AS lemma FROM guesses "
    "WHERE lemma IN (SELECT word FROM words) GROUP BY surface)"
)
LEMMAS_SQL = f"{sql.TF}, words AS (SELECT DISTINCT word FROM tf), {_GUESSES}"


@query("plural_lemmas", f"WITH {LEMMAS_SQL} SELECT surface, lemma FROM lemmas")
def plurals(spark: SparkSession, folder: str) -> DataFrame:
    return plural_lemmas(ix.vocabulary(cut_lineage(postings(documents(spark, folder)))))


@query(
    "lemmatized_term_frequencies",
    f"WITH {LEMMAS_SQL} SELECT coalesce(lemma, word) AS word, doc_id, sum(tf)::BIGINT AS tf "
    "FROM tf LEFT JOIN lemmas ON surface = word GROUP BY 1, 2",
)
def lemmatized(spark: SparkSession, folder: str) -> DataFrame:
    tf = cut_lineage(postings(documents(spark, folder)))
    return lemmatize_terms(tf, plural_lemmas(ix.vocabulary(tf)))
