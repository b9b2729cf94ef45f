"""The operators of this subpackage as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seekloom.llm import (
    exact_dedup,
    fingerprints,
    language_id,
    lm_scoring,
    near_dedup,
    packing,
    piece_sampling,
    prefix_trie,
    quality,
    quality_rules,
    token_files,
    url_filter,
    whitening,
)
from seekloom.session import new_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def query(name: str, oracle: str | None = None):
    def register(function):
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def _remainder(divisor: int):
    """crc32 of the id as text, modulo a number; 0 for a row without id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor, F.lit(0))


def half_replaced(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of another text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


@query("op1_fingerprints")
def op1_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.compare_with_next(_documents(spark, folder), half_replaced)


_NORMAL = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')"


@query(
    "op2_exact_dedup",
    f"""
    WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS n_chars, sha256({_NORMAL}) AS text_sha256, {_NORMAL} AS normal FROM documents)
    SELECT doc_id, first_value(doc_id) OVER own AS keep_id, count(*) OVER (PARTITION BY normal) AS group_size,
        row_number() OVER own = 1 AS kept, text_sha256
    FROM n WINDOW own AS (PARTITION BY normal ORDER BY n_chars DESC, doc_id)
    """,
)
def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.deduplicate(_documents(spark, folder)).drop("file", "at")


def quality_labels(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_id, label)`` of the rows that may be learned from."""
    labels = spark.read.parquet(f"{folder}/labels.parquet").where(_remainder(3) != 1)
    return labels.select("doc_id", F.col("quality").alias("label"))


@query("op3_quality_classifier")
def op3_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    documents = _documents(spark, folder)
    model = quality.learn(documents, quality_labels(spark, folder))
    scored = documents.select("doc_id", (_remainder(3) == 1).alias("held_out"), quality.quality_score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query("op4_packing")
def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack_documents(_documents(spark, folder), TOKENIZER)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query("op5_minhash_near_dedup")
def op5_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(_documents(spark, folder), words=4, percent=80)


def labelled_languages(documents: DataFrame) -> DataFrame:
    return documents.where(_remainder(5) != 0).select("doc_id", "text", "lang")


@query("op6_language_id")
def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = _documents(spark, folder)
    samples = language_id.learn_samples(labelled_languages(documents))
    judged = language_id.identify(documents.select("doc_id", "text"), samples)
    return judged.select("doc_id", (_remainder(5) == 0).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


#: The rules that judge hosts and paths.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


@query(
    "op7_url_filter",
    r"""
    WITH u AS (SELECT page_id, regexp_extract(coalesce(url, ''), '^.*?://(.*)$', 1, 's') AS rest FROM pages),
    p AS (
        SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path
        FROM u
    ),
    c AS (SELECT *, regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '(/|\.html)$', '') AS canonical FROM p),
    listed AS (SELECT canonical FROM c WHERE host <> '' GROUP BY canonical HAVING count(DISTINCT page_id) > 1),
    r AS (
        SELECT *, CASE
            WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
            WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
            WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
            WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/'
            END AS rule
        FROM c
    )
    SELECT page_id, host, path, rule, CASE
        WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
        WHEN host <> '' AND canonical IN (SELECT canonical FROM listed) THEN 'block' ELSE 'allow' END AS verdict
    FROM r
    """,
)
def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """The listed URLs are canonical URLs that were reposted: several pages have them."""
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    host, path = url_filter.host_and_path(F.col("url"))
    spelled = pages.select("page_id", url_filter.canonical(host, path).alias("canonical"), host.alias("host")).where("host != ''")
    listed = spelled.groupBy("canonical").agg(F.countDistinct("page_id").alias("n")).where("n > 1").select("canonical")
    return url_filter.judge_urls(pages, rules, listed).select("page_id", "host", "path", "rule", "verdict")


@query("op8_piece_sampling")
def op8_piece_sampling(spark: SparkSession, folder: str) -> DataFrame:
    return piece_sampling.encode_sampled(_documents(spark, folder), PIECES, digests=True)


@query("op9_lm_scoring")
def op9_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scoring.score_documents(_documents(spark, folder), lambda: _remainder(10) != 0)


@query("op10_token_files")
def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "tokens")
    token_files.write_token_files(_documents(spark, folder), path, TOKENIZER)
    return token_files.token_digests(token_files.read_token_files(spark, path))


@query("op11_embedding_whitening")
def op11_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{folder}/embeddings.parquet"), "vec_id", "embedding", components=4)


#: Turns that conversations have from the first of their group of ids, at most.
HEAD_TURNS = 3
GROUP_IDS = 20

_BITS = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
_CRC32 = f"""xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda c, i: {_BITS})), 4294967295)"""


@query(
    "op12_prefix_trie",
    f"""
    WITH t AS (
        SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL
    ),
    c AS (
        SELECT conv_id, list({{'turn': sha256(length(r) || ':' || r || x), 'words': len(regexp_extract_all(x, '[^\x20\x09-\x0D]+'))}}
            ORDER BY turn NULLS FIRST, sha256(length(r) || ':' || r || x)) AS own, {_CRC32} % 4 AS h
        FROM t GROUP BY conv_id
    ),
    b AS (
        SELECT c.conv_id, list_concat(coalesce(list_slice(p.own, 1, c.h), []), list_slice(c.own, c.h + 1, len(c.own))) AS turns
        FROM c LEFT JOIN c AS p ON p.conv_id = c.conv_id - c.conv_id % 20
    ),
    n AS (SELECT conv_id, len(turns) AS size, unnest(range(0, len(turns) + 1)) AS d, turns FROM b),
    nodes AS (
        SELECT list_slice(turns, 1, d) AS path, d, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * coalesce(any_value(turns[d].words), 0) AS saved,
            sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE size = d), '')) AS ends_sha256
        FROM n GROUP BY ALL
    ),
    children AS (SELECT list_slice(path, 1, d - 1) AS path, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
    full_nodes AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (path)),
    above AS (SELECT path, n_children, saved, unnest(range(0, d + 1)) AS k FROM full_nodes),
    sums AS (SELECT list_slice(path, 1, k) AS path, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved_tokens FROM above GROUP BY ALL)
    SELECT f.conv_id, f.d AS depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens, f.ends_sha256
    FROM full_nodes AS f JOIN sums USING (path) LEFT JOIN nodes AS p ON f.d > 0 AND p.path = list_slice(f.path, 1, f.d - 1)
    """,
)
def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = prefix_trie.turns_in_order(spark.read.parquet(f"{folder}/conversations.parquet"))
    base = F.col("conv_id") - F.col("conv_id") % GROUP_IDS
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (HEAD_TURNS + 1)
    return prefix_trie.prefix_trie(*prefix_trie.with_shared_heads(turns, base, head, HEAD_TURNS))


@query("op13_quality_rules")
def op13_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Learned from labelled rows whose crc32 modulo 3 is not 1, so the others can tell how good it is."""
    documents = _documents(spark, folder)
    judged = quality_rules.judge(documents, quality_rules.learn(documents, quality_labels(spark, folder)))
    return judged.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept", "score")
