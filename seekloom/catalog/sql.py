"""DuckDB SQL fragments that say in SQL what the operators compute."""

from __future__ import annotations

from seekloom import fixed_values as fv
from seekloom.functions.text import NON_ASCII, date_pattern, split_spellings


def text(value: str) -> str:
    """A string literal."""
    return "'" + value.replace("'", "''") + "'"


def strings(values) -> str:
    return "[" + ", ".join(text(v) for v in values) + "]"


def remove(expression: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({expression}, {text(pattern)}, {text(by)}, 'g')"


# Kana in the order of their code points from U+3041 on, of which katakana lie 96 further.
_KANA = (
    "a a i i u u e e o o ka ga ki gi ku gu ke ge ko go sa za shi zi su zu se ze so zo ta da chi di tsu tsu du te de to do "
    "na ni nu ne no ha ba pa hi bi pi hu bu pu he be pe ho bo po ma mi mu me mo ya ya yu yu yo yo ra ri ru re ro "
    "wa wa wi we wo n vu ka ke va vi ve vo"
).split()


def spell_scripts(e: str) -> str:
    """Greek, Cyrillic, kana and Hangul in ASCII. Letters with marks are looked up without them as well."""
    letters = {**fv.GREEK_SPELLINGS, **fv.CYRILLIC_SPELLINGS}
    letters = {**{c.upper(): s.capitalize() for c, s in letters.items()}, **letters}
    known = "MAP {" + ", ".join(f"{text(c)}: {text(s)}" for c, s in letters.items()) + "}"
    kana = f"{strings(_KANA)}[CASE WHEN unicode(c) >= 12449 THEN unicode(c) - 12448 ELSE unicode(c) - 12352 END]"
    hangul = " || ".join(
        f"{strings(names)}[{place} + 1]"
        for names, place in (
            (fv.HANGUL_LEADS, "(unicode(c) - 44032) // 588"),
            (fv.HANGUL_VOWELS, "(unicode(c) - 44032) % 588 // 28"),
            (fv.HANGUL_TAILS, "(unicode(c) - 44032) % 28"),
        )
    )
    letter = (
        f"CASE WHEN unicode(c) BETWEEN 880 AND 1279 OR unicode(c) BETWEEN 7936 AND 8191 THEN coalesce({known}[c], {known}[strip_accents(c)], '') "
        f"WHEN unicode(c) BETWEEN 12353 AND 12438 OR unicode(c) BETWEEN 12449 AND 12538 THEN {kana} "
        f"WHEN unicode(c) BETWEEN 44032 AND 55203 THEN {hangul} ELSE c END"
    )
    held = r"[\x{370}-\x{4FF}\x{1F00}-\x{1FFF}\x{3041}-\x{30FF}\x{AC00}-\x{D7A3}]"
    return f"CASE WHEN regexp_matches({e}, '{held}') THEN array_to_string(list_transform(string_split({e}, ''), lambda c: {letter}), '') ELSE {e} END"


def fold(e: str) -> str:
    single, longer = split_spellings()
    e = spell_scripts(e)
    for char, spelling in longer.items():
        e = f"replace({e}, {text(char)}, {text(spelling)})"
    e = f"translate({e}, {text(''.join(single))}, {text(''.join(single.values()))})"
    return remove(e, NON_ASCII)


def squeeze(e: str) -> str:
    return f"trim({remove(e, r'\s+', ' ')})"


def clean(e: str) -> str:
    """The whole cleaning chain."""
    e = fold(e)
    for pattern in (
        fv.URL_PATTERN,
        fv.TAG_PATTERN,
        fv.EMAIL_PATTERN,
        fv.DEGREES_PATTERN,
        fv.TIME_PATTERN,
        fv.PHONE_PATTERN,
        date_pattern(),
        fv.EMOJI_PATTERN,
        fv.URL_PATTERN,
        fv.PRICE_PATTERN,
        fv.PERCENT_PATTERN,
    ):
        e = remove(e, pattern)
    return remove(remove(e, fv.SPECIAL_PATTERN, " "), fv.SINGLE_PATTERN)


def split(e: str) -> str:
    return f"list_filter(string_split_regex({e}, '\\s+'), lambda t: t <> '')"


def keep_words(tokens: str) -> str:
    return f"list_filter({tokens}, lambda t: NOT list_contains({strings(fv.STOP_WORDS)}, lower(t)))"


def analyze(e: str) -> str:
    return keep_words(split(f"lower({clean(e)})"))


def tokens_cte(source: str, key: str = "doc_id", column: str = "text") -> str:
    """``tok(key, tokens)`` of rows with tokens."""
    return f"tok AS (SELECT {key}, tokens FROM (SELECT {key}, {analyze(column)} AS tokens FROM {source}) WHERE len(tokens) >= 1)"


TF = (
    f"{tokens_cte('documents')}, "
    "tf AS (SELECT word, doc_id, count(*) AS tf FROM (SELECT doc_id, unnest(tokens) AS word FROM tok) "
    "GROUP BY word, doc_id)"
)
IDF = (
    f"{TF}, idf AS (SELECT word, count(*) AS df, "
    "log10((SELECT count(*) FROM documents) / count(*)) AS idf FROM tf GROUP BY word)"
)

QUERIES = "queries AS (SELECT conv_id * 1000 + turn AS query_id, text FROM conversations WHERE role = 'user')"
QUERY_TOKENS = (
    f"{QUERIES}, qtok AS (SELECT query_id, unnest(tokens) AS token, unnest(range(len(tokens))) AS pos "
    f"FROM (SELECT query_id, {analyze('text')} AS tokens FROM queries WHERE trim(text) <> ''))"
)
QUERY_WORDS = (
    f"{QUERY_TOKENS}, qsize AS (SELECT query_id, count(*) AS n FROM qtok GROUP BY query_id), "
    "qword AS (SELECT DISTINCT query_id, token, CASE WHEN n <= 7 THEN 7 ELSE trunc(7 * exp(-0.08 * n))::INT END "
    "AS budget FROM qtok JOIN qsize USING (query_id))"
)

UNESCAPED = {"&quot;": '"', "&middot;": "·", "&copy;": "©", "&lt;": "<", "&gt;": ">", "&amp;": "&"}


def unescape(e: str) -> str:
    for entity, char in UNESCAPED.items():
        e = f"replace({e}, {text(entity)}, {text(char)})"
    return e


ARTICLE = r"regexp_extract(html, '(?s)<article>(.*?)</article>', 1)"
MAIN_TEXT = squeeze(unescape(remove(ARTICLE, "<[^>]*>", " ")))
TITLE = squeeze(unescape("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)"))
SEARCHABLE = f"trim({MAIN_TEXT} || '  ' || {TITLE})"
SEEN_HTML = remove("html", r"(?s)<script>.*?</script>|<style>.*?</style>|<!--.*?-->|<!DOCTYPE[^>]*>")
PAGE_TEXT = unescape(remove(SEEN_HTML, "<[^>]*>"))

LANGUAGE_WORDS = "list_filter(string_split_regex(lower({e}), '[^\\p{{L}}]+'), lambda w: w <> '')"


def detected(words: str) -> str:
    """Language with most hits among its frequent words; the last name on a tie."""
    scores = ", ".join(
        f"{{'hits': len(list_filter({words}, lambda w: list_contains({strings(profile)}, w))), 'lang': {text(lang)}}}"
        for lang, profile in fv.LANGUAGE_PROFILES.items()
    )
    best = f"list_max([{scores}])"
    return f"CASE WHEN ({best}).hits > 0 THEN ({best}).lang END"


BASE_URL = "regexp_extract({e}, '^([a-z]+://[^/?#]*)', 1)"


def base_url(e: str) -> str:
    return BASE_URL.format(e=e)


SUFFIXES = r"\.(?:" + "|".join(fv.FILE_SUFFIXES) + ")$"
# Links of the pages all start with one slash, so the base URL is put before them.
EDGES = (
    "hrefs AS (SELECT url AS src, unnest(h) AS href, unnest(range(len(h))) AS pos FROM "
    "(SELECT url, regexp_extract_all(html, '<a\\s[^>]*?href=\"([^\"]*)\"', 1) AS h FROM pages)), "
    f"edges AS (SELECT src, {base_url('src')} || string_split(href, '#')[1] AS dst, pos FROM hrefs "
    f"WHERE href LIKE '/%' AND NOT regexp_matches(string_split(href, '#')[1], {text(SUFFIXES)}))"
)
