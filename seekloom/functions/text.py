"""Text cleaning and tokenizing as native column expressions.

Every function takes and returns a ``Column``, so a whole chain stays one
projection in the JVM. Patterns that would scan a long run of characters again
from each of its positions are rewritten here to start only where a run starts,
which gives the same matches in linear time on junk such as encoded blobs.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from seekloom import fixed_values as fv
from seekloom.config import IndexConfig
from seekloom.functions.binding import let
from seekloom.functions.scripts import spell_scripts

NON_ASCII = r"[^\x00-\x7F]"

# Blocks whose letters are folded: Latin-1 to Latin Extended-B, Latin Extended
# Additional, super- and subscripts, ligatures and full-width forms.
_FOLDED_BLOCKS = ((0xA0, 0x24F), (0x1E00, 0x1EFF), (0x2070, 0x209C), (0xFB00, 0xFB06), (0xFF01, 0xFF5E))


def ascii_spellings() -> dict[str, str]:
    """Character -> ASCII, by canonical decomposition plus the fixed spellings."""
    spellings = {}
    for first, last in _FOLDED_BLOCKS:
        for char in map(chr, range(first, last + 1)):
            base = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))
            if base.isascii():
                spellings[char] = base
    return {**spellings, **fv.LETTER_SPELLINGS, **fv.SYMBOL_SPELLINGS}


def split_spellings() -> tuple[dict[str, str], dict[str, str]]:
    """The spellings of exactly one character, and the longer or empty ones."""
    spellings = ascii_spellings()
    single = {c: s for c, s in spellings.items() if len(s) == 1}
    longer = {c: s for c, s in spellings.items() if len(s) > 1}
    return single, longer


def date_pattern() -> str:
    """A whole-string date: one alternative per separator, so no back-reference."""
    shapes = [
        shape.format(sep=sep, year=fv.DATE_YEAR, leap_year=fv.DATE_LEAP_YEAR)
        for sep in fv.DATE_SEPARATORS
        for shape in fv.DATE_SHAPES
    ]
    return "^(?:" + "|".join(shapes) + r")\n?\z"


def clean_text(c: Column) -> Column:
    """Whitespace runs become one space; ends are trimmed."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def remove_unicode(c: Column) -> Column:
    """Spell the text in ASCII and drop what has no spelling."""
    single, longer = split_spellings()

    def respell(t: Column) -> Column:
        for char, spelling in longer.items():
            t = F.replace(t, F.lit(char), F.lit(spelling))
        return F.regexp_replace(spell_scripts(t), NON_ASCII, "")

    def fold(t: Column) -> Column:
        letters = F.translate(t, "".join(single), "".join(single.values()))
        return let(letters, lambda u: F.when(u.rlike(NON_ASCII), respell(u)).otherwise(u))

    return let(c, lambda t: F.when(t.rlike(NON_ASCII), fold(t)).otherwise(t))


def remove_url(c: Column) -> Column:
    return F.regexp_replace(c, fv.URL_PATTERN, "")


def remove_html(c: Column) -> Column:
    # A "<" that no ">" follows on its line is put back together with the rest
    # of the line, where no other "<" can be closed either.
    return F.regexp_replace(c, r"<[^>\n]*+>|(<[^>\n]*+)", "$1")


def remove_emails(c: Column) -> Column:
    local = r"(?:\G|(?<![a-zA-Z0-9_.+-]))[a-zA-Z0-9_.+-]++@"
    return F.regexp_replace(c, local + fv.EMAIL_PATTERN.split("@")[1], "")


def remove_degrees(c: Column) -> Column:
    return F.regexp_replace(c, r"(?<!\d)" + fv.DEGREES_PATTERN, "")


def remove_times(c: Column) -> Column:
    return F.regexp_replace(c, fv.TIME_PATTERN, "")


def remove_phone_number(c: Column) -> Column:
    return F.regexp_replace(c, fv.PHONE_PATTERN, "")


def remove_dates(c: Column) -> Column:
    return F.regexp_replace(c, date_pattern(), "")


def remove_emoji(c: Column) -> Column:
    return remove_url(F.regexp_replace(c, fv.EMOJI_PATTERN, ""))


def remove_prices(c: Column) -> Column:
    return F.regexp_replace(c, fv.PRICE_PATTERN, "")


def remove_percentages(c: Column) -> Column:
    return F.regexp_replace(c, r"(?<!\d)\d++%", "")


def remove_special_characters(c: Column) -> Column:
    return F.regexp_replace(c, fv.SPECIAL_PATTERN, " ")


def remove_single_character_tokens(c: Column) -> Column:
    return F.regexp_replace(c, fv.SINGLE_PATTERN, "")


def _only_where(condition: Callable[[Column], Column], *steps: Callable[[Column], Column]) -> Callable[[Column], Column]:
    """Steps that are skipped where a cheap test says that they cannot match."""

    def run(c: Column) -> Column:
        def apply(t: Column) -> Column:
            changed = t
            for step in steps:
                changed = step(changed)
            return F.when(condition(t), changed).otherwise(t)

        return let(c, apply)

    return run


def _has(*parts: str) -> Callable[[Column], Column]:
    return lambda t: reduce(or_, [F.contains(t, F.lit(part)) for part in parts])


def _has_digit(t: Column) -> Column:
    return t.rlike(r"\d")


# The fixed order of removal, up to the last two steps. Two passes cannot match
# once the text is ASCII: degrees need the degree sign, emoji are above it. They
# are left out, but for the second URL pass that belongs to the emoji step.
_REMOVAL_ORDER = (
    remove_unicode,
    _only_where(_has("https://", "www."), remove_url),
    _only_where(_has("<"), remove_html),
    _only_where(_has("@"), remove_emails),
    _only_where(
        _has_digit,
        _only_where(_has(":"), remove_times),
        _only_where(lambda t: t.rlike(r"\d{3}[\s.-]?\d{4}"), remove_phone_number),
        remove_dates,
    ),
    _only_where(_has("https://", "www."), remove_url),
    _only_where(_has_digit, remove_prices, _only_where(_has("%"), remove_percentages)),
)


def _removed(c: Column) -> Column:
    return reduce(lambda text, step: step(text), _REMOVAL_ORDER, c)


def preprocess_text(c: Column) -> Column:
    """The whole cleaning chain, in its fixed order."""
    return remove_single_character_tokens(remove_special_characters(_removed(c)))


def split_tokens(c: Column) -> Column:
    """Cleaned text -> tokens."""
    return F.filter(F.split(c, r"\s+"), lambda t: t != "")


def drop_stop_words(tokens: Column, stop_words: tuple[str, ...] = fv.STOP_WORDS) -> Column:
    """Tokens that are not stop words in any case, and not blank or punctuation."""
    if stop_words:
        tokens = F.filter(tokens, lambda t: ~F.lower(t).isin(*stop_words))
    return F.filter(tokens, lambda t: t.rlike(r"\w"))


def lower_tokens(tokens: Column) -> Column:
    return F.transform(tokens, F.lower)


def analyze(c: Column, config: IndexConfig = IndexConfig()) -> Column:
    """Text -> array of tokens: clean, split, drop stop words, fold case.

    The last cleaning steps turn special characters into blanks and drop single
    characters. Splitting at what is no word character and keeping longer tokens
    gives the same tokens without two passes over the text.

    Lemmas need a table, so they are put in afterwards; see
    :func:`seekloom.operators.lemmas.lemmatize_terms`.
    """
    text = _removed(c)
    tokens = F.split(F.lower(text) if config.fold_case else text, r"\W+")
    if not config.stop_words:
        return F.filter(tokens, lambda t: F.length(t) > 1)
    if config.fold_case:
        return F.filter(tokens, lambda t: (F.length(t) > 1) & ~t.isin(*config.stop_words))
    return F.filter(tokens, lambda t: (F.length(t) > 1) & ~F.lower(t).isin(*config.stop_words))


def capped_tokens(text: Column, config: IndexConfig = IndexConfig()) -> Column:
    """Tokens of a document; null if its text or its token list is over a cap that is set.

    The text is analysed only where it is within the cap, and once.
    """
    tokens = analyze(text, config)
    if config.max_chars is not None:
        tokens = F.when(F.length(text) <= config.max_chars, tokens)
    if config.max_tokens is None:
        return tokens
    return let(tokens, lambda t: F.when(F.size(t) <= config.max_tokens, t))
