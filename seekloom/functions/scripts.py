"""ASCII spellings of Greek, Cyrillic, kana and Hangul as a native column expression.

Letters of an alphabet and kana are looked up by their code point, Hangul syllables are
taken apart by arithmetic. Each character is spelled by itself. Characters of these blocks
without a spelling vanish; other characters, those of other scripts among them, stay.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from seekloom import fixed_values as fv
from seekloom.functions.binding import let

# First and last characters: Greek and Cyrillic, polytonic Greek, kana.
_LISTED_BLOCKS = ((0x370, 0x4FF), (0x1F00, 0x1FFF), (0x3041, 0x30FF))
_HANGUL = (0xAC00, 0xD7A3)

#: Characters that ``spell_scripts`` replaces.
SCRIPTS = "[" + "".join(f"{chr(first)}-{chr(last)}" for first, last in (*_LISTED_BLOCKS, _HANGUL)) + "]"


_SMALL = {**fv.GREEK_SPELLINGS, **fv.CYRILLIC_SPELLINGS}
_LETTERS = {**{c.upper(): s.capitalize() for c, s in _SMALL.items()}, **_SMALL}


def _of_alphabet(char: str) -> str | None:
    return _LETTERS.get(char) or _LETTERS.get(unicodedata.normalize("NFD", char)[0])


def _of_kana(char: str) -> str | None:
    words = unicodedata.name(char, "").split(" ")
    if words[0] not in ("HIRAGANA", "KATAKANA") or words[1] != "LETTER":
        return None
    syllable = words[-1].lower()
    return fv.KANA_SPELLINGS.get(syllable, syllable)


def script_spelling(char: str) -> str:
    """The spelling of a character of the listed blocks, or nothing."""
    return _of_alphabet(char) or _of_kana(char) or ""


def _listed(values: tuple[str, ...], place: Column) -> Column:
    """One of the values. They are one literal, which is split when the query is planned."""
    return F.get(F.split(F.lit(",".join(values)), ","), place)


def _hangul(code: Column) -> Column:
    """The short names of a syllable's letters, which follow each other in a fixed order."""
    vowels, tails = len(fv.HANGUL_VOWELS), len(fv.HANGUL_TAILS)
    place = code - _HANGUL[0]
    syllable = (place / tails).cast("int")
    return F.concat(
        _listed(fv.HANGUL_LEADS, (syllable / vowels).cast("int")),
        _listed(fv.HANGUL_VOWELS, syllable % vowels),
        _listed(fv.HANGUL_TAILS, place % tails),
    )


def _spelled(char: Column) -> Column:
    code = F.ascii(char)
    spelled = F.when(code < _LISTED_BLOCKS[0][0], char)
    for first, last in _LISTED_BLOCKS:
        values = tuple(script_spelling(chr(at)) for at in range(first, last + 1))
        spelled = spelled.when(code.between(first, last), _listed(values, code - first))
    return spelled.when(code.between(*_HANGUL), _hangul(code)).otherwise(char)


def spell_scripts(c: Column) -> Column:
    """Spell letters of these scripts in ASCII. Texts without one are not taken apart."""

    def spell(t: Column) -> Column:
        return F.when(t.rlike(SCRIPTS), F.array_join(F.transform(F.split(t, ""), _spelled), "")).otherwise(t)

    return let(c, spell)
