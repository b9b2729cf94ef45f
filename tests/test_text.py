"""Cleaning and tokenizing on inline texts."""

import re
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from seekloom import fixed_values as fv
from seekloom.config import IndexConfig
from seekloom.functions import language as lg
from seekloom.functions import text as tx
from seekloom.functions.scripts import script_spelling


def apply(spark, function, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r["x"] for r in rows.select("i", function(F.col("t")).alias("x")).orderBy("i").collect()]


CLEANED = [
    ("see http://a.example/x now", "see http    example  now"),
    ("mail me: a.b@c.example.org ok", "mail me   ok"),
    ("Call +1 (555) 123-4567 now", "Call  now"),
    ("id 12345678 end", "id  end"),
    ("meet at 9:30 AM sharp", "meet at  sharp"),
    ("ends 23:59:59.999 PM", "ends  PM"),
    ("cost $19.99 (20% off)", "cost    off "),
    ("cost $1234.50 total", "cost  50 total"),
    ("paid 1,500 EUR cash", "paid  cash"),
    ("on 2021-05-03 it", "on 2021 05 03 it"),
    ("05/03/2021", ""),
    ("<b>Hello</b>world a < b > c", "Helloworld   "),
    ("snake_case v1.2", "snake_case v1 "),
    # A degree sign is spelled out, so the temperature pattern cannot match.
    ("It's 72°F outside", "It  72degF outside"),
    ("ww<b>w.x.example y", " "),
]


def test_cleaning_examples(spark):
    got = apply(spark, tx.preprocess_text, [t for t, _ in CLEANED])
    assert got == [e for _, e in CLEANED]


def test_tokens_of_sample_sentences(spark):
    samples = {
        "Zürich lies on a lake": ["zurich", "lies", "lake"],
        "Two mugs for $7.50 (15% less)": ["two", "mugs", "less"],
        "Write an e-letter to anna.b@mail.example.net": ["write", "letter"],
        "Its page was https://shop.example.org/a/b?c=d#e": ["page"],
        "The train left at 08:15:30.250 AM": ["train", "left"],
        "Er rief „komm nach Haus“": ["er", "rief", "komm", "nach", "haus"],
        "[[{(Bye)}]]": ["bye"],
        "\u200b\u200b+31": ["31"],
        "We ❤️ rivers": ["rivers"],
        "": [],
    }
    assert apply(spark, tx.analyze, list(samples)) == list(samples.values())


def test_short_way_to_tokens_equals_the_whole_chain(spark):
    texts = [t for t, _ in CLEANED] + ["a-b c_d é.ß 5x 7 99", "x", "Ünder _ __ a1", None]
    config = IndexConfig(stop_words=())
    short = apply(spark, lambda c: tx.analyze(c, config), texts)
    whole = apply(spark, lambda c: tx.lower_tokens(tx.split_tokens(tx.preprocess_text(c))), texts)
    assert short == whole


def test_case_is_kept_when_asked(spark):
    config = IndexConfig(fold_case=False)
    assert apply(spark, lambda c: tx.analyze(c, config), ["The Fox AND hen"]) == [["Fox", "hen"]]


def test_whitespace(spark):
    assert apply(spark, tx.clean_text, ["  a \n\t b  ", ""]) == ["a b", ""]


def test_single_steps(spark):
    assert apply(spark, tx.remove_degrees, ["20 °C 5°F 3°K 7°X"]) == ["   7°X"]
    assert apply(spark, tx.remove_emoji, ["hi 😀 www.x.y end"]) == ["hi   end"]
    assert apply(spark, tx.remove_html, ["a <b\n> c <i>d < e <f"]) == ["a <b\n> c d < e <f"]
    assert apply(spark, tx.remove_percentages, ["5% 55%% x7%"]) == [" % x"]
    assert apply(spark, tx.remove_emails, ["a@b.c_x@d.e, q@@r@s.t"]) == [", q@@"]


def test_emails_match_the_plain_pattern(spark):
    texts = ["a@b.c_x@d.e", "q@@r@s.t", "x.y+z@a-b.c.d end", "@a.b", "a@b", "a@b.", "a@b.c@d.e@f.g", "é@b.c"]
    assert apply(spark, tx.remove_emails, texts) == [re.sub(fv.EMAIL_PATTERN, "", t) for t in texts]


@pytest.mark.parametrize(
    "text, removed",
    [
        ("05/03/2021", True), ("2/29/2020", True), ("2/29/2021", False), ("2/29/00", False), ("2/29/2000", True),
        ("2/29/1900", False), ("12-31-99", True), ("04.31.2000", False), ("04.30.2000", True), ("1/2-2000", False),
        ("13/01/2000", False), ("on 05/03/2021", False), ("1/1/1599", False), ("1/1/1600", True),
    ],
)
def test_dates(spark, text, removed):
    pattern = tx.date_pattern().replace(r"\z", r"\Z")
    assert (re.sub(pattern, "", text) == "") == removed


def test_dates_in_spark(spark):
    assert apply(spark, tx.remove_dates, ["05/03/2021", "2/29/2021", "1.2.99\n"]) == ["", "2/29/2021", ""]


def test_spellings(spark):
    assert apply(spark, tx.remove_unicode, ["Straße Æon naïve Ø £5 10° “x” … 漢字 ﬁn"]) == [
        'Strasse AEon naive O PS5 10deg "x" ...  fin'
    ]
    for char, spelling in tx.ascii_spellings().items():
        assert spelling.isascii(), unicodedata.name(char, char)


def test_other_scripts(spark):
    expected = {
        "Αθήνα Θεσσαλονίκη ΨΥΧΗ ἀρχή ῥόδον": "Athena Thessalonike PsUKhE arkhe rodon",
        "Москва Щука ёлка объём Київ Ґ ў": "Moskva Shchuka iolka ob'iom Kiyiv G' u",
        "さくら シンジュク ちょっと ラーメン ヴ": "sakura shinziyuku chiyotsuto ramen vu",
        "한국어 서울 값 의": "hangugeo seoul gabs yi",
        "漢字 café ж🙂": " cafe zh",
        "\u0378\u0387\u3099": "",
    }
    assert apply(spark, tx.remove_unicode, [*expected, None, ""]) == [*expected.values(), None, ""]


def test_every_hangul_syllable_is_spelled_as_named(spark):
    syllables = [chr(code) for code in range(0xAC00, 0xD7A4)]
    names = [unicodedata.name(s).split(" ")[-1].lower() for s in syllables]
    assert apply(spark, tx.remove_unicode, [" ".join(syllables)]) == [" ".join(names)]


def test_stop_words_are_the_common_list(spark):
    common = [w for w in StopWordsRemover.loadDefaultStopWords("english") if "'" not in w]
    assert list(fv.STOP_WORDS) == common


def test_caps(spark):
    config = IndexConfig(max_chars=20, max_tokens=2)
    texts = ["red fox", "red fox hen", "r" * 21, "", None]
    assert apply(spark, lambda c: tx.capped_tokens(c, config), texts) == [["red", "fox"], None, None, [], None]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=60), min_size=1, max_size=20))
def test_cleaned_text_is_ascii(spark, texts):
    texts = [t.replace("\x00", "") for t in texts]
    assert all(t.isascii() for t in apply(spark, tx.preprocess_text, texts))


def python_chain(text):
    """The cleaning order with the plain patterns of the standard library."""
    spelled = "".join(c if c.isascii() else tx.ascii_spellings().get(c) or script_spelling(c) for c in text)
    for pattern in (
        fv.URL_PATTERN, fv.TAG_PATTERN, fv.EMAIL_PATTERN, fv.TIME_PATTERN, fv.PHONE_PATTERN,
        tx.date_pattern().replace(r"\z", r"\Z"), fv.URL_PATTERN, fv.PRICE_PATTERN, fv.PERCENT_PATTERN,
    ):
        spelled = re.sub(pattern, "", spelled, flags=re.ASCII)
    return re.sub(fv.SINGLE_PATTERN, "", re.sub(fv.SPECIAL_PATTERN, " ", spelled, flags=re.ASCII), flags=re.ASCII)


PIECES = st.sampled_from(
    "a B 7 12 555 1234 : . , - _ / @ < > $ % ( ) + & ' é ß € ° Ж θ き www. https:// am PM usd EUR 9:30 2/29/2020 x@y.z \n".split(" ")
    + [" ", " "]
)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(PIECES, max_size=14).map("".join), min_size=1, max_size=40))
def test_chain_equals_the_plain_patterns(spark, texts):
    assert apply(spark, tx.preprocess_text, texts) == [python_chain(t) for t in texts]


def test_detected_language(spark):
    texts = ["the cat and the dog", "der Hund und die Katze", "le chat et la souris", "el perro y los gatos", "xyz", ""]
    assert apply(spark, lg.detected_language, texts) == ["en", "de", "fr", "es", None, None]
