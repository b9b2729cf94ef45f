import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen".split()


def edge_rows():
    """Nulls in every column, empty, blank, very long, equal and repeated texts."""
    long_text = "\n".join(" ".join(WORDS[i % 16 :] + [f"w{i}"] + WORDS[: i % 16]) for i in range(2_500))
    base = " ".join(WORDS * 4)
    return [
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, " \t\n\x0b", "en", "a", 4),
        (4, "日本語 \U0001f600 naïve▁x", "fr", None, 10),
        (5, base, "en", "a", 1),
        (6, base, "en", "a", 1),
        (6, base, "en", "a", 1),
        (7, base + " ", "en", "a", 1),
        (8, base.upper(), "de", "b", 1),
        (9, long_text, "en", "a", 1),
        (10, long_text + " tail", "en", "a", 1),
        (None, base, "es", "c", 1),
        (None, None, None, None, None),
        (11, "a", "en", "a", 1),
        (12, "!!! 123 ?", "en", "a", 1),
        (13, "one  two\n\nthree \n four five's <|endoftext|> x\x00y\x1cz", "en", "a", 1),
        (14, "x" * 5_000, "en", "a", 1),
    ]


CLASHING = ["key", "file", "at", "digest", "entry", "rep", "component", "bucket", "range", "borrowed", "learned", "chunk", "group", "tie", "label", "rank", "order"]


@pytest.fixture(scope="session")
def edges(spark):
    """The edge rows with extra columns whose names the operators use inside."""
    frame = spark.createDataFrame(edge_rows(), SCHEMA)
    return frame.select("*", *(F.lit("extra").alias(n) for n in CLASHING))


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")
