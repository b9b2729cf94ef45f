"""Key sentences against a walk over a written-out matrix."""

import re

import numpy as np
from pyspark.sql import functions as F

from seekloom import fixed_values as fv
from seekloom.operators import present as pr
from seekloom.operators import sentence_ranks as sr

STORY = (
    "The harbour town sells fresh fish. Fish from the harbour feeds the town! Nobody knows why.\n"
    "Boats leave the harbour at dawn? The market sells bread. Bread and fish sell well at the market"
)


def expected(text):
    """Sentences and ranks, from a matrix of all pairs of sentences."""
    sentences = [s.strip(" ") for s in re.split(sr.SENTENCE_END, text or "") if s.strip(" ")]
    words = [
        {w for w in re.split(r"[\W_]+", s.lower()) if len(w) > 1 and w not in fv.STOP_WORDS} for s in sentences
    ]
    n = len(sentences)
    weight = np.zeros((n, n))
    for i in range(n):
        for j in range(n):
            if i != j and words[i] and words[j]:
                weight[i, j] = len(words[i] & words[j]) / np.sqrt(len(words[i]) * len(words[j]))
    strength = weight.sum(axis=0)
    rank = np.ones(n)
    for _ in range(sr.STEPS):
        moved = np.divide(rank, strength, out=np.zeros(n), where=strength > 0)
        rank = 1 - sr.DAMPING + sr.DAMPING * weight @ moved
    return sentences, rank


def ranked(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").select(
        "doc_id", sr.split_sentences(F.col("text")).alias("sentences")
    )
    found = rows.withColumn("ranks", sr.sentence_ranks(F.col("sentences"))).orderBy("doc_id").collect()
    return [(r["sentences"], r["ranks"]) for r in found]


def test_ranks_equal_a_matrix_of_all_pairs(spark, folder):
    given = [r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").select("text").limit(40).collect()]
    texts = [STORY, None, "", " \n ", "...", "One sentence", "Alpha beta. Gamma delta.", STORY, "Same words. Same words. Same words.", *given]
    for text, (sentences, ranks) in zip(texts, ranked(spark, texts), strict=True):
        want, scores = expected(text)
        assert sentences == want
        assert np.allclose(ranks, scores, atol=1e-9)


def test_a_text_has_the_same_ranks_in_any_company(spark):
    alone = ranked(spark, [STORY])[0]
    for sentences, ranks in ranked(spark, [STORY, "Fish and harbour.", STORY + " Fish.", STORY])[::3]:
        assert sentences == alone[0] and np.allclose(ranks, alone[1], atol=1e-12)


def test_many_sentences_cost_no_pairs(spark):
    text = ". ".join(f"word{i} common{i % 7}" for i in range(60_000))
    sentences, ranks = ranked(spark, [text])[0]
    assert len(sentences) == len(ranks) == 60_000
    assert abs(sum(ranks) - 60_000) < 1


def test_summary_keeps_the_order_of_the_text_and_ties_by_place(spark):
    texts = spark.createDataFrame([(1, STORY), (2, "Same words here. Same words here. Same words here."), (3, None)], "doc_id int, text string")
    got = {r["doc_id"]: r["s"] for r in texts.select("doc_id", sr.key_sentences(2)(F.col("text")).alias("s")).collect()}
    sentences, scores = expected(STORY)
    best = sorted(sorted(range(len(scores)), key=lambda i: (-round(scores[i], 6), i))[:2])
    assert got[1] == " ".join(f"{sentences[i]}." for i in best)
    assert got[2] == "Same words here. Same words here." and got[3] == ""


def test_key_sentences_as_summariser(spark):
    texts = spark.createDataFrame([(1, STORY), (2, "short")], "doc_id int, text string")
    got = {r["doc_id"]: r["summary"] for r in pr.summarize_texts(texts, sr.key_sentences(1), max_words=50).collect()}
    sentences, scores = expected(STORY)
    assert got[1] == f"{sentences[int(np.argmax(np.round(scores, 6)))]}."
    assert got[2] == fv.SHORT_TEXT_MESSAGE
