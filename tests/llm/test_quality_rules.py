"""Statistics of documents against plain loops, and the boosted trees."""

import collections
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from seekloom.llm import quality_rules, samples
from seekloom.llm.queries import QUERIES

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = collections.Counter(zip(words, words[1:], words[2:], strict=False))
    repeated = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated))


EXTRA = ["a a a a a", "x y z x y z", "a b c d a b", "# * $ % & | < >", "l\nl\n l\nl \n\n\nl", "é日\U0001f600 ß", "w " * 3_000, "q" * 70_000, "\x1c \x85 \xa0", "a b\nc a b\nc"]


@pytest.mark.parametrize("piece", [16, 1024 * 1024])
def test_counts_equal_plain_loops(spark, edges, documents, monkeypatch, piece):
    monkeypatch.setattr(quality_rules, "PIECE_BYTES", piece)
    texts = [r.text or "" for r in edges.collect()] + EXTRA + [r.text for r in documents.collect()]
    found = quality_rules.statistics([t.encode() for t in texts])
    rows = list(zip(*(found[n].tolist() for n in quality_rules.COUNTS), strict=True))
    assert rows == [plain_counts(t) for t in texts]


def test_counts_of_nothing():
    assert all(len(v) == 0 for v in quality_rules.statistics([]).values())
    assert quality_rules.features(quality_rules.statistics([b"", b" "])).tolist() == [[0.0] * len(quality_rules.FEATURES)] * 2


def noisy(n=600, seed=3):
    draw = np.random.default_rng(seed)
    rows = draw.random((n, len(quality_rules.FEATURES)))
    falling = quality_rules.FEATURES.index("symbols_per_word")
    chance = 1 / (1 + np.exp(6 * rows[:, falling] - 3 * (rows[:, 0] > 0.5) - 1.5))
    return rows, (draw.random(n) < chance).astype(int)


def test_scores_never_rise_with_falling_features():
    rows, labels = noisy()
    trees = quality_rules.train(rows, labels)
    base = quality_rules.probabilities(trees, rows)
    assert ((base >= 0.5) == labels).mean() > 0.75 and base.std() > 0.1
    for name in quality_rules.FALLING:
        f, before = quality_rules.FEATURES.index(name), np.full(len(rows), np.inf)
        for value in np.linspace(0, 1, 60):
            moved = rows.copy()
            moved[:, f] = value
            after = quality_rules.probabilities(trees, moved)
            assert (after <= before + 1e-12).all()
            before = after


def test_flat_nodes_equal_a_walk():
    rows, labels = noisy(200, 4)
    trees = quality_rules.train(rows, labels, trees=10)
    for row, score in zip(rows, quality_rules.probabilities(trees, rows), strict=True):
        total = float(trees["bias"])
        for at in trees["roots"].tolist():
            while trees["left"][at] != at:
                at = trees["left"][at] if row[trees["feature"][at]] <= trees["bound"][at] else trees["right"][at]
            total += trees["value"][at]
        assert abs(score - 1 / (1 + np.exp(-total))) < 1e-12


def test_without_labels(spark, edges, nothing):
    trees = quality_rules.learn(edges, spark.createDataFrame([], "doc_id long, label int"))
    rows = quality_rules.judge(edges, trees).collect()
    assert {r.score for r in rows} == {0.5} and len(rows) == edges.count()
    kept = {r.doc_id for r in rows if r.kept}
    assert kept == {5, 6, 7, 8, 9, 10, None} - {r.doc_id for r in rows if r.base_failed}
    assert quality_rules.judge(nothing, trees).collect() == []
    one_label = quality_rules.learn(edges, spark.createDataFrame([(5, 1), (6, 1), (6, 0), (None, 1), (7, 9), (99, 0)], "doc_id long, label int"))
    assert quality_rules.judge(edges, one_label).count() == edges.count()


def test_sample_is_bounded_and_the_same_each_time(spark):
    frame = spark.range(5_000).select(F.col("id").alias("doc_id"), (F.col("id") % 10 == 0).cast("int").alias("label")).repartition(7)
    rows = [sorted((r.label, r.doc_id) for r in samples.least_hashed(f, "label", "doc_id", 40).collect()) for f in (frame, frame.repartition(3))]
    assert rows[0] == rows[1] and collections.Counter(label for label, _ in rows[0]) == {0: 40, 1: 40}
    assert samples.least_hashed(frame.limit(0), "label", "doc_id", 40).collect() == []


def test_query_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in QUERIES["op13_quality_rules"](spark, folder).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert rows.keys() == texts.keys()
    for doc_id, r in rows.items():
        counts = plain_counts(texts[doc_id])
        assert tuple(r[n] for n in quality_rules.COUNTS) == counts
        assert r.base_failed == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0]) and not (r.kept and r.base_failed)
    marks = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = [(rows[d].score >= 0.5, q) for d, q in marks.items() if d in rows and zlib.crc32(str(d).encode()) % 3 == 1]
    bad, good = ([s for s, q in held if q == v] for v in (0, 1))
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.2
