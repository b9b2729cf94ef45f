"""Language identification, quality, language-model scores and the URL filter."""

import collections
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from seekloom.llm import language_id, lm_scoring, quality, url_filter
from seekloom.llm.queries import ORACLES, QUERIES


def remainder(doc_id, divisor):
    return zlib.crc32(str(doc_id).encode()) % divisor if doc_id is not None else 0


# Language identification


def phrases(text, sample):
    """Cross-parsing by plain search, block by block."""
    count = 0
    for start in range(0, len(text), language_id.BLOCK_BYTES):
        block, at = text[start : start + language_id.BLOCK_BYTES], 0
        count += 1
        held = b""
        while at < len(block):
            grown = held + block[at : at + 1]
            if grown in sample:
                held = grown
            else:
                count += 1
                held = block[at : at + 1] if block[at : at + 1] in sample else b""
            at += 1
    return count


def test_phrases_equal_plain_search():
    draw = random.Random(5)
    text = lambda n, letters: "".join(draw.choice(letters) for _ in range(n)).encode()
    samples = {"x": text(400, "abc "), "y": text(300, "bcdé "), "z": b"a"}
    own = language_id.Parser(samples)
    texts = [text(draw.randrange(1, 1_500), "abcdé q") for _ in range(40)] + [b"a", b"q", b"qq"]
    expected = [[phrases(t, samples[n]) for n in own.languages] for t in texts]
    assert own.phrases(texts).tolist() == expected


def test_language_edges(spark, edges, nothing):
    samples = {"en": b"the one two three four", "fr": "naïve le la les".encode()}
    judged = language_id.identify(edges, samples)
    assert judged.columns == [*edges.columns, "lang_pred", "lang_score"]
    found = {r.doc_id: r for r in judged.collect() if r.doc_id is not None}
    assert [found[i].lang_pred for i in (1, 2, 3, 12)] == ["und"] * 4
    assert found[5].lang_pred == "en" and all(0 <= r.lang_score <= 1 for r in found.values())
    assert {r.lang_pred for r in language_id.identify(edges, {}).collect()} == {"und"}
    assert language_id.identify(nothing, samples).collect() == []
    assert language_id.learn_samples(nothing) == {}


def test_samples_are_bounded(edges):
    samples = language_id.learn_samples(edges)
    assert set(samples) == {"en", "fr", "de"}
    assert all(len(s) <= language_id.SAMPLE_BYTES for s in samples.values())


def test_held_out_languages(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op6_language_id"](spark, folder).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (remainder(r.doc_id, 5) == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)


# Quality


def test_scores_cover_the_whole_text():
    """Junk at the end of a very long text is seen, and slices do not change a score."""
    draw = random.Random(2)
    good = lambda n: " ".join(draw.choice(["river", "stone", "garden", "window", "morning", "paper"]) + draw.choice(["s", "", "ed"]) for _ in range(n))
    junk = lambda n: " ".join("$$%%##" for _ in range(n))
    texts = [good(200) for _ in range(150)] + [good(20) + junk(60) for _ in range(150)]
    model = quality.train(texts, [1] * 150 + [0] * 150)
    long_text = good(40_000)
    scores = quality.score_texts(model, [long_text, long_text + junk(60), good(100), None, "", good(50) + junk(80)])
    assert scores[0] != scores[1] and scores[2] > 0.5 > scores[5] and scores[3] == scores[4]
    assert np.allclose(quality.score_texts(model, [long_text])[0], scores[0])


def plain_probability(model, text):
    """The network with loops over positions, blocks and chunks."""
    n = max(1, -(-len(text) // quality.BLOCK))
    padded = text + b"\0" * (n * quality.BLOCK - len(text) + quality.WIDTH)
    blocks = []
    for b in range(n):
        at = range(b * quality.BLOCK, (b + 1) * quality.BLOCK)
        blocks.append(np.max([sum(model["filters"][k][padded[p + k]] for k in range(quality.WIDTH)) for p in at], axis=0))
    real = [min(1, max(0, (len(text) - b * quality.BLOCK) / quality.BLOCK)) for b in range(n)]
    best = None
    for b in range(n):
        c = min(b + 1, n - 1)
        inputs = np.append(np.maximum(np.maximum(blocks[b], blocks[c]), 0), (real[b] + real[c]) / 2)
        hidden = np.maximum(inputs @ model["dense"] + model["dense_bias"], 0)
        best = hidden if best is None else np.maximum(best, hidden)
    return 1 / (1 + math.exp(-float((best @ model["out"] + model["out_bias"])[0])))


def test_network_equals_loops():
    draw = random.Random(4)
    model = quality._new_model(np.random.default_rng(1))
    texts = [bytes(draw.randrange(1, 256) for _ in range(n)) for n in (0, 1, 3, 252, 253, 254, 256, 700, 1_500)]
    assert np.allclose(quality.probabilities(model, texts), [plain_probability(model, t) for t in texts], atol=1e-4)


def test_quality_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = QUERIES["op3_quality_classifier"](spark, folder).collect()
    assert all(r.held_out == (remainder(r.doc_id, 3) == 1) and 0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == int(r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.93 * len(held)


def test_quality_edges(edges, nothing):
    model = quality.learn(nothing, nothing.select("doc_id", F.lit(1).alias("label")))
    scored = edges.select("doc_id", quality.quality_score(F.col("text"), model).alias("score")).collect()
    assert len(scored) == edges.count() and all(0 <= r.score <= 1 for r in scored)


# Language-model scores


def tokens(text):
    return [re.sub(b"[A-Z]", lambda m: m[0].lower(), w) for w in (text or "").encode().split()] + [None]


def brute_scores(rows, divisor):
    learned = [tokens(t) for d, t in rows if remainder(d, divisor) != 0]
    counts = collections.Counter(t for doc in learned for t in doc)
    pairs = collections.Counter(p for doc in learned for p in zip([None, *doc], doc, strict=False))
    total, distinct = sum(counts.values()), len(counts)
    level = lambda c: int(math.log2(c)) + 1 if c > 0 else 0
    # Held-out events: every training token, deleted from the counts.
    events = collections.defaultdict(list)
    for (u, v), n in pairs.items():
        r = counts[u] - 1
        one = (n - 1) / r if r else 0.0
        two = counts[v] - 1
        cell = (round(-4 * math.log2(one)) if one else None, round(4 * math.log2(two)) if two else None)
        events[level(r)].append((2 ** (-cell[0] / 4) if one else 0.0, 2 ** (cell[1] / 4) / max(1, total - 1) if two else 0.0, 1 / (distinct + 1), n))

    def fit(own):
        w = np.full(3, 1 / 3)
        e = np.array(own)
        for _ in range(60):
            shares = e[:, :3] * w
            shares *= (e[:, 3] / shares.sum(axis=1))[:, None]
            w = shares.sum(axis=0) / shares.sum()
        w = np.maximum(w, 1e-9)
        return w / w.sum()

    every = fit([e for own in events.values() for e in own]) if events else np.array([0, 0, 1.0])
    weights = {k: fit(v) for k, v in events.items()}
    out = []
    for d, t in rows:
        doc, base, score = tokens(t), 0.0, 0.0
        for u, v in zip([None, *doc], doc, strict=False):
            w = weights.get(level(counts[u]), every)
            if not counts[u]:
                w = w * [0, 1, 1]
                w = w / w.sum()
            pair = pairs[u, v] / counts[u] if counts[u] else 0
            score += math.log10(w[0] * pair + w[1] * counts[v] / max(1, total) + w[2] / (distinct + 1))
            base += math.log10((counts[v] + 0.1) / (total + 0.1 * (distinct + 1)))
        out.append((d, remainder(d, divisor) == 0, len(doc), sum(counts[v] > 0 for v in doc), total, round(base, 5), round(score, 5)))
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk_bytes", [5_000, 10**7])
def test_lm_scores_equal_brute_force(edges, documents, chunk_bytes):
    frame = edges.select("doc_id", "text", "learned", "chunk", "bucket").unionByName(documents.select("doc_id", "text"), allowMissingColumns=True)
    condition = lambda: F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10, F.lit(0)) != 0
    found = lm_scoring.score_documents(frame, condition, chunk_bytes).collect()
    rows = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5), round(r.score, 5)) for r in found), key=str)
    expected = brute_scores([(r.doc_id, r.text) for r in frame.collect()], 10)
    assert [r[:5] for r in rows] == [r[:5] for r in expected]
    assert np.allclose([r[5:] for r in rows], [r[5:] for r in expected], rtol=1e-6)
    held = [r for r in rows if r[1]]
    assert sum(r[6] for r in held) > sum(r[5] for r in held)


def test_lm_chances_sum_to_one():
    """Over all tokens and the unknown one, in a context that was met."""
    weights = lm_scoring.learn_weights(np.array([(3 << 16) + (4 << 8) + 8, 255 << 8 | 255]), np.array([5.0, 2.0]), 40, 6)
    assert np.allclose(weights.sum(axis=1), 1) and (weights >= 0).all() and weights[0, 0] == 0


def test_lm_counts_take_four_bytes_unless_they_are_huge():
    small, huge = np.array([0, 7, 2**32 - 1], np.uint64), np.array([1, 2**32, 2**40 + 3], np.uint64)
    assert len(lm_scoring._planes(small)) == 12 and len(lm_scoring._planes(huge)) == 24
    for counts in (small, huge, small[:0]):
        assert lm_scoring._counts(lm_scoring._planes(counts), len(counts)).tolist() == counts.tolist()


def test_lm_without_training(edges, nothing):
    found = lm_scoring.score_documents(edges, lambda: F.lit(False)).collect()
    assert len(found) == edges.count() and all(abs(r.score) < 1e-9 and r.base_score == 0 and r.train_tokens == 0 for r in found)
    assert lm_scoring.score_documents(nothing, lambda: F.lit(True)).collect() == []


# URLs


URLS = [
    None, "", "no scheme", "http://", "HTTP://Sub.Example.NET/en/1?x#y", "http://example.net/EN/", "http://example.net", "x://net/", "x://net", "http://a.example.com/de/",
    "http://a.example.com/de", "http://notexample.com/de/x", "http://www.q.org/fr/1.html", "http://q.org/en/1.html", "https://m.q.org/en/1/", "http://q.org/en/2", "http://q.org:80/fr/",
    "http://a?b/c", "http://a#b://c/", "a://b://c/d", "http://É.ORG/fr/", "http://" + ".".join("ab" for _ in range(300)) + ".net/x", "http://q.org/fr/" + "y" * 3_000, "http://q.org/en/2?again", "http://x.net\n/en/",
]


def test_url_filter_equals_sql(spark, folder, tmp_path):
    rows = [(i, u, "h") for i, u in enumerate(URLS)] + [(4, URLS[4], "h"), (None, URLS[4], None), (None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").unionByName(spark.read.parquet(f"{folder}/pages.parquet"))
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    found = QUERIES["op7_url_filter"](spark, str(tmp_path))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    relation = connection.execute(ORACLES["op7_url_filter"])
    assert [d[0] for d in relation.description] == found.columns
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, relation.fetchall()))


@pytest.mark.parametrize("blocks", [0, 10**9])
def test_bloom_filter_has_no_false_negatives(spark, blocks, monkeypatch):
    monkeypatch.setattr(url_filter, "MAX_BROADCAST_BLOCKS", blocks)
    keys = spark.range(3_000).select(F.concat(F.lit("k"), "id").alias("key"))
    bloom = url_filter.BloomFilter(keys)
    assert bloom.possible(keys).count() == 3_000
    others = spark.range(3_000, 33_000).select(F.concat(F.lit("k"), "id").alias("key"))
    assert bloom.possible(others).count() < 0.05 * 30_000


def test_url_filter_keeps_columns(spark):
    pages = spark.createDataFrame([(1, "http://a.net/", "p", "h"), (2, None, "p", "h")], "page_id long, url string, best string, key string")
    rules = spark.createDataFrame([("net", "/", "block")], "host string, path string, verdict string")
    nothing = spark.createDataFrame([], "canonical string")
    judged = url_filter.judge_urls(pages, rules, nothing)
    assert judged.columns == [*pages.columns, "host", "path", "rule", "verdict"]
    assert [(r.page_id, r.rule, r.verdict) for r in judged.orderBy("page_id").collect()] == [(1, "net/", "block"), (2, None, "allow")]
    empty = url_filter.judge_urls(pages.limit(0), rules.limit(0), nothing)
    assert empty.collect() == []
