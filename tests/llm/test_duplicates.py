"""Exact and near duplicates against brute force, and fingerprints."""

import collections
import contextlib
import hashlib
import random
import re
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from seekloom.llm import exact_dedup, fingerprints, near_dedup
from seekloom.llm.hashing import KEPT_POWERS, mix, range_hashes, word_hashes
from seekloom.llm.queries import half_replaced
from seekloom.session import BATCH_BYTES, BATCH_KEY, cut_lineage


def plain(text):
    return re.sub("[\x20\x09-\x0d]", "", text or "")


def expected_exact(rows):
    groups = collections.defaultdict(list)
    for doc_id, text in rows:
        groups[plain(text)].append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    out = []
    for doc_id, text in rows:
        own = groups[plain(text)]
        out.append((doc_id, min(own)[3], len(own), hashlib.sha256(plain(text).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("digest", ["sha256", "weak"])
def test_exact_dedup_equals_brute_force(spark, edges, documents, digest):
    """A digest of one byte makes texts collide; their bytes tell them apart."""
    frame = edges.select("doc_id", "text", "key", "at").unionByName(
        documents.select("doc_id", "text", F.lit("x").alias("key"), F.lit("y").alias("at"))
    )
    weak = lambda text: F.substring(exact_dedup.sha256(text), 1, 1)
    found = exact_dedup.deduplicate(frame, exact_dedup.sha256 if digest == "sha256" else weak, files_per_batch=1)
    rows = found.collect()
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows), key=str)
    assert got == expected_exact([(r.doc_id, r.text) for r in frame.collect()])
    # One row of each group is kept.
    assert collections.Counter(r.text_sha256 for r in rows if r.kept).most_common(1)[0][1] == 1
    assert sum(r.kept for r in rows) == len({r.text_sha256 for r in rows})


def test_state_lasts_over_restarts(spark, tmp_path):
    """A later stream on the same state knows the digests of an earlier one."""
    source, entries, state = (str(tmp_path / n) for n in ("in", "entries", "state"))

    def arrive(rows):
        frame = spark.createDataFrame(rows, "doc_id long, text string")
        exact_dedup.facts(exact_dedup.located(frame)).coalesce(1).write.mode("append").parquet(source)
        reader = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
        exact_dedup.start_dedup(reader, entries, state).awaitTermination()
        return {r.entry.doc_id: r.hits for r in exact_dedup.entries(spark, entries).collect()}

    assert arrive([(5, "a b"), (6, "c")]) == {5: 1, 6: 1}
    assert arrive([(3, "a b"), (7, "a  b")]) == {7: 3, 6: 1}


def test_exact_dedup_of_nothing(nothing):
    assert exact_dedup.deduplicate(nothing).collect() == []
    assert exact_dedup.drop_duplicates(nothing).columns == nothing.columns


def test_drop_exact_duplicates_keeps_columns(edges):
    kept = exact_dedup.drop_duplicates(edges)
    assert kept.columns == edges.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(map(str, [3, 4, 7, 8, 9, 10, 11, 12, 13, 14]))


def shingles(text, words):
    tokens = [w.lower() for w in (text or "").encode().split()]
    if len(tokens) < words:
        return frozenset([tuple(tokens)] if tokens else [])
    return frozenset(tuple(tokens[i : i + words]) for i in range(len(tokens) - words + 1))


def expected_near(rows, words, percent=80):
    sets = [(d, shingles(t, words)) for d, t in rows if d is not None]
    parent = {d: d for d, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {d: root(d) for d, _ in sets}


def variants(seed, groups=12, size=25, length=120):
    """Groups of near copies with random replacements, some just above and some below 0.8."""
    draw = random.Random(seed)
    rows, number = [], 1000
    for _ in range(groups):
        base = [f"v{draw.randrange(5_000)}" for _ in range(length)]
        for _ in range(size):
            text = list(base)
            for _ in range(draw.randrange(0, 5)):
                text[draw.randrange(length)] = f"z{draw.randrange(100_000)}"
            rows.append((number, " ".join(text)))
            number += 1
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize(("words", "large"), [(4, 32), (5, 2)])
def test_near_duplicates_equal_brute_force(spark, edges, documents, words, large, monkeypatch):
    """With few members a large bucket has, the join on rare differences decides nearly all pairs."""
    monkeypatch.setattr(near_dedup, "LARGE", large)
    monkeypatch.setattr(near_dedup, "ELEMENTS_PER_TASK", 5_000)
    made = spark.createDataFrame(variants(words), "doc_id long, text string")
    offset = documents.select((F.col("doc_id") + 10_000).alias("doc_id"), "text")
    frame = edges.select("doc_id", "text", "rep", "component", "bucket").unionByName(made.unionByName(offset), allowMissingColumns=True)
    rows = frame.select("doc_id", "text").collect()
    expected = expected_near([(r.doc_id, r.text) for r in rows], words)
    found = near_dedup.near_duplicates(frame, words=words).collect()
    assert len(found) == len(rows)
    assert {r.doc_id: r.component_id for r in found if r.doc_id is not None} == expected
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in found)
    sizes = collections.Counter((r.doc_id, len(shingles(r.text, words))) for r in rows)
    assert collections.Counter((r.doc_id, r.n_shingles) for r in found) == sizes


def edited_copies(seed, size, length=110):
    """One base text and copies with so many edits that most are just below the similarity to it."""
    draw = random.Random(seed)
    base = [f"v{draw.randrange(900)}" for _ in range(length)]
    texts = [list(base)]
    for _ in range(size - 1):
        text = list(draw.choice(texts) if draw.random() < 0.3 else base)
        for _ in range(draw.randrange(0, 8)):
            at = draw.randrange(len(text))
            text[at : at + draw.choice([0, 1, 1, 6])] = [f"z{draw.randrange(300)}"] * draw.choice([0, 1, 1])
        texts.append(text)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


def test_large_groups_of_edited_copies(spark, monkeypatch):
    rows = edited_copies(6, 420)
    expected = expected_near(rows, 4)
    assert 2 < len(set(expected.values())) < 400
    pairs = []
    real = near_dedup._possible_pairs
    monkeypatch.setattr(near_dedup, "_possible_pairs", lambda *a: pairs.append(real(*a)) or pairs[-1])
    monkeypatch.setattr(near_dedup, "scratch", lambda spark: contextlib.nullcontext())
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=4).collect()
    assert {r.doc_id: r.component_id for r in found} == expected
    assert pairs[0].count() < len(rows) ** 2 / 40


def test_estimate_is_close_to_the_similarity(spark):
    draw = random.Random(3)
    words = [f"w{i}" for i in range(2_000)]
    texts = [" ".join(words)] + [" ".join(w if draw.random() > p else "q" + w for w in words) for p in (0.0, 0.01, 0.05, 0.2)]
    sets = near_dedup.shingle_sets(texts, 4)
    packed, _ = near_dedup.signatures(sets)
    rows = [(packed[0].tolist(), p.tolist(), len(set(s) & set(sets[0])) / len(set(s) | set(sets[0]))) for s, p in zip(sets, packed, strict=True)]
    frame = spark.createDataFrame(rows, "a array<long>, b array<long>, truth double")
    for r in frame.select("truth", near_dedup.estimate(F.col("a"), F.col("b")).alias("guess")).collect():
        assert abs(r.truth - r.guess) < 0.15


def test_near_duplicates_of_nothing(nothing):
    assert near_dedup.near_duplicates(nothing).collect() == []


def test_drop_near_duplicates_keeps_columns(edges):
    kept = near_dedup.drop_near_duplicates(edges)
    assert kept.columns == edges.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(map(str, [1, 2, 3, 4, 5, 9, 11, 12, 13, 14, None, None]))


def test_near_duplicates_get_small_batches(spark, monkeypatch):
    """Long texts do not reach a worker in batches of Spark's 64 MB."""
    cut = near_dedup.slices

    def checked(batches, column, max_bytes):
        for batch in batches:
            assert batch.nbytes < 3 * BATCH_BYTES or batch.num_rows == 1
            yield from cut(iter([batch]), column, max_bytes)

    monkeypatch.setattr(near_dedup, "slices", checked)
    before = spark.conf.get(BATCH_KEY)
    words = F.transform(F.sequence(F.lit(1), F.lit(20_000)), lambda i: F.concat(F.lit("w"), i * (F.col("id") % 6 + 1)))
    docs = spark.range(24, numPartitions=1).select(F.col("id").alias("doc_id"), F.array_join(words, " ").alias("text"))
    rows = near_dedup.near_duplicates(cut_lineage(docs.withColumn("text", F.repeat(F.concat("text", F.lit(" ")), 4)).coalesce(1))).collect()
    assert {r.doc_id: r.component_id for r in rows} == {i: i % 6 for i in range(24)}
    assert spark.conf.get(BATCH_KEY) == before


def test_powers_of_few_sizes_are_kept():
    """A worker keeps one table of bounded size; hashes do not depend on it."""
    texts = [b"some words " * n for n in (9, 2**17, 2**19, 9)]
    tracemalloc.start()
    found = [word_hashes([t])[0] for t in texts]
    first = [f[:2].tolist() for f in found]
    del found
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert first[1:] == first[:-1]
    assert held < 2 * 8 * KEPT_POWERS + 2**20


def test_components(spark):
    links = spark.createDataFrame([(5, 4), (4, 3), (3, 9), (20, 21), (22, 21), (7, 7)], "a long, b long")
    assert {r.node: r.component for r in near_dedup.components(links).collect()} == {3: 3, 4: 3, 5: 3, 9: 3, 20: 20, 21: 20, 22: 20}


def plain_fingerprint(text):
    """Paragraph by paragraph and byte by byte."""
    lanes, sketch = [0] * 8, [0] * fingerprints.SKETCH_LANES
    for paragraph in text.encode().split(b"\n"):
        digest = hashlib.blake2b(paragraph, digest_size=64).digest()
        lanes = [(a + int.from_bytes(digest[8 * i : 8 * i + 8], "little")) % 2**64 for i, a in enumerate(lanes)]
        segments, begin = [], 0
        for i, c in enumerate(paragraph):
            back = sum(paragraph[i - k] * f for k, f in ((1, 0x9E3779B1), (2, 0x85EBCA77), (3, 0xC2B2AE3D)) if i >= k) % 2**32
            if c == 32 and (back >> 13) % 8 == 0:
                segments.append(paragraph[begin:i])
                begin = i + 1
        for segment in [*segments, paragraph[begin:]]:
            data = np.frombuffer(segment, np.uint8)
            key = range_hashes(data, np.array([0]), np.array([len(data)]))
            bits = np.unpackbits(mix(key[:, None] ^ mix(np.arange(4, dtype=np.uint64))[None, :]).view(np.uint8))
            sketch = [a + (1 if b else -1) for a, b in zip(sketch, bits.tolist(), strict=True)]
    return b"".join(a.to_bytes(8, "little") for a in lanes) + b"".join((a % 2**32).to_bytes(4, "little") for a in sketch)


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_next_texts_and_edits(spark, edges, documents, ranges, monkeypatch):
    offset = documents.select((F.col("doc_id") + 10_000).alias("doc_id"), "text")
    frame = edges.select("doc_id", "text", "range", "borrowed").unionByName(offset, allowMissingColumns=True)
    dealt = fingerprints.with_next_text
    monkeypatch.setattr(fingerprints, "with_next_text", lambda d: dealt(d, ranges))
    rows = [(r.doc_id, r.text or "") for r in frame.collect()]
    rows.sort(key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    after = rows[1:] + rows[:1]
    expected = collections.Counter((d, len(t), hashlib.sha256(half_replaced(t, n).encode()).hexdigest()) for (d, t), (_, n) in zip(rows, after, strict=True))
    found = fingerprints.compare_with_next(frame, half_replaced).collect()
    assert collections.Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in found) == expected
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    own = collections.Counter((d, fingerprints.fingerprints([t.encode()])[0].hex()) for d, t in rows)
    assert collections.Counter((r.doc_id, r.fingerprint) for r in found) == own
    edited = {d: half_replaced(t, n) for (d, t), (_, n) in zip(rows, after, strict=True)}
    for r in found:
        if r.doc_id in (2, 5, 7, 13, 10_000, 10_007):
            assert r.fingerprint == plain_fingerprint(dict(rows)[r.doc_id]).hex()
            assert r.edited_fingerprint == plain_fingerprint(edited[r.doc_id]).hex()
    assert sum(r.near_edited for r in found) > 2 * sum(r.near_next for r in found)


def test_equal_texts_have_equal_fingerprints_in_any_company():
    draw = random.Random(8)
    texts = ["A dog ran to a log", " leading space a b c", "a b\na b\n a b", "I\nI am\na I b c d e f g h i j", "", " ", "\n", "x y " * 40]
    alone = {t: fingerprints.fingerprints([t.encode()])[0] for t in texts}
    assert len(set(alone.values())) == len(texts)
    assert all(alone[t] == plain_fingerprint(t) for t in texts)
    for _ in range(50):
        mixed = [draw.choice(texts) for _ in range(12)]
        assert fingerprints.fingerprints([t.encode() for t in mixed]) == [alone[t] for t in mixed]


def test_paragraphs_count_in_any_order_and_number():
    draw = random.Random(9)
    paragraphs = ["A b", " a c d", "b", "", "I a I a I a I a I a", "x " * 30, "é à"]
    for _ in range(40):
        chosen = [draw.choice(paragraphs) for _ in range(draw.randrange(1, 9))]
        whole = fingerprints.fingerprints(["\n".join(chosen).encode()])[0]
        added = None
        for p in draw.sample(chosen, len(chosen)):
            own = fingerprints.fingerprints([p.encode()])[0]
            added = fingerprints.combine(added, own) if added else own
        assert added == whole
        less = fingerprints.combine(whole, fingerprints.fingerprints([chosen[0].encode()])[0], -1)
        if len(chosen) > 1:
            assert less == fingerprints.fingerprints(["\n".join(chosen[1:]).encode()])[0]
    many = fingerprints.fingerprints([b"\n".join([b"same"] * 70_000), b"\n".join([b"same"] * 69_999), b"other"])
    assert fingerprints.likeness(many[:1], many[1:2])[0] > 0.99 > 0.1 > fingerprints.likeness(many[:1], many[2:])[0]


def test_fingerprints_are_homomorphic():
    a, b = "one two\nthree\n\nfour five six", "seven\neight nine"
    own = fingerprints.fingerprints([t.encode() for t in (a, b, a + "\n" + b, b + "\n" + a, "\n".join(reversed(a.split("\n"))), "", a + "\n")])
    assert fingerprints.combine(own[0], own[1]) == own[2] == own[3]
    assert fingerprints.combine(own[2], own[1], -1) == own[0] == own[4]
    assert len({own[0], own[1], own[2], own[5], own[6]}) == 5
    assert fingerprints.combine(own[0], own[5]) == own[6]
    assert fingerprints.likeness([own[0], own[0]], [own[0], own[1]])[0] == 1.0


def test_fingerprints_of_nothing(nothing):
    assert fingerprints.compare_with_next(nothing, half_replaced).collect() == []


def test_one_document_follows_itself(spark):
    row = fingerprints.compare_with_next(spark.createDataFrame([(1, "abcd")], "doc_id long, text string"), half_replaced).first()
    assert row.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and row.near_next == 1.0
