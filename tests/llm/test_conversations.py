"""The trie of conversations against plain loops, and its query against SQL."""

import collections
import hashlib
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from seekloom.llm import prefix_trie
from seekloom.llm.queries import ORACLES, QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def in_order(rows):
    own = collections.defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv_id].append(((turn is not None, turn or 0, digest), (role, text)))
    return {c: [t for _, t in sorted(turns)] for c, turns in own.items()}


def rebuilt(rows):
    own, out = in_order(rows), {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + own[c][h:]
    return out


def expected(conversations):
    members = collections.defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for path, own in members.items():
        words = len(re.findall("[^\x20\x09-\x0d]+", path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += children[path] == 0
            saved[path[:d]] += (len(own) - 1) * words
    out = []
    for path, own in members.items():
        ends = sorted(c for c in own if len(conversations[c]) == len(path))
        digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        parent = min(members[path[:-1]]) if path else None
        out.append((min(own), len(path), parent, len(own), children[path], leaves[path], saved[path], digest))
    return sorted(out, key=str)


def found(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def trie_of(frame, **more):
    turns = prefix_trie.turns_in_order(frame)
    return prefix_trie.prefix_trie(turns, prefix_trie.lengths(turns), **more)


def made(seed, n=60, deep=9):
    """Conversations that leave each other at random places, some equal, one long."""
    draw = random.Random(seed)
    rows, kept = [], [[("user", "hello there")]]
    for c in range(n):
        turns = list(draw.choice(kept))[: draw.randrange(0, deep)]
        while len(turns) < 1 or draw.random() < 0.6:
            turns.append((draw.choice(["user", "assistant"]), draw.choice(["a b", "c", "", "d e f"])))
        kept.append(turns)
        number = draw.choice([c, c, -c, c + 400])
        rows += [(number, i, *t) for i, t in enumerate(turns)]
    rows += [(77_000, i, "user", f"w {i % 3}") for i in range(70)] + [(77_020, i, "user", f"w {i % 3}") for i in range(66)]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize(("block", "run"), [(1, 1024), (3, 2), (4, 1024), (100, 1)])
def test_trie_equals_plain_loops(spark, monkeypatch, block, run):
    monkeypatch.setattr(prefix_trie, "RUN_BLOCKS", run)
    rows = made(block)
    assert found(trie_of(spark.createDataFrame(rows, SCHEMA), block=block)) == expected(in_order(rows))


EDGES = [
    (0, 0, "user", "one two"), (0, 1, "assistant", "three"), (0, 2, "user", "four"),
    (1, 1, "user", "x"), (1, None, "user", "before"), (1, 1, "user", "x"), (1, 1, "user", "a"),
    (2, 0, None, None), (2, 5, "", ""), (None, 0, "user", "lost"), (None, None, None, None),
    (5, 0, "user", "five"), (25, 0, "user", "without a base"), (-3, 0, "u", " \t\n"), (-23, 2, "u", "q" * 200_000),
    (40, 0, "a", "b:c"), (41, 0, "ab", ":c"), (60, 0, "user", "日本 é"), (61, 3, "user", "日本 é"),
]


def test_edges(spark, monkeypatch, tmp_path):
    frame = spark.createDataFrame(EDGES, SCHEMA).select("*", *(F.lit("extra").alias(n) for n in ("at", "key", "digest", "block", "words", "position")))
    assert found(trie_of(frame)) == expected(in_order(EDGES))
    frame.write.parquet(f"{tmp_path}/conversations.parquet")
    assert found(QUERIES["op12_prefix_trie"](spark, str(tmp_path))) == expected(rebuilt(EDGES))


def test_conversations_without_turns_and_empty_table(spark, tmp_path):
    # Head 3 of an absent base leaves conversation 21 without turns.
    number = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(number, 0, "user", "gone"), (number, 1, "user", "gone too")]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/one/conversations.parquet")
    assert found(QUERIES["op12_prefix_trie"](spark, f"{tmp_path}/one")) == expected({number: []})
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/none/conversations.parquet")
    assert found(QUERIES["op12_prefix_trie"](spark, f"{tmp_path}/none")) == []


def test_digests_over_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "_JOINED_BYTES", 100)
    rows = [("k", i) for i in range(-500, 1_500)] + [("l", 5)]
    digests = {r.key: r.ends_sha256 for r in prefix_trie.joined_digests(spark.createDataFrame(rows, "key string, conv_id long")).collect()}
    text = ",".join(map(str, range(-500, 1_500)))
    assert digests == {"k": hashlib.sha256(text.encode()).hexdigest(), "l": hashlib.sha256(b"5").hexdigest()}


def test_query_equals_sql_and_loops(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    frame = QUERIES["op12_prefix_trie"](spark, folder)
    own = found(frame)
    assert own == expected(rebuilt(rows))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet'")
    relation = connection.execute(ORACLES["op12_prefix_trie"])
    order = [[d[0] for d in relation.description].index(c) for c in frame.columns]
    assert sorted((tuple(r[i] for i in order) for r in relation.fetchall()), key=str) == own
