"""A trie of conversations that share their first turns, by hashes of fixed-length blocks.

Conversations are cut into blocks of a few turns. Every block has a digest of its turns, and
a prefix hash of the whole blocks before it, the xor of one value per place and digest.
Conversations are first grouped by prefix and block digest. Where all conversations of a
prefix go on with one block, its turns are nodes as they are; only blocks whose siblings
diverge are cut at turn boundaries and grouped again. Numbers over subtrees come from pointer
doubling: after ``r`` rounds a node holds the sums of all nodes less than ``2 ** r`` below it.

Turns of a conversation are in order of ``turn``, null first; equal numbers in order of the
turn's digest. Null role or text is empty. Rows without ``conv_id`` belong to no conversation
and are left out. Equal rows are separate turns. Other columns are ignored. An empty table has
no conversation and gives no node, not even the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seekloom.llm.batches import as_batch
from seekloom.operators.ordering import with_position
from seekloom.session import cut_lineage

#: Turns of a block.
BLOCK = 4
#: Blocks of a conversation whose prefix hashes one task sums.
RUN_BLOCKS = 1024
#: Bytes of ids that are joined before they are hashed in order.
_JOINED_BYTES = 64 * 1024
_WORD = r"[^\x20\x09-\x0D]+"


def _digest(value: Column) -> Column:
    """128 bits of SHA-256, as hexadecimal digits."""
    return F.substring(F.sha2(value, 256), 1, 32)


def _halves(digest: Column) -> list[Column]:
    """Two numbers of 60 bits from a digest."""
    return [F.conv(F.substring(digest, at, 15), 16, 10).cast("long") for at in (1, 17)]


def turns_in_order(conversations: DataFrame) -> DataFrame:
    """``(conv_id, at, digest, words)``: turns numbered from 0 in their conversation.

    Turns are range-sorted, so a conversation of any length is spread over tasks.
    """
    role, text = (F.coalesce(F.col(n).cast("string"), F.lit("")) for n in ("role", "text"))
    facts = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        _digest(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
        F.regexp_count(text, F.lit(_WORD)).cast("long").alias("words"),
    )
    placed = with_position(facts, F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest"))
    firsts = placed.groupBy("conv_id").agg(F.min("position").alias("first"))
    return cut_lineage(placed.join(firsts, "conv_id").select("conv_id", (F.col("position") - F.col("first")).alias("at"), "digest", "words"))


def lengths(turns: DataFrame) -> DataFrame:
    """``(conv_id, n_turns)`` of all conversations."""
    return turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns"))


def with_shared_heads(turns: DataFrame, base: Column, head: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are replaced by those of another one.

    ``base`` and ``head`` are expressions of ``conv_id``: the conversation that lends its first
    ``head`` turns, at most ``most``, and how many own turns they replace. Gives the turns and
    the lengths; a conversation may end up without a turn.
    """
    own = lengths(turns).withColumns({"base": base, "head": head})
    lent = own.select(F.col("conv_id").alias("base"), F.col("n_turns").alias("lent"))
    convs = cut_lineage(
        own.join(lent, "base", "left").select(
            "conv_id", "base", "head", F.least("head", F.coalesce("lent", F.lit(0))).cast("long").alias("taken"), "n_turns"
        )
    )
    rest = turns.join(convs, "conv_id").where(F.col("at") >= F.col("head"))
    rest = rest.select("conv_id", (F.col("at") - F.col("head") + F.col("taken")).alias("at"), "digest", "words")
    heads = turns.where(F.col("at") < most).withColumnRenamed("conv_id", "base")
    heads = heads.join(convs.select("conv_id", "base", "taken"), "base").where(F.col("at") < F.col("taken"))
    left = F.col("taken") + F.greatest(F.col("n_turns") - F.col("head"), F.lit(0))
    return heads.select("conv_id", "at", "digest", "words").unionByName(rest), convs.select("conv_id", left.alias("n_turns"))


def _blocks(turns: DataFrame, convs: DataFrame, block: int) -> DataFrame:
    """One row per conversation and block, with its turns and the hash ``p0, p1`` of the blocks before."""
    number = F.expr(f"at div {block}").alias("block")
    cut = turns.groupBy("conv_id", number).agg(F.sort_array(F.collect_list(F.struct("at", "digest", "words"))).alias("turns"))
    digest = _digest(F.array_join("turns.digest", ""))
    valued = cut.withColumn("digest", digest).withColumn("own", _digest(F.concat_ws(":", "block", "digest")))
    valued = valued.withColumns({f"v{i}": v for i, v in enumerate(_halves(F.col("own")))})
    valued = valued.withColumn("run", F.expr(f"block div {RUN_BLOCKS}")).drop("own")
    # A long conversation's hashes are summed in runs, and then over runs.
    earlier = Window.partitionBy("conv_id", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = valued.withColumns({f"p{i}": F.coalesce(F.bit_xor(f"v{i}").over(earlier), F.lit(0)) for i in (0, 1)})
    many = convs.where(F.col("n_turns") > block * RUN_BLOCKS).select("conv_id")
    runs = valued.join(many, "conv_id", "left_semi").groupBy("conv_id", "run").agg(*(F.bit_xor(f"v{i}").alias(f"r{i}") for i in (0, 1)))
    before = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("conv_id", "run", *(F.coalesce(F.bit_xor(f"r{i}").over(before), F.lit(0)).alias(f"r{i}") for i in (0, 1)))
    whole = inside.join(runs, ["conv_id", "run"], "left")
    prefix = {f"p{i}": F.col(f"p{i}").bitwiseXOR(F.coalesce(f"r{i}", F.lit(0))) for i in (0, 1)}
    return whole.withColumns(prefix).drop("run", "r0", "r1")


def _key(block: Column, p0: Column, p1: Column, digests: Column) -> Column:
    return _digest(F.concat_ws(":", *(c.cast("string") for c in (block, p0, p1)), digests))


def _no_turns() -> Column:
    return F.array().cast("array<string>")


def _root() -> Column:
    return _key(F.lit(0), F.lit(0), F.lit(0), _no_turns())


def _with_keys(blocks: DataFrame, block: int) -> DataFrame:
    """Blocks with the keys of the nodes at their turn boundaries, the one before them first."""
    p0, p1 = F.col("p0"), F.col("p1")
    after = _key(F.col("block") + 1, p0.bitwiseXOR(F.col("v0")), p1.bitwiseXOR(F.col("v1")), _no_turns())
    inner = lambda j: _key(F.col("block"), p0, p1, F.slice(F.col("turns.digest"), F.lit(1), j))
    bounds = F.sequence(F.lit(0), F.size("turns"))
    return blocks.withColumn("keys", F.transform(bounds, lambda j: F.when(j == block, after).otherwise(inner(j))))


def _nodes(blocks: DataFrame, block: int) -> DataFrame:
    """``(key, parent, depth, words, n_convs, conv_id)`` of all nodes but the root."""
    prefix = ["block", "p0", "p1"]
    # The digest decides the turns, so they are part of the key.
    edges = cut_lineage(
        blocks.groupBy(*prefix, "digest", "v0", "v1", "turns").agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"))
    )
    alone = edges.groupBy(*prefix).agg(F.count(F.lit(1)).alias("siblings"), F.max("digest").alias("digest")).where("siblings = 1")
    marked = edges.join(alone.drop("siblings").withColumn("alone", F.lit(True)), [*prefix, "digest"], "left")
    turn = F.explode(F.sequence(F.lit(1), F.size("turns"))).alias("j")
    bounds = _with_keys(marked, block).select("*", turn).select(
        F.get("keys", F.col("j")).alias("key"),
        F.get("keys", F.col("j") - 1).alias("parent"),
        (F.col("block") * block + F.col("j")).alias("depth"),
        F.get("turns.words", F.col("j") - 1).alias("words"),
        "n_convs",
        "conv_id",
        F.coalesce("alone", F.lit(False)).alias("alone"),
    )
    shared = bounds.where(~F.col("alone")).groupBy("key", "parent", "depth", "words")
    refined = shared.agg(F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"))
    return bounds.where("alone").drop("alone").unionByName(refined)


def joined_digests(ends: DataFrame) -> DataFrame:
    """``(key, ends_sha256)``: SHA-256 of each key's decimal ``conv_id``, ascending, joined by commas.

    A key's ids are sorted and joined over all tasks; only the joined text of a key, which
    SHA-256 takes in one order, is read in one place, as a stream.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.string()), ("first", pa.int64()), ("ids", pa.string())])
        key, held, size = None, [], 0
        for batch in batches:
            rows: list[tuple] = []
            for own, conv_id in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
                if held and (own != key or size > _JOINED_BYTES):
                    rows.append((key, held[0], ",".join(map(str, held))))
                    held, size = [], 0
                key = own
                held.append(conv_id)
                size += 20
            if rows:
                yield as_batch(schema, *zip(*rows, strict=True))
        if held:
            yield as_batch(schema, [key], [held[0]], [",".join(map(str, held))])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.string()), ("ends_sha256", pa.string())])
        key, state = None, None
        for batch in batches:
            rows: list[tuple] = []
            for own, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if own != key:
                    if state is not None:
                        rows.append((key, state.hexdigest()))
                    key, state = own, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if rows:
                yield as_batch(schema, *zip(*rows, strict=True))
        if state is not None:
            yield as_batch(schema, [key], [state.hexdigest()])

    ranged = ends.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    texts = ranged.mapInArrow(join, "key string, first long, ids string")
    return texts.repartition("key").sortWithinPartitions("key", "first").mapInArrow(digest, "key string, ends_sha256 string")


def _subtree_sums(nodes: DataFrame, names: list[str]) -> DataFrame:
    """``(key, *names)`` summed over each node's subtree, from ``(key, parent, *names)``."""
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    state = cut_lineage(nodes.select("key", F.when(F.col("parent") != _root(), F.col("parent")).alias("up"), "parent", *names))
    # The root is above all nodes: it needs no rounds.
    reach = 1
    while reach < deepest:
        below = state.where(F.col("up").isNotNull()).groupBy(F.col("up").alias("key")).agg(*(F.sum(n).alias(f"more_{n}") for n in names))
        grown = state.join(below, "key", "left").select(
            "key", "up", "parent", *((F.col(n) + F.coalesce(f"more_{n}", F.lit(0))).alias(n) for n in names)
        )
        above = state.where(F.col("up").isNotNull()).select(F.col("key").alias("up"), F.col("up").alias("higher"))
        state = cut_lineage(grown.join(above, "up", "left").select("key", F.col("higher").alias("up"), "parent", *names))
        reach *= 2
    tops = state.where(F.col("parent") == _root()).agg(*(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names))
    return state.select("key", *names).unionByName(tops.select(_root().alias("key"), *names))


def prefix_trie(turns: DataFrame, convs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per distinct sequence of first turns, from ``(conv_id, at, digest, words)`` and lengths.

    A node has the smallest ``conv_id`` of its members and of its parent's, its ``depth``, how
    many members (``n_convs``), children and childless nodes below it (itself if it is one),
    the words that its subtree's repeated turns would cost again (``saved_tokens``), and a
    digest of the members that end there. The turn of a node is the one before ``depth`` of
    conversation ``conv_id``.
    """
    blocks = cut_lineage(_blocks(turns, convs, block))
    found = _nodes(blocks, block)
    root = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0").select(
        _root().alias("key"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("words"), "n_convs", "conv_id"
    )
    nodes = cut_lineage(found.unionByName(root))
    children = nodes.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    full = nodes.join(children, "key", "left").join(parents, "parent", "left")
    full = cut_lineage(full.withColumn("n_children", F.coalesce("n_children", F.lit(0))))
    own = full.select(
        "key",
        "parent",
        "depth",
        F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
    )
    # The root's own share: it has no text, and is a leaf only when it stands alone.
    sums = _subtree_sums(own.where(F.col("parent").isNotNull()), ["n_leaves", "saved_tokens"])
    ended = blocks.join(convs, "conv_id").where(F.col("block") == F.expr(f"(n_turns - 1) div {block}"))
    ended = _with_keys(ended, block).select(F.element_at("keys", -1).alias("key"), "conv_id")
    ends = joined_digests(ended.unionByName(convs.where("n_turns = 0").select(_root().alias("key"), "conv_id")))
    lone = (F.col("n_children") == 0) & F.col("parent").isNull()
    return (
        full.join(sums, "key", "left")
        .join(ends, "key", "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            F.when(lone, 1).otherwise(F.col("n_leaves")).cast("long").alias("n_leaves"),
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
        )
    )
