"""Near-duplicates by b-bit MinHash, confirmed on full shingle sets.

A document's set is that of its distinct shingles of ``words`` words (A-Z lower-cased, words
without ASCII white space); a shorter document has its whole sequence as the only shingle.
128 minima are taken over the set. Bands of 4 minima make candidates: at a similarity of 0.8
a pair without a common band is expected once in 20 million. Of each minimum the low 4 bits
are kept, packed in 8 longs; the number of equal 4-bit groups, corrected for those that are
equal by chance, estimates the similarity, and candidates far below the threshold go.

Documents with equal sets form a class with one representative, so copies are never compared.
Within a band's bucket, members are first paired with one member picked by hash; each document
confirms its most similar pick on the full sets. What is in different components after that is
paired with each other in small buckets. Large buckets with the same largest component form a
region, and every member is compared with one centre of it on the full sets. Pairs that both
are linked to the centre need no more. For the others the sets' differences from the centre
decide: with ``D`` for such a difference, two sets differ in ``|D_x| + |D_y|`` elements less
twice what the ``D`` share, so a pair of which one is not linked to the centre has to share
many of them, and some among the rarest ones. Those are joined, which is exact. Of all these
pairs only those go on whose sets may differ in few enough elements: every element of a set
flips one of 1,024 bits, so the bits of two sets that differ are at most as many as the elements
that differ, which is exact too. So every candidate pair is connected, compared or impossible,
and large groups of near copies do not give all their pairs.

Null or blank text has an empty set and is linked with nothing. A row without ``doc_id`` is
linked with nothing and stays. Rows of one ``doc_id`` are one document with the links of all
of them. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seekloom.llm.batches import as_batch, slices, texts_of
from seekloom.llm.hashing import mix, word_hashes
from seekloom.operators.joins import fits_broadcast, lookup_join
from seekloom.session import cut_lineage, scratch, scratched, small_batches

MINIMA = 128
BAND_ROWS = 4
BITS = 4
_LONGS = MINIMA * BITS // 64
#: Candidates whose estimate is lower than the threshold by more than this go: five standard errors.
SLACK = 0.2
#: Bits that a set's elements flip, as longs.
FLIP_LONGS = 16
#: Members from which on a bucket is large.
LARGE = 32
ELEMENTS_PER_TASK = 4_000_000
#: Bytes of texts, and of differences, that are worked on at once.
_SLICE_BYTES = 256 * 1024
_APART_BYTES = 1024 * 1024
_MEMBER = [(n, pa.int64()) for n in ("region", "rep", "centre", "component")] + [("flips", pa.list_(pa.int64()))]
_FACTS = [*_MEMBER, ("size", pa.int64()), ("n_apart", pa.int64()), ("linked", pa.bool_())]
_COMPARED = pa.schema([*_FACTS, ("apart", pa.binary())])
_CUT = pa.schema([("range", pa.int64())] + [(n, pa.binary()) for n in ("hashes", "regions", "reps")])
_COUNTED = pa.schema([(n, pa.int64()) for n in ("region", "rep", "n_common")] + [(n, pa.binary()) for n in ("hashes", "counts")])
_RARE = pa.schema([*_FACTS, ("n_common", pa.int64()), ("rare", pa.list_(pa.int64()))])

_SEEDS = mix(np.arange(1, 2 * MINIMA + 1, dtype=np.uint64))
_FACTORS, _TERMS = _SEEDS[:MINIMA] | np.uint64(1), _SEEDS[MINIMA:]
_STEP = np.uint64(0xD1342543DE82EF95)


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """The distinct shingles of each text as sorted 64-bit hashes."""
    hashes, bounds = word_hashes([t.encode() for t in texts])
    joined = np.zeros(max(0, len(hashes) - words + 1), dtype=np.uint64)
    for k in range(words):
        joined = joined * _STEP + hashes[k : k + len(joined)]
    joined = mix(joined)
    out = []
    for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if end - start >= words:
            out.append(np.unique(joined[start : end - words + 1]))
        elif end > start:
            whole = np.uint64(end - start)
            for h in hashes[start:end]:
                whole = mix(np.array([whole]))[0] ^ h
            out.append(mix(np.array([whole])))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Packed low bits of the minima of non-empty sets, and a hash for each band."""
    values = np.concatenate(sets)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    minima = np.empty((len(sets), MINIMA), dtype=np.uint64)
    for k in range(MINIMA):
        minima[:, k] = np.minimum.reduceat(values * _FACTORS[k] + _TERMS[k], starts)
    minima = mix(minima)
    low = (minima & np.uint64(2**BITS - 1)).astype(np.uint8)
    packed = (low[:, ::2] | (low[:, 1::2] << BITS)).view("<i8")
    bands = np.tile(np.arange(MINIMA // BAND_ROWS, dtype=np.uint64), (len(sets), 1))
    for k in range(BAND_ROWS):
        bands = mix(bands * _STEP + minima[:, k::BAND_ROWS])
    return packed, bands.view(np.int64)


_SIGNED = "doc_id long, n_shingles long, set_low long, set_high long, packed array<long>, bands array<long>, flips array<long>"
_SIGNED_ARROW = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "n_shingles", "set_low", "set_high")]
    + [(n, pa.list_(pa.int64())) for n in ("packed", "bands", "flips")]
)


def flipped(sets: list[np.ndarray]) -> np.ndarray:
    """Bits that are set by an odd number of a set's elements, as longs."""
    bits = FLIP_LONGS * 64
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    at = owner * bits + (mix(values) >> np.uint64(64 - bits.bit_length() + 1)).astype(np.int64)
    odd = (np.bincount(at, minlength=len(sets) * bits) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(len(sets), bits), axis=1).view("<i8")


def may_be_linked(left: str, right: str, percent: int) -> Column:
    """Whether sets with ``size`` and ``flips``, by the suffixes of both sides, may be similar enough."""
    least = F.lit(0)
    for i in range(FLIP_LONGS):
        least = least + F.bit_count(F.get(f"flips{left}", F.lit(i)).bitwiseXOR(F.get(f"flips{right}", F.lit(i))))
    return (100 + percent) * least <= (100 - percent) * (F.col(f"size{left}") + F.col(f"size{right}"))


def signed(documents: DataFrame, words: int) -> DataFrame:
    """Size of each document's set, a 128-bit key of the set, packed signature and bands."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _SLICE_BYTES):
            sets = shingle_sets(texts_of(batch), words)
            full = [i for i, s in enumerate(sets) if len(s)]
            packed, bands = [[]] * len(sets), [[]] * len(sets)
            if full:
                for i, p, b in zip(full, *signatures([sets[i] for i in full]), strict=True):
                    packed[i], bands[i] = p, b
            low = [int(s.sum(dtype=np.uint64).view(np.int64)) for s in sets]
            high = [int(mix(s).sum(dtype=np.uint64).view(np.int64)) for s in sets]
            yield as_batch(_SIGNED_ARROW, batch.column("doc_id"), [len(s) for s in sets], low, high, packed, bands, list(flipped(sets)))

    return documents.mapInArrow(sign, _SIGNED)


def estimate(left: Column, right: Column) -> Column:
    """Similarity from two packed signatures, corrected for bits that are equal by chance."""
    differing = F.lit(0)
    for i in range(_LONGS):
        x = F.get(left, F.lit(i)).bitwiseXOR(F.get(right, F.lit(i)))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        differing = differing + F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))
    chance = 2.0**-BITS
    return ((MINIMA - differing) / MINIMA - chance) / (1 - chance)


@scratched
def _confirmed(pairs: DataFrame, documents: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` whose full sets are similar enough."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text_a", _SLICE_BYTES):
            texts = [*texts_of(batch, "text_a"), *texts_of(batch, "text_b")]
            distinct = {t: i for i, t in enumerate(dict.fromkeys(texts))}
            sets = shingle_sets(list(distinct), words)
            linked = []
            for one, two in zip(texts[: batch.num_rows], texts[batch.num_rows :], strict=True):
                x, y = sets[distinct[one]], sets[distinct[two]]
                common = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * common >= percent * (len(x) + len(y) - common) > 0)
            yield batch.select(["a", "b"]).filter(pa.array(linked))

    pairs = cut_lineage(pairs)
    ids = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
    texts = cut_lineage(lookup_join(documents, ids, ["doc_id"], "left_semi"))
    sides = [texts.select(F.col("doc_id").alias(n), F.col("text").alias(f"text_{n}")) for n in "ab"]
    full = pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "text_a", "text_b")
    return full.mapInArrow(compare, "a long, b long")


@scratched
def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for all nodes of links ``(a, b)``: the smallest node reachable.

    Every node links its larger neighbours, then itself and its smaller ones, to the smallest
    of them, until the links are stars around that node.
    """
    edges = cut_lineage(links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while True:
        ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("top"))
        ends = ends.unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("top")))
        if ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("top").alias("top")).where("up > 1 OR up = 1 AND top = 1").isEmpty():
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(smallest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v")
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        edges = cut_lineage(small.where("u != v").distinct())
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


@scratched
def extended(found: DataFrame, links: DataFrame) -> DataFrame:
    """Components ``(node, component)`` with more links: those between components are merged."""
    own = found.select(F.col("node").alias("a"), F.col("component").alias("component_a"))
    other = found.select(F.col("node").alias("b"), F.col("component").alias("component_b"))
    joined = links.join(own, "a", "left").join(other, "b", "left")
    between = joined.select(F.coalesce("component_a", "a").alias("a"), F.coalesce("component_b", "b").alias("b"))
    between = cut_lineage(between.where("a != b").distinct())
    if between.isEmpty():
        return found
    merged = components(between)
    moved = found.join(merged.select(F.col("node").alias("component"), F.col("component").alias("into")), "component", "left")
    moved = moved.select("node", F.coalesce("into", "component").alias("component"))
    return moved.unionByName(merged.join(found.select("node"), "node", "left_anti"))


@scratched
def _mixed(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members of buckets with several components: theirs, the bucket's largest, and its size."""
    found = found.select(F.col("node").alias("rep"), "component")
    names = [n for n in members.columns if n != "pick"]
    placed = cut_lineage(members.select(*names).join(found, "rep", "left").withColumn("component", F.coalesce("component", "rep")))
    parts = placed.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    buckets = parts.groupBy("bucket").agg(
        F.max_by("component", F.struct("n", "component")).alias("largest"),
        F.sum("n").alias("members"),
        F.count(F.lit(1)).alias("parts"),
    )
    return placed.join(buckets.where("parts > 1").drop("parts"), "bucket")


def _schema(fields: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.bool_(): "boolean", pa.binary(): "binary", pa.list_(pa.int64()): "array<long>"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in fields)


@scratched
def _compared(regions: DataFrame, documents: DataFrame, words: int, percent: int) -> DataFrame:
    """Members ``(region, rep, centre, component, flips)`` with what their full sets differ from the centre's in.

    Elements are mixed with the region, as they are counted within it.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _SLICE_BYTES):
            sets = shingle_sets(texts_of(batch), words)
            centres = dict.fromkeys(texts_of(batch, "centre_text"))
            centres = dict(zip(centres, shingle_sets(list(centres), words), strict=True))
            sizes, counts, linked, apart = [], [], [], []
            for region, own, text in zip(batch.column("region").to_pylist(), sets, texts_of(batch, "centre_text"), strict=True):
                differing = np.setxor1d(own, centres[text], assume_unique=True)
                total = len(own) + len(centres[text])
                linked.append(100 * (total - len(differing)) >= percent * (total + len(differing)))
                sizes.append(len(own))
                counts.append(len(differing))
                apart.append(mix(differing ^ mix(np.array([region], np.int64).view(np.uint64))).tobytes())
            yield as_batch(_COMPARED, *(batch.column(n) for n, _ in _MEMBER), sizes, counts, linked, apart)

    texts = cut_lineage(lookup_join(documents, regions.select(F.col("rep").alias("doc_id")).distinct(), ["doc_id"], "left_semi"))
    centres = regions.select("centre").distinct().join(texts.select(F.col("doc_id").alias("centre"), F.col("text").alias("centre_text")), "centre")
    rows = texts.select(F.col("doc_id").alias("rep"), "text").join(regions, "rep")
    rows = lookup_join(rows, centres, ["centre"], salt_by=F.col("rep"))
    return rows.select(*(n for n, _ in _MEMBER), "text", "centre_text").mapInArrow(compare, _schema(_COMPARED))


def _common_elements(compared: DataFrame) -> DataFrame:
    """``(region, rep, n_common, hashes, counts)``: differences that several members of a region have.

    Elements go, in blocks, to the task that owns their range of hashes; each range gives a
    member at most one row.
    """
    ranges = 1 + (compared.agg(F.sum("n_apart")).first()[0] or 0) // ELEMENTS_PER_TASK

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "apart", _APART_BYTES):
            sizes = batch.column("n_apart").to_numpy()
            hashes = np.frombuffer(b"".join(batch.column("apart").to_pylist()), "<u8")
            owners = [np.repeat(batch.column(n).to_numpy(), sizes) for n in ("region", "rep")]
            at = ((hashes >> np.uint64(40)) * np.uint64(ranges) >> np.uint64(24)).astype(np.int64)
            order = np.argsort(at, kind="stable")
            found = np.unique(at)
            bounds = np.searchsorted(at[order], np.append(found, ranges))
            parts = [order[s:e] for s, e in zip(bounds[:-1], bounds[1:], strict=True)]
            yield as_batch(_CUT, found, *([x[part].tobytes() for part in parts] for x in (hashes, *owners)))

    def count(table: pa.Table) -> pa.Table:
        hashes, region, rep = (np.frombuffer(b"".join(table.column(n).to_pylist()), k) for n, k in (("hashes", "<u8"), ("regions", "<i8"), ("reps", "<i8")))
        _, at, times = np.unique(hashes, return_inverse=True, return_counts=True)
        chosen = np.flatnonzero(times[at] > 1)
        chosen = chosen[np.lexsort((rep[chosen], region[chosen]))]
        change = np.diff(region[chosen], prepend=np.int64(-(2**62))).astype(bool) | np.diff(rep[chosen], prepend=np.int64(-(2**62))).astype(bool)
        bounds = np.append(np.flatnonzero(change), len(chosen))
        parts = [chosen[s:e] for s, e in zip(bounds[:-1], bounds[1:], strict=True)]
        columns = [region[chosen[bounds[:-1]]], rep[chosen[bounds[:-1]]], np.diff(bounds)]
        data = ([x[part].tobytes() for part in parts] for x in (hashes, times[at].astype("<i8")))
        return pa.table([pa.array(c, f.type) for c, f in zip([*columns, *data], _COUNTED, strict=True)], schema=_COUNTED)

    blocks = compared.select("region", "rep", "n_apart", "apart").mapInArrow(cut, _schema(_CUT))
    return blocks.groupBy("range").applyInArrow(count, _schema(_COUNTED))


def _rare_elements(compared: DataFrame, percent: int) -> DataFrame:
    """Members with ``n_common`` and ``rare``: the common elements among their rarest differences.

    A pair of which one is not linked to the centre shares more than ``(1 - k) / 2`` of the
    other one's differences, ``k = (100 - percent) / (100 + percent)``; and of its own it shares
    all but ``k * (|x| + |y|)``, where ``|y|`` is at most ``100 / percent * |x|``. So the rest
    and one more of the rarest hold a shared one. Those that no other member has are the rarest.
    """
    common = _common_elements(compared).groupBy("region", "rep").agg(
        F.sum("n_common").alias("n_common"), F.collect_list("hashes").alias("hashes"), F.collect_list("counts").alias("counts")
    )
    k = (100 - percent) / (100 + percent)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(n).to_pylist() for n in ("size", "n_apart", "n_common", "linked", "hashes", "counts")), strict=True)
            rare = []
            for size, n, n_common, linked, hashes, counts in rows:
                length = n - int(n * (1 - k) / 2)
                if not linked:
                    length = max(length, min(n, int(k * size * (1 + 100 / percent) + 1e-6) + 1))
                own = np.frombuffer(b"".join(hashes), "<u8")
                order = np.lexsort((own, np.frombuffer(b"".join(counts), "<i8")))
                rare.append(own[order[: max(0, length - (n - n_common))]].view(np.int64))
            yield as_batch(_RARE, *(batch.column(n) for n, _ in _FACTS), batch.column("n_common"), rare)

    facts = compared.drop("apart").join(common, ["region", "rep"])
    return facts.select(*(n for n, _ in _FACTS), "n_common", "hashes", "counts").mapInArrow(choose, _schema(_RARE))


def _possible_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Pairs of a region in different components, one of them not linked to the centre, which may be linked.

    ``members`` have ``(region, rep, component, size, flips, n_apart, n_common, linked, rare)``.
    """
    every = members.select(*members.columns[:-1], F.explode("rare").alias("element"))
    facts = ("rep", "component", "size", "n_apart", "n_common", "flips")
    one = every.where(~F.col("linked")).select("region", "element", *(F.col(n).alias(f"{n}_a") for n in facts))
    differing = F.col("n_apart_a") + F.col("n_apart") - 2 * F.least("n_common_a", "n_common")
    possible = (100 + percent) * differing <= (100 - percent) * (F.col("size_a") + F.col("size"))
    once = F.col("linked") | (F.col("rep_a") < F.col("rep"))
    apart = F.col("component_a") != F.col("component")
    return one.join(every, ["region", "element"]).where(apart & once & possible & may_be_linked("_a", "", percent))


def _pairs_in_buckets(one: DataFrame, other: DataFrame, percent: int) -> DataFrame:
    """Pairs of members of a bucket in different components which may be linked."""
    left = one.select("bucket", *(F.col(n).alias(f"{n}_a") for n in ("rep", "component", "size", "flips")))
    right = other.select("bucket", "rep", "component", "size", "flips")
    return left.join(right, "bucket").where((F.col("component_a") != F.col("component")) & may_be_linked("_a", "", percent))


def _components_of_classes(filled: DataFrame, classes: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``(node, component)`` of the classes' representatives that are linked with another one."""
    nodes = cut_lineage(
        filled.join(classes, ["set_low", "set_high", "n_shingles"]).where("doc_id = rep").select("rep", F.col("n_shingles").alias("size"), "packed", "bands", "flips")
    )
    banded = nodes.select("rep", "size", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min_by("rep", F.xxhash64("rep", "bucket")).alias("pick")).where("n > 1")
    members = cut_lineage(banded.join(shared.select("bucket", "pick"), "bucket"))

    sides = {n: nodes.select(F.col("rep").alias(n), F.col("packed").alias(f"packed_{n}"), F.col("size").alias(f"size_{n}")) for n in "ab"}

    def candidates(pairs: DataFrame) -> DataFrame:
        """Pairs whose sizes and signatures allow the similarity, with the estimate."""
        joined = pairs.join(sides["a"], "a").join(sides["b"], "b")
        fits = 100 * F.least("size_a", "size_b") >= percent * F.greatest("size_a", "size_b")
        likely = estimate(F.col("packed_a"), F.col("packed_b"))
        return joined.where(fits).select("a", "b", likely.alias("likely")).where(F.col("likely") >= percent / 100 - SLACK)

    def confirmed_best(pairs: DataFrame) -> DataFrame:
        """Links of each ``a`` with its most similar candidate."""
        best = candidates(pairs).groupBy("a").agg(F.max_by("b", F.struct("likely", "b")).alias("b"))
        return _confirmed(best.select("a", "b"), docs, words, percent)

    links = confirmed_best(members.where("rep != pick").select(F.col("rep").alias("a"), F.col("pick").alias("b")).distinct())
    found = components(links)
    mixed = _mixed(members, found)
    # Rows of one id are not told apart by it, so they are left to the pairs of buckets.
    several = nodes.groupBy("rep").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("rep", F.lit(True).alias("several"))
    mixed = cut_lineage(mixed.join(several, "rep", "left"))
    flips = nodes.select("rep", "flips")
    large = mixed.where((F.col("members") > LARGE) & F.col("several").isNull())
    seats = cut_lineage(large.groupBy(F.col("largest").alias("region"), "rep", "component").agg(F.count(F.lit(1)).alias("n")).join(flips, "rep"))
    centres = seats.groupBy("region").agg(F.max_by("rep", F.struct((F.col("component") == F.col("region")).alias("own"), "n", "rep")).alias("centre"))
    compared = _compared(seats.join(centres, "region"), docs, words, percent)
    rare = cut_lineage(_rare_elements(compared, percent))
    small = mixed.where(F.col("members") <= LARGE).join(flips, "rep")
    pairs = _possible_pairs(rare, percent).select("rep", "rep_a").unionByName(_pairs_in_buckets(small, small, percent).select("rep", "rep_a"))
    if not several.isEmpty():
        crowded = mixed.where(F.col("members") > LARGE).join(flips, "rep")
        pairs = pairs.unionByName(_pairs_in_buckets(crowded.where("several"), crowded, percent).select("rep", "rep_a"))
    pairs = pairs.select(F.least("rep", "rep_a").alias("a"), F.greatest("rep", "rep_a").alias("b")).distinct()
    links = _confirmed(candidates(pairs).select("a", "b"), docs, words, percent)
    to_centre = compared.where("linked AND rep != centre").select(F.col("rep").alias("a"), F.col("centre").alias("b"))
    found = extended(found, links.unionByName(to_centre))
    return found


def near_duplicates(documents: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per document.

    Two documents are linked when their sets have a Jaccard similarity of ``percent`` or more.
    ``component_id`` is the smallest ``doc_id`` reachable over links; that document is kept.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    sets = ["set_low", "set_high", "n_shingles"]
    with small_batches(spark):
        rows = cut_lineage(signed(docs, words))
        filled = rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
        classes = cut_lineage(filled.groupBy(*sets).agg(F.min("doc_id").alias("rep")))
        with scratch(spark):
            found = cut_lineage(_components_of_classes(filled, classes, docs, words, percent), up=1)
    found = found.select(F.col("node").alias("rep"), "component")
    own = rows.select("doc_id", *sets).join(classes, sets, "left").join(found, "rep", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id"))
    return own.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")
    )


def drop_near_duplicates(documents: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The document of each component with the smallest id, with all its columns."""
    dropped = cut_lineage(near_duplicates(documents, words, percent).where(~F.col("kept")).select("doc_id").distinct())
    return lookup_join(documents, dropped, ["doc_id"], "left_anti", small=fits_broadcast(dropped))
