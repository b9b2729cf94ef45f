"""Homomorphic multiset fingerprints of documents.

Every paragraph (a line of the text) is hashed to a wide vector, and a document's
fingerprint is the sum of its paragraphs' vectors, so it does not depend on their order, and
a paragraph is inserted or deleted by adding or subtracting its vector. A vector has two
parts:

* 8 lanes modulo 2**64, the paragraph's 512-bit digest. Documents with other paragraphs have
  other sums, so equality of fingerprints is equality of the multisets.
* 256 lanes modulo 2**32, the sum of a +1/-1 vector for each segment of the paragraph, a run
  of about eight words whose ends the paragraph's content decides. The squared length of the
  difference of two documents' lanes estimates how many segments they do not share.

Null text is empty: one empty paragraph. Equal texts have equal fingerprints. Other columns
are ignored and rows may repeat.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seekloom.llm.batches import as_batch, slices, texts_of
from seekloom.llm.hashing import mix, range_hashes

DIGEST_LANES = 8
SKETCH_LANES = 256
_DIGEST_BYTES = DIGEST_LANES * 8
#: One segment end in so many spaces, on average.
_SEGMENT_WORDS = 8
_SPACE, _LINE = 32, 10


def fingerprints(texts: list[bytes]) -> list[bytes]:
    """Digest lanes and sketch lanes of each text, as little-endian bytes."""
    paragraphs = [p for text in texts for p in text.split(b"\n")]
    digests = b"".join([hashlib.blake2b(p, digest_size=_DIGEST_BYTES).digest() for p in paragraphs])
    lanes = np.frombuffer(digests, dtype="<u8").reshape(-1, DIGEST_LANES)
    counts = np.fromiter((t.count(b"\n") + 1 for t in texts), np.int64, len(texts))
    strong = np.add.reduceat(lanes, np.cumsum(counts) - counts, axis=0)

    buffer = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)
    # A space ends a segment when the three bytes before it hash to a multiple. What is before
    # the paragraph does not count, so a paragraph has the same segments wherever it stands.
    window, own = np.zeros(len(buffer), dtype=np.uint32), np.ones(len(buffer), dtype=bool)
    for back, factor in ((1, 0x9E3779B1), (2, 0x85EBCA77), (3, 0xC2B2AE3D)):
        before = buffer[:-back]
        own[:back] = False
        own[back:] &= before != _LINE
        window[back:] += own[back:] * before.astype(np.uint32) * np.uint32(factor)
    cut = (buffer == _SPACE) & ((window >> np.uint32(13)) % np.uint32(_SEGMENT_WORDS) == 0)
    ends = np.flatnonzero(cut | (buffer == _LINE))
    starts = np.concatenate([[0], ends[:-1] + 1])
    hashes = range_hashes(buffer, starts, ends)
    bits = mix(hashes[:, None] ^ mix(np.arange(SKETCH_LANES // 64, dtype=np.uint64))[None, :])
    ones = np.unpackbits(bits.view(np.uint8).reshape(len(hashes), -1), axis=1)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    text_ends = np.cumsum(sizes + 1) - 1
    firsts = np.searchsorted(starts, text_ends - sizes)
    per_text = np.diff(np.concatenate([firsts, [len(starts)]]))
    plus = np.add.reduceat(ones, firsts, axis=0, dtype=np.uint32)
    sketch = (2 * plus.astype(np.int64) - per_text[:, None]).astype("<i8").astype("<u4")
    return [a.tobytes() + b.tobytes() for a, b in zip(strong.astype("<u8"), sketch, strict=True)]


def combine(left: bytes, right: bytes, sign: int = 1) -> bytes:
    """The fingerprint with another one's paragraphs inserted (1) or deleted (-1)."""
    strong = [np.frombuffer(f[:_DIGEST_BYTES], "<u8") for f in (left, right)]
    sketch = [np.frombuffer(f[_DIGEST_BYTES:], "<u4") for f in (left, right)]
    if sign > 0:
        return (strong[0] + strong[1]).tobytes() + (sketch[0] + sketch[1]).tobytes()
    return (strong[0] - strong[1]).tobytes() + (sketch[0] - sketch[1]).tobytes()


def likeness(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """Estimated share of segments that two documents have in common, 0 to 1.

    It is 1 exactly for equal fingerprints.
    """
    a, b = (
        np.frombuffer(b"".join([f[_DIGEST_BYTES:] for f in side]), "<i4").reshape(len(side), -1).astype(np.float64)
        for side in (left, right)
    )
    # Differences are taken modulo 2**32 like the sums.
    apart = ((a - b + 2.0**31) % 2.0**32) - 2.0**31
    norm = (a * a).sum(axis=1) + (b * b).sum(axis=1)
    found = 1 - (apart * apart).sum(axis=1) / np.maximum(norm, 1)
    same = np.fromiter((x == y for x, y in zip(left, right, strict=True)), bool, len(left))
    return np.where(same, 1.0, np.clip(found, 0.0, np.nextafter(1.0, 0.0)))


@F.pandas_udf(T.BinaryType())
def fingerprint(texts: pd.Series) -> pd.Series:
    """Column function: the fingerprint of a text."""
    data = [t.encode() for t in texts.fillna("")]
    out: list[bytes] = []
    for start in range(0, len(data), 500):
        out += fingerprints(data[start : start + 500])
    return pd.Series(out)


def range_number(key: Column, splits: list[int]) -> Column:
    """How many of the ascending splits are at most ``key``; found in two short steps."""
    if not splits:
        return F.lit(0)
    step = max(1, int(len(splits) ** 0.5))
    groups = [splits[i : i + step] for i in range(0, len(splits), step)]
    at = F.size(F.filter(F.lit([g[0] for g in groups]), lambda s: s <= key))
    fine = F.get(F.lit([g + [2**63 - 1] * (step - len(g)) for g in groups]), at - 1)
    return F.when(at == 0, F.lit(0)).otherwise((at - 1) * step + F.size(F.filter(fine, lambda s: s <= key)))


def with_next_text(documents: DataFrame, ranges: int | None = None) -> DataFrame:
    """``(doc_id, text)`` in ranges of descending ``doc_id``, ready for a pass over neighbours.

    Rows are dealt by ranges of ``doc_id``. Each range also gets the first row of the next one
    (the last range that of the very first), marked ``borrowed``. Splits and first ids, one
    value per range, pass through the driver. Null ids come last; rows of one id are ordered
    by their text.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ranges = ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select("doc_id")
    shares = [i / ranges for i in range(1, ranges)]
    quantiles = ids.agg(F.percentile_approx("doc_id", shares, 5 * ranges)).first()[0] if shares else None
    splits = sorted(set(quantiles or []))
    number = F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(range_number(F.col("doc_id"), splits))
    firsts = {r["range"]: r["first"] for r in ids.groupBy(number.alias("range")).agg(F.max("doc_id").alias("first")).collect()}
    order = sorted(firsts, reverse=True)
    # A range's first row goes to the range before it, the very first row to the last range.
    heads = [(firsts[own], order[i - 1]) for i, own in enumerate(order)]
    given = spark.createDataFrame(heads, "first long, lent int")
    ranged = docs.withColumn("range", number).join(F.broadcast(given), F.col("doc_id").eqNullSafe(F.col("first")), "left")
    lent = F.when(F.col("lent").isNotNull(), F.array("range", "lent")).otherwise(F.array("range"))
    dealt = ranged.select("doc_id", "text", F.posexplode(lent).alias("borrowed", "range"))
    return dealt.repartition(ranges, "range").sortWithinPartitions(
        F.desc("range"), "borrowed", F.desc_nulls_last("doc_id"), "text"
    )


_PAIRS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64())]
    + [(n, pa.string()) for n in ("edited_sha256", "fingerprint", "edited_fingerprint")]
    + [(n, pa.float64()) for n in ("near_edited", "near_next")]
)


def compare_with_next(documents: DataFrame, edit) -> DataFrame:
    """Fingerprints of all texts and of ``edit(text, next text)``, and their likeness."""

    def described(rows: list[tuple[int | None, str]], following: str) -> pa.RecordBatch:
        texts = [text for _, text in rows] + [following]
        whole = fingerprints([t.encode() for t in texts])
        edited = [edit(a, b).encode() for a, b in zip(texts[:-1], texts[1:], strict=True)]
        changed = fingerprints(edited)
        own, after = whole[:-1], whole[1:]
        return as_batch(
            _ARROW,
            [doc_id for doc_id, _ in rows],
            [len(t) for t in texts[:-1]],
            [hashlib.sha256(e).hexdigest() for e in edited],
            [f.hex() for f in own],
            [f.hex() for f in changed],
            likeness(own, changed),
            likeness(own, after),
        )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int | None, str]] = []
        for batch in slices(batches, "text"):
            columns = (batch.column(n).to_pylist() for n in ("doc_id", "borrowed"))
            for doc_id, borrowed, text in zip(*columns, texts_of(batch), strict=True):
                if borrowed:
                    # The first borrowed row is the next document; later ones have its id too.
                    if held:
                        yield described(held, text)
                    held = []
                else:
                    held.append((doc_id, text))
            if len(held) > 1:
                yield described(held[:-1], held[-1][1])
                held = held[-1:]

    return with_next_text(documents).select("doc_id", "borrowed", "text").mapInArrow(compare, _PAIRS)
