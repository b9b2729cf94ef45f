"""Language-model scores of documents by deleted interpolation of word n-grams.

Tokens are words with A-Z lower-cased, then one end token. The model is

    P(v | u) = a(b) * c(u v) / c(u) + b(b) * c(v) / N + z(b) / (V + 1)

with maximum-likelihood estimates from the counts ``c`` of all training documents, ``N``
training tokens and ``V`` distinct ones; the last term is shared by the known tokens and one
unknown token. A document begins in the context of the end token. The three weights depend on
a bucket of the context's frequency, one per power of two. They are learned by
expectation-maximisation on held-out counts: each training token in turn is deleted from the
counts (``c - 1``) and predicted from the rest.

How it runs: documents are profiled in chunks of a few MB. Of each chunk, its distinct words
and word pairs go, as blocks of hashes, to the task that owns their hash bucket, which adds up
their counts over all chunks and sends each chunk the counts of what it asked for. With these
every chunk looks up its own tokens. Frequent words cross the shuffle once per chunk, not once
per token.

Null text is empty and has its end token alone. Rows may repeat; each counts. Other columns
are ignored. Without training tokens every score is 0, as only the unknown token is left.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seekloom.llm.batches import SLICE_BYTES, as_batch, slices, texts_of
from seekloom.llm.hashing import mix, word_hashes
from seekloom.session import new_folder

CHUNK_BYTES = 10 * 1024 * 1024
#: Bytes of text for each bucket of hashes; bounds what one task holds.
BUCKET_BYTES = 16 * 1024 * 1024
#: Stands for the end of a document; no word has a fixed hash.
END = np.uint64(0x5EED0E2D5EED0E2D)
_PAIR = np.uint64(0xD6E8FEB86659FD93)
_LEVELS = 40
#: Held-out events are counted in cells of a quarter of an octave of each estimate.
_STEPS = 4

Tokens = tuple[np.ndarray, np.ndarray]


def tokens_of(texts: list[str]) -> Tokens:
    """Hashes of the tokens of all texts, end tokens included, and the bounds of each text."""
    words, bounds = word_hashes([t.encode() for t in texts])
    tokens = np.insert(words, bounds[1:], END)
    return tokens, bounds + np.arange(len(bounds))


class Chunk:
    """Distinct tokens and pairs of tokens of a run of documents."""

    def __init__(self, tokens: np.ndarray, bounds: np.ndarray):
        self.tokens, self.bounds = tokens, bounds
        self.words, self.at = np.unique(tokens, return_inverse=True)
        # The token before a document's first one is the end token.
        before = np.empty(len(tokens), dtype=np.int64)
        before[1:] = self.at[:-1]
        before[bounds[:-1]] = np.searchsorted(self.words, END)
        self.before = before
        self.keys, self.pair_at = np.unique(before * len(self.words) + self.at, return_inverse=True)

    def pair_hashes(self) -> np.ndarray:
        first, second = np.divmod(self.keys, max(1, len(self.words)))
        return mix(self.words[first] * _PAIR + mix(self.words[second]))


def _bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)


def _by_bucket(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts hashes of one bucket together, and the bounds of each bucket."""
    own = _bucket_of(hashes, buckets)
    order = np.argsort(own, kind="stable")
    return order, np.searchsorted(own[order], np.arange(buckets + 1))


def _chunks(batches: Iterator[pa.RecordBatch], chunk_bytes: int) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """Runs of slices with ``chunk_bytes`` of text, each with an id from its task and place."""
    task, number, held, size = TaskContext.get().partitionId(), 0, [], 0
    for batch in slices(batches, "text"):
        held.append(batch)
        size += batch.column("text").nbytes
        if size >= chunk_bytes:
            yield (task << 24) + number, held
            number, held, size = number + 1, [], 0
    if held:
        yield (task << 24) + number, held


def _profile(held: list[pa.RecordBatch]) -> Chunk:
    parts = [tokens_of(texts_of(b)) for b in held]
    shifts = np.cumsum([0, *(len(t) for t, _ in parts)])
    bounds = np.concatenate([*(b[:-1] + s for (_, b), s in zip(parts, shifts, strict=False)), [shifts[-1]]])
    return Chunk(np.concatenate([t for t, _ in parts]), bounds)


def _columns(held: list[pa.RecordBatch], name: str) -> pa.Array:
    return pa.concat_arrays([b.column(name) for b in held])


_ASKED = "bucket long, chunk long, words binary, word_counts binary, pairs binary, pair_counts binary"
_ASKED_ARROW = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64())] + [(n, pa.binary()) for n in ("words", "word_counts", "pairs", "pair_counts")])


def _ask(documents: DataFrame, buckets: int, chunk_bytes: int) -> DataFrame:
    """One row per chunk and bucket: the chunk's hashes there, and its own training counts."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, held in _chunks(batches, chunk_bytes):
            chunk = _profile(held)
            learned = np.repeat(_columns(held, "learned").to_numpy(zero_copy_only=False), np.diff(chunk.bounds))
            columns: list[list] = []
            for hashes, at, kept in ((chunk.words, chunk.at, 8), (chunk.pair_hashes(), chunk.pair_at, 6)):
                counts = np.bincount(at, weights=learned, minlength=len(hashes)).astype("<u4")
                order, ends = _by_bucket(hashes, buckets)
                data = hashes[order].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :kept].copy()
                counts = counts[order]
                columns.append([data[s:e].tobytes() for s, e in zip(ends[:-1], ends[1:], strict=True)])
                columns.append([counts[s:e].tobytes() for s, e in zip(ends[:-1], ends[1:], strict=True)])
            yield as_batch(_ASKED_ARROW, np.arange(buckets), np.full(buckets, number), *columns)

    return documents.mapInArrow(ask, _ASKED)


_ANSWERS = "chunk long, bucket long, word_counts binary, pair_counts binary, tokens long, distinct long"
_ANSWERS_ARROW = pa.schema(
    [("chunk", pa.int64()), ("bucket", pa.int64()), ("word_counts", pa.binary()), ("pair_counts", pa.binary()), ("tokens", pa.int64()), ("distinct", pa.int64())]
)


def _planes(counts: np.ndarray) -> bytes:
    """64-bit counts as their low halves, then their high halves if one is not zero."""
    high = counts >> np.uint64(32)
    low = (counts & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes()
    return low + high.astype("<u4").tobytes() if high.any() else low


def _counts(data: bytes, n: int) -> np.ndarray:
    """The ``n`` counts of ``_planes``."""
    halves = np.frombuffer(data, "<u4")
    low = halves[:n].astype(np.uint64)
    return low if len(halves) == n else low + (halves[n:].astype(np.uint64) << np.uint64(32))


def _hashes(data: bytes, width: int) -> np.ndarray:
    whole = np.zeros((len(data) // width, 8), dtype=np.uint8)
    whole[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return whole.view("<u8").ravel()


def _answer(table: pa.Table) -> pa.Table:
    """Counts over all chunks of the hashes of one bucket, in the order each chunk asked."""
    columns, totals = [], []
    for name, counts_name, width in (("words", "word_counts", 8), ("pairs", "pair_counts", 6)):
        asked = [_hashes(d, width) for d in table.column(name).to_pylist()]
        counts = np.concatenate([np.frombuffer(d, "<u4") for d in table.column(counts_name).to_pylist()])
        distinct, at = np.unique(np.concatenate(asked), return_inverse=True)
        order = np.argsort(at, kind="stable")
        summed = np.add.reduceat(counts[order].astype(np.uint64), np.searchsorted(at[order], np.arange(len(distinct)))) if len(at) else counts.astype(np.uint64)
        answers = summed[at]
        ends = np.cumsum([0, *map(len, asked)])
        columns.append([_planes(answers[s:e]) for s, e in zip(ends[:-1], ends[1:], strict=True)])
        totals.append((int(summed.sum()), int((summed > 0).sum())))
    n = table.num_rows
    # A bucket's totals stand in its first row.
    tokens, distinct = ([value] + [0] * (n - 1) for value in totals[0])
    return pa.table([table.column("chunk"), table.column("bucket"), *columns, pa.array(tokens), pa.array(distinct)], schema=_ANSWERS_ARROW)


_LOOKED_UP = "doc_id long, learned boolean, n_tokens long, word_counts binary, pair_counts binary, cells binary"
_LOOKED_UP_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("learned", pa.bool_()), ("n_tokens", pa.int64())] + [(n, pa.binary()) for n in ("word_counts", "pair_counts", "cells")]
)
_STREAM = "chunk long, kind int, bucket long, doc_id long, learned boolean, data binary, more binary"
_STREAM_ARROW = pa.schema(
    [("chunk", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int64()), ("doc_id", pa.int64()), ("learned", pa.bool_()), ("data", pa.binary()), ("more", pa.binary())]
)
_WORDS_KIND, _DOCUMENT_KIND, _ANSWER_KIND = 0, 1, 2


def _streams(documents: DataFrame, chunk_bytes: int) -> DataFrame:
    """A chunk's distinct words, and each document as places among them."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, held in _chunks(batches, chunk_bytes):
            chunk = _profile(held)
            at = chunk.at.astype("<u4")
            ends = chunk.bounds.tolist()
            data = [chunk.words.astype("<u8").tobytes(), *(at[s:e].tobytes() for s, e in zip(ends[:-1], ends[1:], strict=True))]
            n = len(data)
            ids, learned = (_columns(held, name).to_pylist() for name in ("doc_id", "learned"))
            kinds = [_WORDS_KIND] + [_DOCUMENT_KIND] * (n - 1)
            rows = (np.full(n, number), kinds, np.arange(n), [None, *ids], [None, *learned], data, [None] * n)
            yield as_batch(_STREAM_ARROW, *rows)

    return documents.mapInArrow(stream, _STREAM)


def _events(own: np.ndarray, before: np.ndarray, pairs: np.ndarray, deleted: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of the context, and the two maximum-likelihood estimates but for their totals."""
    context = before.astype(np.int64) - deleted
    level = np.where(context > 0, np.log2(np.maximum(context, 1)).astype(np.int64) + 1, 0)
    pair_share = np.where(context > 0, (pairs.astype(np.int64) - deleted) / np.maximum(context, 1), 0.0)
    return np.minimum(level, _LEVELS - 1), pair_share, own.astype(np.float64) - deleted


def _cells(own: np.ndarray, before: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Held-out events by bucket and rounded logarithms of both estimates: cells and counts."""
    level, share, count = _events(own, before, pairs, 1)
    first = np.where(share > 0, np.round(-_STEPS * np.log2(np.where(share > 0, share, 1))), 255).astype(np.int64)
    second = np.where(count > 0, np.round(_STEPS * np.log2(np.where(count > 0, count, 1))), 255).astype(np.int64)
    return np.unique((level << 16) + (np.minimum(first, 255) << 8) + np.minimum(second, 255), return_counts=True)


def _look_up(table: pa.Table, buckets: int) -> pa.Table:
    """All counts that a chunk's documents need, token by token."""
    kinds, places = table.column("kind").to_numpy(), table.column("bucket").to_numpy()
    rows = np.lexsort((places, kinds))
    data, more = table.column("data"), table.column("more")
    words = np.frombuffer(data[int(rows[0])].as_py(), "<u8")
    documents = rows[kinds[rows] == _DOCUMENT_KIND].tolist()
    answers = rows[kinds[rows] == _ANSWER_KIND].tolist()
    streams = [np.frombuffer(data[i].as_py(), "<u4") for i in documents]
    bounds = np.cumsum([0, *map(len, streams)])
    chunk = Chunk(words[np.concatenate(streams)], bounds)

    def in_order(hashes: np.ndarray, parts: list[bytes]) -> np.ndarray:
        found = np.empty(len(hashes), dtype=np.uint64)
        order, ends = _by_bucket(hashes, buckets)
        found[order] = np.concatenate([_counts(p, n) for p, n in zip(parts, np.diff(ends).tolist(), strict=True)])
        return found

    word_counts = in_order(chunk.words, [data[i].as_py() for i in answers])
    own, before = word_counts[chunk.at], word_counts[chunk.before]
    pairs = in_order(chunk.pair_hashes(), [more[i].as_py() for i in answers])[chunk.pair_at]
    learned = [table.column("learned")[i].as_py() for i in documents]
    chosen = np.repeat(np.array(learned, dtype=bool), np.diff(bounds))
    cells, counts = _cells(own[chosen], before[chosen], pairs[chosen])
    summary = np.stack([cells, counts], axis=1).astype("<i8").tobytes()
    spans = list(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))
    ids = [table.column("doc_id")[i].as_py() for i in documents]
    return pa.table(
        [
            pa.array(ids, pa.int64()),
            pa.array(learned, pa.bool_()),
            pa.array([e - s for s, e in spans], pa.int64()),
            pa.array([_planes(own[s:e]) for s, e in spans], pa.binary()),
            pa.array([_planes(pairs[s:e]) for s, e in spans], pa.binary()),
            # The chunk's held-out events stand in its first row.
            pa.array([summary] + [None] * (len(spans) - 1), pa.binary()),
        ],
        schema=_LOOKED_UP_ARROW,
    )


def learn_weights(cells: np.ndarray, counts: np.ndarray, tokens: int, distinct: int, rounds: int = 60) -> np.ndarray:
    """Weights of the three estimates per bucket of context frequency, by EM on held-out counts.

    A bucket without events takes the weights of all events together.
    """
    level, first, second = cells >> 16, (cells >> 8) & 255, cells & 255
    estimates = np.stack(
        [
            np.where(first < 255, 2.0 ** (-first / _STEPS), 0.0),
            np.where(second < 255, 2.0 ** (second / _STEPS) / max(1, tokens - 1), 0.0),
            np.full(len(cells), 1.0 / (distinct + 1)),
        ],
        axis=1,
    )

    def fit(chosen: np.ndarray) -> np.ndarray:
        weights = np.full(3, 1 / 3)
        for _ in range(rounds):
            shares = estimates[chosen] * weights
            shares *= (counts[chosen] / shares.sum(axis=1))[:, None]
            weights = shares.sum(axis=0) / shares.sum()
        # The unknown token keeps a chance in every context.
        weights = np.maximum(weights, 1e-9)
        return weights / weights.sum()

    everything = fit(np.arange(len(cells))) if len(cells) else np.array([0.0, 0.0, 1.0])
    out = np.tile(everything, (_LEVELS, 1))
    for own in np.unique(level):
        out[own] = fit(np.flatnonzero(level == own))
    # A context that was never met has no pair estimate: its share goes to the other two.
    unseen = out[0] * [0, 1, 1]
    out[0] = unseen / unseen.sum() if unseen.sum() else [0.0, 0.0, 1.0]
    return out


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
_SCORES_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_())]
    + [(n, pa.int64()) for n in ("n_tokens", "n_known", "train_tokens")]
    + [("base_score", pa.float64()), ("score", pa.float64())]
)


def _score(rows: DataFrame, weights: np.ndarray, tokens: int, distinct: int) -> DataFrame:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A dozen arrays of 64-bit values stand beside the counts, so few of them are held at once.
        for batch in slices(batches, "word_counts", SLICE_BYTES // 2):
            sizes = batch.column("n_tokens").to_numpy()
            own, pairs = (
                np.concatenate([_counts(d, n) for d, n in zip(batch.column(c).to_pylist(), sizes.tolist(), strict=True)])
                for c in ("word_counts", "pair_counts")
            )
            starts = np.cumsum(sizes) - sizes
            before = np.roll(own, 1)
            # Every document ends with the end token, whose count is that of its first context.
            before[starts] = own[starts + sizes - 1]
            level, share, count = _events(own, before, pairs, 0)
            chance = weights[level, 0] * share + weights[level, 1] * count / max(1, tokens) + weights[level, 2] / (distinct + 1)
            base = np.log10((count + 0.1) / (tokens + 0.1 * (distinct + 1)))
            yield as_batch(
                _SCORES_ARROW,
                batch.column("doc_id"),
                ~batch.column("learned").to_numpy(zero_copy_only=False),
                sizes,
                np.add.reduceat((own > 0).astype(np.int64), starts),
                np.full(len(sizes), tokens),
                np.add.reduceat(base, starts),
                np.add.reduceat(np.log10(chance), starts),
            )

    return rows.select("doc_id", "learned", "n_tokens", "word_counts", "pair_counts").mapInArrow(score, _SCORES)


def _sum_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in batch.column("cells").to_pylist():
            pairs = np.frombuffer(data, "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["cell", "n"])


def score_documents(documents: DataFrame, learned: Callable[[], Column], chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Scores of all documents by a model of those for which ``learned()`` holds.

    ``held_out`` tells the others. ``n_known`` counts tokens with a training count,
    ``train_tokens`` all training tokens. ``base_score`` is the log10 probability by single
    tokens with 0.1 added to each count, ``score`` that of the interpolated model.

    Buckets of hashes are as many as the session's shuffle partitions, or more, so that each
    stands for ``BUCKET_BYTES`` of text at most. At most a few thousand cells of held-out events
    reach the driver, whatever the number of documents.
    """
    spark = documents.sparkSession
    size = documents.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    docs = documents.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string"), F.coalesce(learned(), F.lit(False)).alias("learned")
    )

    def stored(rows: DataFrame, name: str) -> DataFrame:
        path = new_folder(spark, name)
        rows.write.option("compression", "zstd").parquet(path)
        return spark.read.schema(rows.schema).parquet(path)

    answers = stored(_ask(docs, buckets, chunk_bytes).groupBy("bucket").applyInArrow(_answer, _ANSWERS), "answers")
    totals = answers.agg(F.sum("tokens").alias("tokens"), F.sum("distinct").alias("distinct")).first()
    tokens, distinct = totals["tokens"] or 0, totals["distinct"] or 0
    replies = answers.select(
        "chunk",
        F.lit(_ANSWER_KIND).alias("kind"),
        "bucket",
        F.lit(None).cast("long").alias("doc_id"),
        F.lit(None).cast("boolean").alias("learned"),
        F.col("word_counts").alias("data"),
        F.col("pair_counts").alias("more"),
    )
    looked_up = stored(
        _streams(docs, chunk_bytes).unionByName(replies).groupBy("chunk").applyInArrow(lambda t: _look_up(t, buckets), _LOOKED_UP), "looked-up"
    )
    held_out = looked_up.where(F.col("cells").isNotNull()).select("cells").mapInArrow(_sum_cells, "cell long, n long")
    counted = held_out.groupBy("cell").agg(F.sum("n").alias("n")).collect()
    cells = np.array([r["cell"] for r in counted], dtype=np.int64)
    weights = learn_weights(cells, np.array([r["n"] for r in counted], dtype=np.float64), tokens, distinct)
    return _score(looked_up, weights, tokens, distinct)
