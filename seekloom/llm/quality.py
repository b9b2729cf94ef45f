"""Quality classifier: a byte-level convolutional network in numpy.

The text's UTF-8 bytes are cut into blocks; two neighbouring blocks make a chunk, so chunks
overlap by half and cover the whole document. Learned filters of 4 bytes run over all
positions. Each filter's largest response in a chunk, with the chunk's share of real bytes,
goes through a small dense layer; its units are max-pooled over the chunks and combined into
one probability. Everything is learned by gradient descent on labelled texts.

Null text is empty: one block of padding, with a defined score. The score of a text depends
on nothing but the text. Repeated rows have equal scores, other columns are ignored, and an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seekloom.llm.batches import release_unused
from seekloom.llm.samples import least_hashed

BLOCK = 256
FILTERS = 16
WIDTH = 4
HIDDEN = 16
#: Bounds of the labelled sample: rows of each label, and characters of a run of a longer row.
SAMPLE_ROWS = 1_500
SAMPLE_CHARS = 20_000
#: Chunks of a document that one training step looks at, drawn anew each time.
STEP_CHUNKS = 12
MIN_STEPS = 600
_SLICE_BYTES = 256 * 1024

Model = dict[str, np.ndarray]


def padded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts in whole blocks, blocks of each text, share of real bytes per block."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    blocks = np.maximum(1, -(-sizes // BLOCK))
    buffer = b"".join([t + b"\0" * (n * BLOCK - len(t)) for t, n in zip(texts, blocks.tolist(), strict=True)])
    starts = np.cumsum(blocks) - blocks
    number = np.arange(blocks.sum()) - np.repeat(starts, blocks)
    real = np.clip(np.repeat(sizes, blocks) - number * BLOCK, 0, BLOCK) / BLOCK
    return np.frombuffer(buffer, np.uint8), blocks, real.astype(np.float32)


def _ahead(buffer: np.ndarray, blocks: np.ndarray, k: int) -> np.ndarray:
    """The byte ``k`` places ahead of each; zero beyond the last block of its text."""
    out = np.concatenate([buffer[k:], np.zeros(k, np.uint8)])
    ends = np.cumsum(blocks) * BLOCK
    for back in range(1, k + 1):
        out[ends - back] = 0
    return out


def responses(model: Model, buffer: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Response of each filter at each byte: a sum of one table entry per byte under it."""
    total = model["filters"][0][buffer]
    for k in range(1, WIDTH):
        total += model["filters"][k][_ahead(buffer, blocks, k)]
    return total


def _chunked(block_values: np.ndarray, blocks: np.ndarray, join) -> np.ndarray:
    """Join each block with the next one of its text; the last block stands alone."""
    following = np.concatenate([block_values[1:], block_values[-1:]])
    last = np.cumsum(blocks) - 1
    following[last] = block_values[last]
    return join(block_values, following)


def probabilities(model: Model, texts: list[bytes]) -> np.ndarray:
    """The probability of label 1 for each text."""
    buffer, blocks, real = padded(texts)
    by_block = responses(model, buffer, blocks).reshape(-1, BLOCK, FILTERS).max(axis=1)
    pooled = np.maximum(_chunked(by_block, blocks, np.maximum), 0)
    filled = _chunked(real, blocks, lambda a, b: (a + b) / 2)
    hidden = np.maximum(np.column_stack([pooled, filled]) @ model["dense"] + model["dense_bias"], 0)
    best = np.maximum.reduceat(hidden, np.cumsum(blocks) - blocks, axis=0)
    logits = best @ model["out"] + model["out_bias"]
    return 1 / (1 + np.exp(-np.clip(logits, -40, 40).astype(np.float64)))


def score_texts(model: Model, texts: list[str | None]) -> np.ndarray:
    """Scores in slices of bounded size; every text is scored whole."""
    out, end = [], 0
    while end < len(texts):
        data, size = [], 0
        while end < len(texts) and size <= _SLICE_BYTES:
            data.append((texts[end] or "").encode())
            size += len(data[-1]) + BLOCK
            end += 1
        out.append(probabilities(model, data))
    return np.concatenate(out) if out else np.empty(0)


def _new_model(random: np.random.Generator) -> Model:
    return {
        "filters": random.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32),
        "dense": random.normal(0, 0.3, (FILTERS + 1, HIDDEN)).astype(np.float32),
        "dense_bias": np.full(HIDDEN, 0.1, np.float32),
        "out": random.normal(0, 0.3, HIDDEN).astype(np.float32),
        "out_bias": np.zeros(1, np.float32),
    }


def _gradients(model: Model, texts: list[bytes], labels: np.ndarray, weights: np.ndarray) -> Model:
    """Gradients of the weighted log loss. A maximum passes its gradient to where it was taken."""
    buffer, blocks, real = padded(texts)
    shaped = responses(model, buffer, blocks).reshape(-1, BLOCK, FILTERS)
    place = shaped.argmax(axis=1)
    by_block = np.take_along_axis(shaped, place[:, None, :], axis=1)[:, 0]
    n = len(by_block)
    following = np.arange(1, n + 1)
    last = np.cumsum(blocks) - 1
    following[last] = last
    use_next = by_block[following] > by_block
    raw = np.where(use_next, by_block[following], by_block)
    filled = (real + real[following]) / 2
    inputs = np.column_stack([np.maximum(raw, 0), filled])
    before = inputs @ model["dense"] + model["dense_bias"]
    hidden = np.maximum(before, 0)
    starts = np.cumsum(blocks) - blocks
    best = np.maximum.reduceat(hidden, starts, axis=0)
    logits = best @ model["out"] + model["out_bias"]
    error = (weights * (1 / (1 + np.exp(-np.clip(logits, -40, 40))) - labels)).astype(np.float32)
    out = {"out": best.T @ error, "out_bias": error.sum(keepdims=True)}
    # The chunk that gave a unit's maximum in its text.
    to_hidden = np.zeros_like(hidden)
    for i, (s, e) in enumerate(zip(starts.tolist(), (last + 1).tolist(), strict=True)):
        at = s + hidden[s:e].argmax(axis=0)
        to_hidden[at, np.arange(HIDDEN)] = error[i] * model["out"]
    to_hidden *= before > 0
    out["dense"], out["dense_bias"] = inputs.T @ to_hidden, to_hidden.sum(axis=0)
    to_raw = (to_hidden @ model["dense"].T)[:, :FILTERS] * (raw > 0)
    filters = np.zeros_like(model["filters"])
    chunk, unit = np.nonzero(to_raw)
    block = np.where(use_next[chunk, unit], following[chunk], chunk)
    position = block * BLOCK + place[block, unit]
    for k in range(WIDTH):
        np.add.at(filters[k], (_ahead(buffer, blocks, k)[position], unit), to_raw[chunk, unit])
    return out | {"filters": filters}


def _cropped(text: bytes, random: np.random.Generator) -> bytes:
    """A run of a text for one step; sometimes a few words, as texts of any label can be short."""
    size = STEP_CHUNKS * BLOCK
    if random.random() < 0.15:
        size = int(random.integers(2, 120))
    start = int(random.integers(0, len(text) - size + 1)) if len(text) > size else 0
    return text[start : start + size]


def train(texts: list[str], labels: list[int], epochs: int = 14, batch: int = 64, rate: float = 0.01, seed: int = 7) -> Model:
    """A model of labelled texts. Both labels weigh the same; without rows all scores are near one half."""
    random = np.random.default_rng(seed)
    model = _new_model(random)
    data, marks = [t.encode() for t in texts], np.array(labels, dtype=np.float32)
    if not data:
        return model
    share = np.array([(marks == 0).sum(), (marks == 1).sum()]) / len(marks)
    weight_of = np.where(share > 0, 0.5 / np.maximum(share, 1e-9), 0)
    first, second = ({k: np.zeros_like(v) for k, v in model.items()} for _ in range(2))
    steps = 0
    # A small sample is gone over more often.
    epochs = max(epochs, -(-MIN_STEPS * batch // len(data)))
    for epoch in range(epochs):
        order = random.permutation(len(data))
        for start in range(0, len(order), batch):
            rows = order[start : start + batch]
            given = _gradients(model, [_cropped(data[i], random) for i in rows], marks[rows], weight_of[marks[rows].astype(int)] / len(rows))
            steps += 1
            pace = rate * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
            for name, g in given.items():
                first[name] = 0.9 * first[name] + 0.1 * g
                second[name] = 0.999 * second[name] + 0.001 * g * g
                fitted = first[name] / (1 - 0.9**steps) / (np.sqrt(second[name] / (1 - 0.999**steps)) + 1e-8)
                model[name] = (model[name] - pace * fitted).astype(np.float32)
    return model


def learn(documents: DataFrame, labels: DataFrame) -> Model:
    """A model from documents and labels ``(doc_id, label)``, within the bounds of the sample.

    Ids are chosen first, those with the smallest hashes of each label, and only their texts
    are read out; of a long one a run at a place that the id's hash decides. Labels other than
    0 and 1 are not learned from; of several labels of one id the lowest counts, and of several
    rows of one id each is learned from.
    """
    own = labels.where(F.col("label").isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("label").cast("int").alias("label"))
    known = documents.select(F.col("doc_id").cast("long")).distinct()
    chosen = least_hashed(own.join(known, "doc_id", "left_semi"), "label", "doc_id", SAMPLE_ROWS).select("doc_id", "label", "order")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = documents.select(F.col("doc_id").cast("long"), text.alias("text")).join(F.broadcast(chosen), "doc_id")
    spare = F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0))
    run = F.substring(F.col("text"), (F.pmod(F.col("order"), spare + 1) + 1).cast("int"), F.lit(SAMPLE_CHARS))
    rows = texts.select("label", "order", run.alias("text")).collect()
    rows.sort(key=lambda r: (r["order"], r["label"], r["text"]))
    return train([r["text"] for r in rows], [r["label"] for r in rows])


def quality_score(text: Column, model: Model) -> Column:
    """Probability of label 1 of a text."""

    @F.pandas_udf(T.DoubleType())
    def score(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in series:
            yield pd.Series(score_texts(model, texts.where(texts.notna(), None).tolist()))
        release_unused()

    return score(text.cast("string"))
