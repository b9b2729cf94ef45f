"""Language identification by cross-parsing.

Some labelled text of each language is turned into a suffix automaton. A text is parsed
against each language: from its start, the longest run of bytes that occurs anywhere in the
language's text makes a phrase, then the next phrase begins. The language that needs the
fewest phrases per byte wins; ties go to the first name.

Texts are compared by their letters, lower-cased, with one space for everything between. They
are parsed whole, in blocks of fixed length that are parsed side by side; a phrase ends with
its block. Null text and text without a letter is ``und`` with score 0. With no labelled
text at all every text is ``und``. Neither the languages of other rows nor other columns are
read when a text is judged.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seekloom.llm.batches import release_unused
from seekloom.llm.samples import least_hashed

#: Bounds of the labelled sample: rows of a language, bytes of a row, bytes of a language.
SAMPLE_ROWS = 64
SAMPLE_ROW_BYTES = 2_048
SAMPLE_BYTES = 24 * 1024
BLOCK_BYTES = 512
UNDETERMINED = "und"
_SLICE_BYTES = 1024 * 1024

_APART = re.compile(r"[\W\d_]+")
_parsers: dict[str, Parser] = {}


def letters(text: str | None) -> bytes:
    """The letters of a text in lower case, other runs as one space; empty without a letter."""
    plain = _APART.sub(" ", (text or "").lower()).strip()
    return plain.encode() if any(map(str.isalpha, plain)) else b""


def suffix_automaton(text: bytes, classes: np.ndarray, width: int) -> np.ndarray:
    """Transitions of the automaton of all substrings: row per state, column per class, 0 for none."""
    moves: list[dict[int, int]] = [{}]
    links, lengths, last = [-1], [0], 0
    for symbol in classes[np.frombuffer(text, np.uint8)].tolist():
        current = len(moves)
        moves.append({})
        lengths.append(lengths[last] + 1)
        links.append(0)
        at = last
        while at >= 0 and symbol not in moves[at]:
            moves[at][symbol] = current
            at = links[at]
        if at >= 0:
            target = moves[at][symbol]
            if lengths[at] + 1 == lengths[target]:
                links[current] = target
            else:
                copy = len(moves)
                moves.append(dict(moves[target]))
                lengths.append(lengths[at] + 1)
                links.append(links[target])
                while at >= 0 and moves[at].get(symbol) == target:
                    moves[at][symbol] = copy
                    at = links[at]
                links[target] = links[current] = copy
        last = current
    table = np.zeros((len(moves), width), dtype=np.int32)
    for state, own in enumerate(moves):
        table[state, list(own)] = list(own.values())
    return table


class Parser:
    """Automata of all languages in one table."""

    def __init__(self, samples: dict[str, bytes]):
        self.languages = sorted(samples)
        used = np.unique(np.frombuffer(b"".join(samples.values()), np.uint8))
        # Class 0 is every byte that no sample has.
        self.classes = np.zeros(256, dtype=np.int32)
        self.classes[used] = np.arange(1, len(used) + 1)
        self.width = len(used) + 1
        tables, self.roots, size = [], [], 0
        for language in self.languages:
            table = suffix_automaton(samples[language], self.classes, self.width)
            tables.append(np.where(table > 0, table + size, -1))
            self.roots.append(size)
            size += len(table)
        self.table = np.concatenate(tables).ravel().astype(np.int32) if tables else np.empty(0, np.int32)
        self.rates = np.array([_own_rate(samples[language]) for language in self.languages])

    def phrases(self, texts: list[bytes]) -> np.ndarray:
        """Number of phrases of each non-empty text by each language."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        blocks = -(-sizes // BLOCK_BYTES)
        owner = np.repeat(np.arange(len(texts)), blocks)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        begins = np.repeat(np.cumsum(sizes) - sizes, blocks) + number * BLOCK_BYTES
        lengths = np.minimum(BLOCK_BYTES, sizes[owner] - number * BLOCK_BYTES)
        order = np.argsort(-lengths, kind="stable")
        begins, lengths, owner = begins[order], lengths[order], owner[order]
        symbols = self.classes[np.frombuffer(b"".join(texts), np.uint8)]
        roots = np.array(self.roots, dtype=np.int32)[:, None]
        at_root = self.table.reshape(-1, self.width)[self.roots]
        states = np.repeat(roots, len(owner), axis=1)
        counts = np.ones((len(roots), len(owner)), dtype=np.int32)
        # Blocks are in order of length, so those that go on are always the first ones.
        active = np.searchsorted(-lengths, -np.arange(1, BLOCK_BYTES + 1), side="right")
        for step, n in enumerate(active.tolist()):
            if not n:
                break
            symbol = symbols[begins[:n] + step]
            following = self.table[states[:, :n] * self.width + symbol]
            ended = following < 0
            counts[:, :n] += ended
            first = at_root[:, symbol]
            states[:, :n] = np.where(ended, np.where(first < 0, roots, first), following)
        out = np.zeros((len(texts), len(roots)), dtype=np.int64)
        for k in range(len(roots)):
            out[:, k] = np.bincount(owner, weights=counts[k], minlength=len(texts))
        return out

    def judge(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language of each text, and by how much the runner-up needs more phrases."""
        found, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        end = 0
        while end < len(texts) and self.languages:
            chosen, plain, size = [], [], 0
            while end < len(texts) and size <= _SLICE_BYTES:
                own = letters(texts[end])
                if own:
                    chosen.append(end)
                    plain.append(own)
                size += len(own)
                end += 1
            if not chosen:
                continue
            counts = self.phrases(plain)
            # A language with less labelled text needs more phrases for its own texts too.
            needed = counts / self.rates
            best = needed.argmin(axis=1)
            ordered = np.sort(needed, axis=1)
            score = 1 - ordered[:, 0] / ordered[:, 1] if len(self.languages) > 1 else np.ones(len(chosen))
            for i, b, s in zip(chosen, best.tolist(), score.tolist(), strict=True):
                found[i], scores[i] = self.languages[b], s
        return found, scores


def _own_rate(sample: bytes) -> float:
    """Phrases per byte that the first three quarters of a sample need for the rest."""
    cut = len(sample) * 3 // 4
    learned, rest = sample[:cut], sample[cut:]
    if not learned or not rest:
        return 1.0
    classes = np.zeros(256, dtype=np.int32)
    used = np.unique(np.frombuffer(learned, np.uint8))
    classes[used] = np.arange(1, len(used) + 1)
    table = suffix_automaton(learned, classes, len(used) + 1).tolist()
    state, phrases = 0, 1
    for symbol in classes[np.frombuffer(rest, np.uint8)].tolist():
        following = table[state][symbol]
        if not following:
            phrases += 1
            following = table[0][symbol]
        state = following
    return phrases / len(rest)


def parser(samples: dict[str, bytes]) -> Parser:
    """The worker's parser for some samples, built once."""
    key = hashlib.sha256(repr(sorted(samples.items())).encode()).hexdigest()
    if key not in _parsers:
        _parsers.clear()
        _parsers[key] = Parser(samples)
    return _parsers[key]


def learn_samples(labelled: DataFrame) -> dict[str, bytes]:
    """Text of each language from ``(doc_id, text, lang)``, within the bounds of the sample.

    Of each language the rows with the smallest hashes of their id are taken. Rows without a
    language or without an id are not.
    """
    ids = labelled.select("lang", F.col("doc_id").cast("long").alias("doc_id"))
    chosen = least_hashed(ids, "lang", "doc_id", SAMPLE_ROWS)
    texts = labelled.select("lang", F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    spare = F.greatest(F.length("text") - 2 * SAMPLE_ROW_BYTES, F.lit(0))
    run = F.substring(F.col("text"), (F.pmod(F.col("order"), spare + 1) + 1).cast("int"), F.lit(2 * SAMPLE_ROW_BYTES))
    rows = texts.join(F.broadcast(chosen.distinct()), ["lang", "doc_id"]).select("lang", "order", run.alias("text")).collect()
    samples: dict[str, bytes] = {}
    for row in sorted(rows, key=lambda r: (r["lang"], r["order"], r["text"] or "")):
        held = samples.get(row["lang"], b"")
        taken = letters(row["text"])[:SAMPLE_ROW_BYTES]
        if taken and len(held) < SAMPLE_BYTES:
            samples[row["lang"]] = (held + b" " + taken)[:SAMPLE_BYTES]
    return samples


def language_of(text: Column, samples: dict[str, bytes]) -> Column:
    """``struct<lang: string, score: double>`` of a text."""

    @F.pandas_udf(T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())]))
    def judge(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = parser(samples)
        for texts in series:
            found, scores = own.judge(texts.where(texts.notna(), None).tolist())
            yield pd.DataFrame({"lang": found, "score": scores})
        release_unused()

    return judge(text.cast("string"))


def identify(documents: DataFrame, samples: dict[str, bytes]) -> DataFrame:
    """All rows and columns with ``lang_pred`` and ``lang_score`` added."""
    judged = documents.withColumn("__judged", language_of(F.col("text"), samples))
    return judged.withColumns({"lang_pred": F.col("__judged.lang"), "lang_score": F.col("__judged.score")}).drop("__judged")
