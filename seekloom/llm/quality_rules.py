"""Quality rules: gradient-boosted trees over statistics of a document.

Whole texts are counted with numpy: words, symbols, repeated lines, words in repeated windows
of three, and others. Shares of these counts are the features of boosted trees. More symbols,
repeated lines or repeated words never raise a score: splits that would are not taken, and
values below a split stay on their side of its middle. The trees are flattened into arrays of
nodes; all texts of a slice walk all trees at once.

Null text is empty. Rows may repeat; each is judged. Other columns are ignored. An empty table
gives no rows. Without labelled rows there is no tree and every score is one half.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seekloom.llm.batches import as_batch, slices, texts_of
from seekloom.llm.hashing import WHITESPACE, mix, range_hashes
from seekloom.llm.samples import least_hashed

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_MORE = ("n_lines", "n_digits", "n_upper", "n_marks", "n_wide", "n_distinct", "n_vowels")
FEATURES = (
    "words",
    "word_length",
    "symbols_per_word",
    "dup_line_share",
    "repeat_word_share",
    "words_per_line",
    "digit_share",
    "upper_share",
    "mark_share",
    "wide_share",
    "distinct_share",
    "vowel_share",
)
#: Features that may only lower the score as they grow.
FALLING = ("symbols_per_word", "dup_line_share", "repeat_word_share")
#: Bound of the labelled sample: rows of each label.
SAMPLE_ROWS = 2_000
#: Longer texts are counted in pieces that end at white space.
PIECE_BYTES = 1024 * 1024
_SLICE_BYTES = 1024 * 1024
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def _flags(characters: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(characters)] = True
    return out


_SPACE, _SYMBOL = _flags(WHITESPACE), _flags(b"#*$%&|<>")
_DIGIT, _UPPER = _flags(b"0123456789"), _flags(bytes(range(65, 91)))
_MARK, _VOWEL = _flags(b".,;:!?'\"()-"), _flags(b"aeiouyAEIOUY")
_FOLLOWS, _LEADS = _flags(bytes(range(0x80, 0xC0))), _flags(bytes(range(0xC0, 0x100)))
_STEP = np.uint64(0xD1342543DE82EF95)


def _pieces(texts: list[bytes]) -> Iterator[tuple[list[int], list[bytes]]]:
    """Runs of about ``PIECE_BYTES``: the number of each piece's text, and the pieces."""
    owners: list[int] = []
    held: list[bytes] = []
    size = 0
    for owner, text in enumerate(texts):
        start = 0
        while True:
            found = _BLANK.search(text, start + PIECE_BYTES) if len(text) - start > PIECE_BYTES else None
            end = found.start() if found else len(text)
            owners.append(owner)
            held.append(text[start:end])
            size += end - start
            if size >= PIECE_BYTES:
                yield owners, held
                owners, held, size = [], [], 0
            start = end
            if start >= len(text):
                break
    if held:
        yield owners, held


def _lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and how many of them equal an earlier line."""
    if b"\n" not in text:
        return (1, 0) if text.strip(WHITESPACE) else (0, 0)
    filled = [line for line in text.split(b"\n") if line.strip(WHITESPACE)]
    return len(filled), len(filled) - len(set(filled))


def statistics(texts: list[bytes]) -> dict[str, np.ndarray]:
    """Counts of each text, by name."""
    n = len(texts)
    out = {name: np.zeros(n, np.int64) for name in (*COUNTS, *_MORE)}
    hashes, owners = [], []
    for number, pieces in _pieces(texts):
        buffer = np.frombuffer(b" ".join(pieces) + b" ", dtype=np.uint8)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        starts = np.cumsum(sizes + 1) - sizes - 1
        owner = np.array(number)
        space = _SPACE[buffer]
        for name, flags in (
            ("word_chars", ~(space | _FOLLOWS[buffer])),
            ("n_symbols", _SYMBOL[buffer]),
            ("n_digits", _DIGIT[buffer]),
            ("n_upper", _UPPER[buffer]),
            ("n_marks", _MARK[buffer]),
            ("n_vowels", _VOWEL[buffer]),
            ("n_wide", _LEADS[buffer]),
        ):
            np.add.at(out[name], owner, np.add.reduceat(flags, starts, dtype=np.int64))
        edges = np.flatnonzero(np.diff(space, prepend=True))
        begins, ends = edges[::2], edges[1::2]
        hashes.append(range_hashes(buffer, begins, ends))
        owners.append(owner[np.searchsorted(starts, begins, side="right") - 1])
    words = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
    of = np.concatenate(owners) if owners else np.empty(0, np.int64)
    out["n_words"] = np.bincount(of, minlength=n)
    out["n_repeat_words"] = _repeated(words, of, n)
    own = words ^ mix(of.astype(np.uint64))
    own, first = np.unique(own, return_index=True)
    out["n_distinct"] = np.bincount(of[first], minlength=n)
    lines = np.array([_lines(t) for t in texts], dtype=np.int64).reshape(n, 2)
    out["n_lines"], out["n_dup_lines"] = lines[:, 0], lines[:, 1]
    return out


def _repeated(words: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """Words of each text that are in a window of three found twice or more in it."""
    if len(words) < 4:
        return np.zeros(n, np.int64)
    window = mix(mix(words[:-2] * _STEP + words[1:-1]) * _STEP + words[2:])
    inside = np.flatnonzero(of[:-2] == of[2:])
    keys = window[inside] ^ mix(of[inside].astype(np.uint64))
    order = np.argsort(keys)
    equal = keys[order[1:]] == keys[order[:-1]]
    again = np.zeros(len(words) + 2, dtype=bool)
    again[inside[order[1:][equal]]] = True
    again[inside[order[:-1][equal]]] = True
    covered = again[:-2].copy()
    covered[1:] |= again[: len(words) - 1]
    covered[2:] |= again[: len(words) - 2]
    return np.bincount(of[covered], minlength=n)


def features(counts: dict[str, np.ndarray]) -> np.ndarray:
    """One row of ``FEATURES`` per text; shares of nothing are 0."""
    c = {name: values.astype(np.float64) for name, values in counts.items()}
    words, chars, lines = (np.maximum(c[name], 1) for name in ("n_words", "word_chars", "n_lines"))
    return np.column_stack(
        [
            c["n_words"],
            c["word_chars"] / words,
            c["n_symbols"] / words,
            c["n_dup_lines"] / lines,
            c["n_repeat_words"] / words,
            c["n_words"] / lines,
            *(c[name] / chars for name in ("n_digits", "n_upper", "n_marks", "n_wide")),
            c["n_distinct"] / words,
            c["n_vowels"] / chars,
        ]
    )


class Trees:
    """Boosted trees as arrays of nodes; a leaf leads to itself."""

    def __init__(self, bias: float = 0.0):
        self.bias, self.depth = bias, 0
        self.roots: list[int] = []
        self.feature, self.bound, self.left, self.right, self.value = ([] for _ in range(5))

    def add(self) -> int:
        number = len(self.value)
        for name, start in (("feature", 0), ("bound", np.inf), ("left", number), ("right", number), ("value", 0.0)):
            getattr(self, name).append(start)
        return number

    def flat(self) -> dict[str, np.ndarray]:
        kinds = {"roots": np.int64, "feature": np.int64, "bound": np.float64, "left": np.int64, "right": np.int64, "value": np.float64}
        return {n: np.array(getattr(self, n), dtype=k) for n, k in kinds.items()} | {"bias": np.float64(self.bias), "depth": np.int64(self.depth)}


def probabilities(flat: dict[str, np.ndarray], rows: np.ndarray) -> np.ndarray:
    """The probability of label 1 of each row of features."""
    total = np.full(len(rows), float(flat["bias"]))
    if len(flat["roots"]) and len(rows):
        at = np.broadcast_to(flat["roots"], (len(rows), len(flat["roots"])))
        for _ in range(int(flat["depth"])):
            x = np.take_along_axis(rows, flat["feature"][at], axis=1)
            at = np.where(x <= flat["bound"][at], flat["left"][at], flat["right"][at])
        total += flat["value"][at].sum(axis=1)
    return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def train(
    rows: np.ndarray, labels: np.ndarray, trees: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 32, shrink: float = 2.0, least: int = 10
) -> dict[str, np.ndarray]:
    """Trees boosted by second-order steps on the log loss.

    Candidate bounds are quantiles. A leaf has ``least`` rows or more.
    """
    labels = labels.astype(np.float64)
    if not len(labels):
        return Trees().flat()
    share = np.clip(labels.mean(), 0.01, 0.99)
    model = Trees(float(np.log(share / (1 - share))))
    model.depth = depth
    signs = np.array([-1 if name in FALLING else 0 for name in FEATURES])
    bounds = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(rows.shape[1])]
    binned = np.column_stack([np.searchsorted(b, rows[:, f], side="left") for f, b in enumerate(bounds)])
    total = np.full(len(labels), model.bias)

    def worth(g, h):
        return g * g / (h + shrink)

    def grow(node: int, inside: np.ndarray, level: int, low: float, high: float) -> None:
        g, h = gradient[inside], curve[inside]
        best = (1e-6, None)
        if level < depth and len(inside) >= 2 * least:
            for f, cuts in enumerate(bounds):
                if not len(cuts):
                    continue
                place = binned[inside, f]
                gs, hs, ns = (np.cumsum(np.bincount(place, w, len(cuts) + 1))[:-1] for w in (g, h, None))
                values = [np.clip(-a / (b + shrink), low, high) for a, b in ((gs, hs), (g.sum() - gs, h.sum() - hs))]
                gain = worth(gs, hs) + worth(g.sum() - gs, h.sum() - hs) - worth(g.sum(), h.sum())
                allowed = (ns >= least) & (len(inside) - ns >= least)
                if signs[f]:
                    allowed &= signs[f] * (values[1] - values[0]) >= 0
                gain = np.where(allowed, gain, -np.inf)
                at = int(gain.argmax())
                if gain[at] > best[0]:
                    best = (float(gain[at]), (f, at, float(values[0][at]), float(values[1][at])))
        if best[1] is None:
            model.value[node] = rate * float(np.clip(-g.sum() / (h.sum() + shrink), low, high))
            total[inside] += model.value[node]
            return
        f, at, one, two = best[1]
        middle = (one + two) / 2
        limits = {0: ((low, high), (low, high)), -1: ((middle, high), (low, middle)), 1: ((low, middle), (middle, high))}[int(signs[f])]
        model.feature[node], model.bound[node] = f, float(bounds[f][at])
        lower = binned[inside, f] <= at
        for name, part, (a, b) in (("left", inside[lower], limits[0]), ("right", inside[~lower], limits[1])):
            child = model.add()
            getattr(model, name)[node] = child
            grow(child, part, level + 1, a, b)

    for _ in range(trees):
        chance = 1 / (1 + np.exp(-total))
        gradient, curve = chance - labels, chance * (1 - chance)
        model.roots.append(model.add())
        grow(model.roots[-1], np.arange(len(labels)), 0, -np.inf, np.inf)
    return model.flat()


_COUNTED = "doc_id long, " + ", ".join(f"{n} long" for n in (*COUNTS, *_MORE))
_COUNTED_ARROW = pa.schema([("doc_id", pa.int64())] + [(n, pa.int64()) for n in (*COUNTS, *_MORE)])


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def counted(documents: DataFrame) -> DataFrame:
    """``doc_id`` and all counts of each text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _SLICE_BYTES):
            found = statistics([t.encode() for t in texts_of(batch)])
            yield as_batch(_COUNTED_ARROW, batch.column("doc_id"), *(found[n] for n in _COUNTED_ARROW.names[1:]))

    return _texts(documents).mapInArrow(count, _COUNTED)


def learn(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> dict[str, np.ndarray]:
    """Trees for labels ``(doc_id, label)`` of documents, ``rows`` of each label at most.

    Ids are chosen first; only the counts of the chosen texts reach the driver. Labels other
    than 0 and 1 are ignored; of several labels of one id the lowest counts, and of several
    rows of one id each is learned from.
    """
    own = labels.where(F.col("label").isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("label").cast("int").alias("label"))
    known = documents.select(F.col("doc_id").cast("long")).distinct()
    chosen = least_hashed(own.join(known, "doc_id", "left_semi"), "label", "doc_id", rows).select("doc_id", "label")
    texts = _texts(documents).join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi")
    marks = {r["doc_id"]: r["label"] for r in chosen.collect()}
    found = sorted(map(tuple, counted(texts).collect()))
    names = _COUNTED_ARROW.names
    counts = {n: np.array([r[i] for r in found], dtype=np.int64) for i, n in enumerate(names)}
    return train(features({n: counts[n] for n in names[1:]}), np.array([marks[d] for d in counts["doc_id"].tolist()]))


_JUDGED = "doc_id long, " + ", ".join(f"{n} long" for n in COUNTS) + ", score double"
_JUDGED_ARROW = pa.schema([("doc_id", pa.int64())] + [(n, pa.int64()) for n in COUNTS] + [("score", pa.float64())])


def fails_base(min_words: int = 50, percent: int = 50) -> Column:
    """Too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > percent * F.col("n_words"))


def judge(documents: DataFrame, trees: dict[str, np.ndarray], least: float = 0.5) -> DataFrame:
    """Counts of each text, the trees' score, whether the base rules fail it, and whether it is kept."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _SLICE_BYTES):
            found = statistics([t.encode() for t in texts_of(batch)])
            yield as_batch(_JUDGED_ARROW, batch.column("doc_id"), *(found[n] for n in COUNTS), probabilities(trees, features(found)))

    judged = _texts(documents).mapInArrow(score, _JUDGED).withColumn("base_failed", fails_base())
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= least))
