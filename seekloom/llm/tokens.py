"""Token ids of many texts by a byte-level BPE file of the tokenizers library.

The file's pre-tokenizer cuts a text into words, which are encoded one by one. Words that
can be told apart by their bytes are found with numpy, and every distinct one is given to
the library once; words that begin with a space are given to it joined, and their ids are cut
before each id that begins with a space. Space-separated items with other characters are given
to it as a whole, and so are texts whose white space is not single spaces or line ends between
other characters, or which name a special token.
"""

from __future__ import annotations

import itertools
import os

import numpy as np
import pyarrow as pa

from seekloom.llm.hashing import range_hashes

#: Texts are encoded in slices of so many bytes.
SLICE_BYTES = 512 * 1024
#: Words remembered by a worker. Past it the rarer half is forgotten; bounds its memory, not the result.
REMEMBERED = 1_500_000
#: Words that the library gets as one text.
_JOINED = 500
_LETTER, _DIGIT, _PUNCTUATION, _SPACE, _LINE, _OTHER = range(6)
_CLASSES = np.full(256, _OTHER, dtype=np.uint8)
for _kind, _characters in ((_DIGIT, "0123456789"), (_PUNCTUATION, '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'), (_SPACE, " "), (_LINE, "\t\n\x0b\x0c\r")):
    _CLASSES[list(_characters.encode())] = _kind
_CLASSES[65:91] = _CLASSES[97:123] = _LETTER
#: Leads of characters that are white space or have no width, and the characters.
_WIDE_LEADS = np.zeros(256, dtype=bool)
_WIDE_LEADS[[0xC2, 0xE1, 0xE2, 0xE3, 0xEF]] = True
_WIDE_POINTS = [0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x2010), *range(0x2028, 0x2030), *range(0x205F, 0x2065), 0x3000, 0xFEFF]
_WIDE = np.sort([int.from_bytes(chr(c).encode().ljust(3, b"\0"), "big") for c in _WIDE_POINTS])
_CONTROL = np.zeros(256, dtype=bool)
_CONTROL[0x1C:0x20] = True

_encoders: dict[str, Encoder] = {}


def _cut(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the words in texts that are each followed by a zero byte; and odd bytes.

    A word begins at each space, and at each change of class in an item of known classes.
    """
    kind = _CLASSES[buffer]
    accented = np.flatnonzero(buffer[:-1] == 0xC3)
    accented = accented[(buffer[accented + 1] & 0xC0 == 0x80) & (buffer[accented + 1] != 0x97) & (buffer[accented + 1] != 0xB7)]
    kind[accented] = kind[accented + 1] = _LETTER
    kind[buffer == 0] = _SPACE
    space, line = kind == _SPACE, kind == _LINE
    blank = space | line
    after_blank = np.concatenate([[True], blank[:-1]])
    odd = blank & after_blank & (buffer != 0)
    odd[1:] |= (buffer[1:] == 0) & line[:-1]
    odd[:1] = blank[:1]
    # Items are numbered by the spaces before them.
    begins = np.flatnonzero(space)
    item_starts = np.concatenate([[0], begins + 1])
    complex_items = np.zeros(len(item_starts), dtype=bool)
    complex_items[np.searchsorted(begins, np.flatnonzero(kind == _OTHER))] = True
    change = np.concatenate([[True], kind[1:] != kind[:-1]])
    change[item_starts[:-1]] = False
    spread = np.repeat(complex_items, np.diff(np.concatenate([item_starts, [len(buffer) + 1]])))[: len(buffer)]
    return (change & ~spread) | space, odd


class KnownWords:
    """Ids of words by hash: a table of open addresses, looked up for many words at once.

    It grows with the words, and has at least four places for each.
    """

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.clear()

    def clear(self) -> None:
        self.bits = 12
        self.slots = np.full(1 << self.bits, -1, dtype=np.int32)
        self.count, self.used = 0, 0
        self.hashes, self.hits = np.empty(1 << 12, np.uint64), np.empty(1 << 12, np.int64)
        self.starts, self.sizes, self.ids = np.empty(1 << 12, np.int64), np.empty(1 << 12, np.int64), np.empty(1 << 14, "<u4")

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each word, or -1."""
        out = np.full(len(hashes), -1, dtype=np.int64)
        at = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        open_ = np.arange(len(hashes))
        while len(open_):
            number = self.slots[at[open_]]
            taken = number >= 0
            open_, number = open_[taken], number[taken]
            same = self.hashes[number] == hashes[open_]
            out[open_[same]] = number[same]
            open_ = open_[~same]
            at[open_] = (at[open_] + 1) & (len(self.slots) - 1)
        return out

    def add(self, hashes: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Distinct words that are not in the table yet."""
        n = len(hashes)
        for name, grown, needed in [(x, self.count, n) for x in ("hashes", "hits", "starts", "sizes")] + [("ids", self.used, len(ids))]:
            held = getattr(self, name)
            if grown + needed > len(held):
                larger = np.empty(max(2 * len(held), grown + needed), held.dtype)
                larger[:grown] = held[:grown]
                setattr(self, name, larger)
        own = slice(self.count, self.count + n)
        self.hashes[own], self.hits[own], self.sizes[own] = hashes, 0, sizes
        self.starts[own] = self.used + np.cumsum(sizes) - sizes
        self.ids[self.used : self.used + len(ids)] = ids
        first, self.count, self.used = self.count, self.count + n, self.used + len(ids)
        if 4 * self.count > len(self.slots):
            self.bits, first = (4 * self.count - 1).bit_length(), 0
            self.slots = np.full(1 << self.bits, -1, dtype=np.int32)
        self._place(np.arange(first, self.count, dtype=np.int32))

    def _place(self, numbers: np.ndarray) -> None:
        """Give each of these words a place."""
        at = (self.hashes[numbers] >> np.uint64(64 - self.bits)).astype(np.int64)
        open_ = np.arange(len(numbers))
        while len(open_):
            free = open_[self.slots[at[open_]] < 0]
            self.slots[at[free]] = numbers[free]
            open_ = open_[self.slots[at[open_]] != numbers[open_]]
            at[open_] = (at[open_] + 1) & (len(self.slots) - 1)

    def spelled(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words one after the other, and the bounds of each word's."""
        counts = self.sizes[numbers]
        into = np.concatenate([[0], np.cumsum(counts)])
        return self.ids[np.repeat(self.starts[numbers] - into[:-1], counts) + np.arange(into[-1])], into

    def forget(self) -> None:
        """Keep the half that was met most often; earlier meetings count half."""
        numbers = np.sort(np.argsort(-self.hits[: self.count], kind="stable")[: self.capacity // 2])
        hashes, hits, sizes = self.hashes[numbers].copy(), self.hits[numbers] // 2, self.sizes[numbers].copy()
        ids, _ = self.spelled(numbers)
        self.clear()
        self.add(hashes, ids, sizes)
        self.hits[: len(hits)] = hits


class Encoder:
    """Encodes texts to unsigned 32-bit ids."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        names = self.tokenizer.get_vocab()
        # Byte-level files spell a space so.
        self.after_space = np.zeros(max(names.values(), default=0) + 1, dtype=bool)
        self.after_space[[i for name, i in names.items() if name.startswith("\u0120")]] = True
        self.known = KnownWords(REMEMBERED)

    def _library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and the number of each text's ids."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(itertools.chain.from_iterable(found), "<u4", int(sizes.sum())), sizes

    def _words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """As ``_library``, for words that all begin with a space."""
        ids, _ = self._library([b"".join(words[i : i + _JOINED]).decode() for i in range(0, len(words), _JOINED)])
        heads = np.flatnonzero(self.after_space[ids])
        if len(heads) != len(words) or (len(heads) and heads[0]):
            return self._library([w.decode() for w in words])
        return ids, np.diff(np.append(heads, len(ids)))

    def _learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        spaced = np.fromiter((w[:1] == b" " and len(w) > 1 for w in words), bool, len(words))
        for own, encode in ((spaced, self._words), (~spaced, lambda rest: self._library([w.decode() for w in rest]))):
            chosen = np.flatnonzero(own)
            if len(chosen):
                self.known.add(hashes[chosen], *encode([words[i] for i in chosen.tolist()]))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """One array of ids per text."""
        return self._encode([t.encode() for t in texts])

    def encode_column(self, texts: pa.Array) -> list[np.ndarray]:
        """One array of ids per string of an Arrow column; null is empty."""
        texts = (texts.fill_null("") if texts.null_count else texts).cast(pa.large_binary())
        data = memoryview(texts.buffers()[2] or b"")
        bounds = np.frombuffer(texts.buffers()[1], "<i8")[texts.offset : texts.offset + len(texts) + 1].tolist()
        return self._encode([data[s:e] for s, e in zip(bounds[:-1], bounds[1:], strict=True)])

    def _encode(self, data: list[bytes] | list[memoryview]) -> list[np.ndarray]:
        joined = b"\0".join([*data, b""])
        buffer = np.frombuffer(joined, dtype=np.uint8)
        lengths = np.fromiter(map(len, data), np.int64, len(data))
        text_ends = np.cumsum(lengths + 1) - 1
        begins, odd = _cut(buffer)
        odd |= self._unusual(joined, buffer, text_ends)
        begins[text_ends - lengths] = True
        starts = np.flatnonzero(begins)
        ends = np.concatenate([starts[1:], [len(buffer)]])
        # The zero byte after a text is no word.
        real = buffer[starts] != 0
        starts, ends = starts[real], ends[real]
        coded = pa.array(range_hashes(buffer, starts, ends)).dictionary_encode()
        at, distinct = coded.indices.to_numpy(), coded.dictionary.to_numpy()
        if self.known.count > self.known.capacity:
            self.known.forget()
        numbers = self.known.find(distinct)
        unknown = numbers < 0
        if unknown.any():
            first = np.empty(len(distinct), dtype=np.int64)
            first[at[::-1]] = np.arange(len(at))[::-1]
            first = first[unknown]
            spans = zip(starts[first].tolist(), ends[first].tolist(), strict=True)
            self._learn(distinct[unknown], [joined[s:e] for s, e in spans])
            numbers[unknown] = self.known.find(distinct[unknown])
        self.known.hits[numbers] += 1
        gathered, into = self.known.spelled(numbers[at])
        bounds = into[np.concatenate([[0], np.searchsorted(starts, text_ends)])].tolist()
        odd_before = np.concatenate([[0], np.cumsum(odd)])
        is_odd = odd_before[text_ends + 1] > odd_before[text_ends - lengths]
        out = [gathered[s:e] for s, e in zip(bounds[:-1], bounds[1:], strict=True)]
        for i in np.flatnonzero(is_odd).tolist():
            out[i] = self._library([bytes(data[i]).decode()])[0]
        return out

    def _unusual(self, joined: bytes, buffer: np.ndarray, text_ends: np.ndarray) -> np.ndarray:
        """Bytes that make a text one for the library: zeros, separators, wide white space, special tokens."""
        out = _CONTROL[buffer]
        zeros = buffer == 0
        zeros[text_ends] = False
        out |= zeros
        leads = np.flatnonzero(_WIDE_LEADS[buffer])
        if len(leads):
            after = np.minimum(leads[:, None] + np.arange(3), len(buffer) - 1)
            points = buffer[after].astype(np.int64)
            points[buffer[leads] == 0xC2, 2] = 0
            codes = (points[:, 0] << 16) + (points[:, 1] << 8) + points[:, 2]
            out[leads[_WIDE[np.minimum(np.searchsorted(_WIDE, codes), len(_WIDE) - 1)] == codes]] = True
        for token in self.special:
            at = joined.find(token)
            while at >= 0:
                out[at] = True
                at = joined.find(token, at + 1)
        return out


def encoder(path: str) -> Encoder:
    """The worker's encoder for a file, loaded once."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
