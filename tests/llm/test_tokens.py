"""Token ids against the library, packing, token files, and sampled pieces."""

import collections
import itertools
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from seekloom.llm import packing, piece_sampling, token_files, tokens
from seekloom.llm.hashing import mix
from seekloom.llm.queries import PIECES, TOKENIZER

library = Tokenizer.from_file(TOKENIZER)


def ids_of(text):
    return library.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab'sEé ß\n\t\r.,!1²_\x00\x1c\x85 　日▁😀-|"), max_size=30), max_size=5))
def test_encoder_equals_library(texts):
    own = tokens.Encoder(TOKENIZER) if not texts else tokens.encoder(TOKENIZER)
    assert [a.tolist() for a in own.encode(texts)] == [ids_of(t) for t in texts]


def test_encoder_on_documents(documents):
    texts = [r.text for r in documents.collect()] + ["a <|endoftext|>b", "it's  we'll", ""]
    assert [a.tolist() for a in tokens.encoder(TOKENIZER).encode(texts)] == [ids_of(t) for t in texts]


def test_encoder_forgets(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    own = tokens.Encoder(TOKENIZER)
    for text in ("one two three four", "five six", "one seven"):
        assert own.encode([text])[0].tolist() == ids_of(text)


def check_pieces(rows, texts, max_tokens, min_piece):
    """Every id in exactly one piece, sequences without gaps, little padding."""
    wanted = collections.Counter((d, tuple([*ids_of(t), 1])) for d, t in texts)
    by_document = collections.defaultdict(list)
    for r in rows:
        by_document[r.doc_id].append(r)
    found = []
    for doc_id, pieces in by_document.items():
        copies = collections.defaultdict(list)
        for r in sorted(pieces, key=lambda r: r.start):
            assert len(r.ids) == 4 * r.length
            # Rows of one id are told apart by their lengths and ids here.
            chain = next((c for n, chains in copies.items() for c in chains if n == r.doc_tokens and sum(len(x) for x in c) == r.start), None)
            if r.start == 0:
                chain = []
                copies[r.doc_tokens].append(chain)
            chain.append(np.frombuffer(r.ids, "<u4").tolist())
        found += [(doc_id, tuple(itertools.chain.from_iterable(c))) for chains in copies.values() for c in chains]
    assert sum(len(i) for _, i in found) == sum(len(i) * n for (_, i), n in wanted.items())
    singles = {d for (d, _), n in wanted.items() if sum(m for (e, _), m in wanted.items() if e == d) == 1}
    assert {f for f in found if f[0] in singles} == {w for w in wanted if w[0] in singles}
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
    short = 0
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= max_tokens
        short += at <= max_tokens - min_piece
    assert short <= 1


@pytest.mark.parametrize(("max_tokens", "windows", "parts"), [(2048, 64, 3), (64, 2, 130)])
def test_packing(edges, documents, max_tokens, windows, parts):
    frame = edges.select("doc_id", "text", "group").unionByName(documents.select("doc_id", "text").limit(60), allowMissingColumns=True)
    frame = frame.where("doc_id is null or doc_id > 13 or doc_id not in (9, 10)").repartition(parts)
    rows = packing.pack_documents(frame, TOKENIZER, max_tokens, open_windows=windows, min_piece=8).collect()
    check_pieces(rows, [(r.doc_id, r.text) for r in frame.collect()], max_tokens, 8)


def test_packing_of_nothing(nothing):
    assert packing.pack_documents(nothing, TOKENIZER).collect() == []


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_files_round_trip(spark, edges, documents, tmp_path, encoding):
    frame = edges.select("doc_id", "text", "tie", "file", "at").unionByName(documents.select("doc_id", "text"), allowMissingColumns=True)
    path = str(tmp_path / "tokens")
    token_files.write_token_files(frame, path, TOKENIZER, encoding=encoding, row_group_bytes=64 * 1024)
    read = token_files.read_token_files(spark, path)
    expected = collections.Counter((r.doc_id, tuple([*ids_of(r.text), 0])) for r in frame.collect())
    assert collections.Counter((r.doc_id, tuple(r.tokens)) for r in read.collect()) == expected
    digests = token_files.token_digests(read).collect()
    at = 0
    for r in sorted(digests, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    assert at == sum(len(i) * n for (_, i), n in expected.items())
    ids = [r.doc_id for r in sorted(digests, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    sums = collections.Counter((d, zlib.crc32(np.array(i, "<u4").tobytes())) for (d, i), n in expected.items() for _ in range(n))
    assert collections.Counter((r.doc_id, r.ids_crc32) for r in digests) == sums


def test_token_files_are_indexed_and_coded(documents, tmp_path):
    frame = documents.unionByName(documents).unionByName(documents)
    for encoding, wanted in (("dictionary", "DICTIONARY"), ("delta", "DELTA_BINARY_PACKED")):
        path = tmp_path / encoding
        token_files.write_token_files(frame, str(path), TOKENIZER, encoding=encoding)
        chunks = [pq.ParquetFile(f).metadata.row_group(0).column(2) for f in path.glob("*.parquet")]
        assert any(wanted in e for c in chunks for e in c.encodings)
        assert all(c.has_column_index or c.has_offset_index for c in chunks)


def test_token_files_of_nothing(spark, nothing, tmp_path):
    path = str(tmp_path / "tokens")
    token_files.write_token_files(nothing, path, TOKENIZER)
    assert token_files.token_digests(token_files.read_token_files(spark, path)).collect() == []


def test_unknown_encoding(nothing):
    with pytest.raises(ValueError, match="encoding"):
        token_files.write_token_files(nothing, "x", TOKENIZER, encoding="plain")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab cé\n\t▁日😀the on"), max_size=40), min_size=1, max_size=4))
def test_pieces_decode_to_the_text(texts):
    own = piece_sampling.vocabulary(PIECES, 1.0)
    found = piece_sampling.sample_pieces(texts, list(range(len(texts))), own)
    assert [piece_sampling.decode_pieces(a, own) for a in found] == texts


def test_pieces_are_drawn_by_weight():
    """All segmentations of a word, with the product of their weights, against many draws."""
    own = piece_sampling.vocabulary(PIECES, 0.5)
    weights = {own.data[i].decode(): (int(i), float(w)) for i, w in zip(own.ids, own.logs, strict=True)}

    def segmentations(word):
        if not word:
            yield ()
        for n in range(1, len(word) + 1):
            if word[:n] in weights:
                for rest in segmentations(word[n:]):
                    yield (word[:n], *rest)

    paths = list(segmentations(" other"))
    chances = np.exp([sum(weights[p][1] for p in path) for path in paths])
    expected = {tuple(weights[p][0] for p in path): c for path, c in zip(paths, chances / chances.sum(), strict=True)}
    drawn = collections.Counter(tuple(a.tolist()) for a in piece_sampling.sample_pieces(["other"] * 30_000, list(range(30_000)), own))
    assert set(drawn) <= set(expected)
    assert sum(abs(drawn[p] / 30_000 - c) for p, c in expected.items()) < 0.05


def test_sampled_pieces_depend_on_key_and_seed_alone(edges, documents):
    frame = edges.select("doc_id", "text", "key").unionByName(documents.select("doc_id", "text"), allowMissingColumns=True)
    rows = lambda parts, seed: collections.Counter((r.doc_id, r.n_chars, tuple(r.ids)) for r in piece_sampling.encode_sampled(frame.repartition(parts), PIECES, seed=seed).collect())
    first = rows(2, 0)
    assert first == rows(7, 0) != rows(2, 1)
    digests = piece_sampling.encode_sampled(frame, PIECES, digests=True).collect()
    assert all(r.lossless for r in digests)
    sums = {(d, zlib.crc32(np.array(i, "<u4").tobytes())) for d, _, i in first}
    assert {(r.doc_id, r.ids_crc32) for r in digests} == sums
    assert {(r.doc_id, r.n_pieces) for r in digests} == {(d, len(i)) for d, _, i in first}


def test_sampled_pieces_of_nothing(nothing):
    assert piece_sampling.encode_sampled(nothing, PIECES).collect() == []


def test_known_words_grow():
    """The table is small for few words; words are found after it has grown and after some were forgotten."""
    known = tokens.KnownWords(40_000)
    assert known.slots.nbytes < 2**16
    hashes = mix(np.arange(60_000, dtype=np.uint64))
    for part in np.array_split(hashes, 7):
        assert (known.find(part) < 0).all()
        known.add(part, np.arange(2 * len(part)), np.full(len(part), 2))
    assert known.find(hashes).tolist() == list(range(60_000))
    assert len(known.slots) >= 4 * known.count
    known.hits[20_000:60_000] = 2
    known.forget()
    assert (known.find(hashes[20_000:40_000]) >= 0).all() and known.count == 20_000
