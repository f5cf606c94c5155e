from __future__ import annotations

import zlib

import numpy as np
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st

from metroscope.llm.bitplanes import read_digests, read_documents, restored, shuffled, write_blocks
from metroscope.llm.packing import SCHEMA, deal, pack, packed
from metroscope.llm.tokens import Encoder, vocabulary

from . import awkward

NAMES = ("byte_bpe_50k.json", "word_bpe_49k.json")
ENCODERS = {name: Encoder(vocabulary(name)) for name in NAMES}
PARTS = st.sampled_from(["a", "Ab", "Σας", "ÉTÉ", "é", "İx", "don't", "it's,", "12,", "x.", "..", "\n", "\n\n", " ", "  ", "\t", "\xa0", "\x1c", " ", "漢字", "\U0001f600",
                         "<|endoftext|>", "<|startoftext|>", "a<|endoftext|>,", "###", "l’été.", "ﬁ", "ǅ", "ª", "ß"])


@pytest.mark.parametrize("name", NAMES)
@settings(max_examples=400, deadline=None)
@given(st.one_of(st.lists(PARTS, max_size=12).map("".join), st.lists(PARTS, max_size=12).map(" ".join), st.text(max_size=40)))
@example("a  <|endoftext|> b")
def test_ids_equal_the_library(name, text):
    encoder = ENCODERS[name]
    assert encoder.ids(text) == encoder.whole(text) if text else encoder.ids(text) == b""


def library(name, rows, end):
    tokenizer = ENCODERS[name].library
    return [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [end], dtype="<u4") for t in rows]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 3000), max_size=60))
@example([1024, 2048, 512, 256, 1])
@example([700])
def test_packing_covers_every_token_once(lengths):
    sequences = pack(lengths)
    seen = [np.zeros(n, dtype=int) for n in lengths]
    padding = 0
    for window, pieces in sequences:
        size = sum(p[2] for p in pieces)
        assert 0 < size <= window and all(p[2] > 0 for p in pieces)
        padding += size != window
        for doc, start, n in pieces:
            seen[doc][start : start + n] += 1
    assert all((s == 1).all() for s in seen) and padding <= 1
    groups = deal(sequences, 2048)
    for window in {w for w, _ in sequences}:
        sizes = np.bincount([g for (w, _), g in zip(sequences, groups) if w == window], minlength=max(groups) + 1)
        assert sizes.max() - sizes.min() <= 1


def test_packed_documents(spark):
    rows = awkward.documents()
    found = packed(awkward.frame(spark).repartition(3), vocabulary(NAMES[0]), 0, chunk_tokens=3000).collect()
    ids = {}
    for r, own in zip(rows, library(NAMES[0], [r[1] for r in rows], 0)):
        ids.setdefault(r[0], []).append(own)
    sequences, tokens = {}, 0
    for r in found:
        assert any(len(own) == r["doc_tokens"] and zlib.crc32(own[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"] for own in ids[r["doc_id"]])
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"], r["window"]))
        tokens += r["length"]
    assert tokens == sum(len(own) for group in ids.values() for own in group)
    for pieces in sequences.values():
        at = 0
        for offset, length, window in sorted(pieces):
            assert offset == at
            at += length
        assert at <= window
    empty = packed(awkward.empty(spark), vocabulary(NAMES[0]))
    assert empty.count() == 0 and empty.columns == [x.split()[0] for x in SCHEMA.split(", ")]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 49_407), st.integers(0, 2**32 - 1)), max_size=200))
def test_planes_restore_the_ids(ids):
    ids = np.array(ids, dtype="<u4")
    sizes, payload = shuffled(ids)
    assert len(sizes) == (max(1, int(ids.max()).bit_length()) if len(ids) else 0)
    assert (restored(len(ids), sizes, payload) == ids).all()


@pytest.mark.parametrize("block", [7, 1 << 16])
def test_blocks_round_trip(spark, monkeypatch, block):
    monkeypatch.setattr("metroscope.llm.bitplanes.SHARD_CHARS", 60_000)
    # Texts of one doc_id come in an order of their own, so only their ids are compared.
    rows = [r for r in awkward.documents() if r[0] not in (None, 401)]
    if block == 7:
        rows = [r for r in rows if r[1] is None or len(r[1]) < 5000]
    blocks = write_blocks(awkward.frame(spark, rows), vocabulary(NAMES[1]), 2, block)
    rows.sort(key=lambda r: r[0])
    want, at = [], 0
    for r, own in zip(rows, library(NAMES[1], [r[1] for r in rows], 2)):
        want.append((r[0], at, len(own), own.tobytes()))
        at += len(own)
    found = sorted((r["doc_id"], r["start"], r["n_tokens"], bytes(r["ids"])) for r in read_documents(blocks).collect())
    assert found == want
    digests = sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in read_digests(blocks).collect())
    assert digests == [(i, s, n, zlib.crc32(own)) for i, s, n, own in want]


def test_blocks_of_nulls_and_nothing(spark):
    rows = [(None, "first", *[None] * 16), (None, None, *[None] * 16), (3, None, *[None] * 16)]
    found = read_digests(write_blocks(awkward.frame(spark, rows), vocabulary(NAMES[1]), 2)).collect()
    assert [r["doc_id"] for r in sorted(found, key=lambda r: r["start"])] == [None, None, 3]
    assert read_digests(write_blocks(awkward.empty(spark), vocabulary(NAMES[1]), 2)).count() == 0
