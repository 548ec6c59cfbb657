"""Token blocks, their files, and packing: exact round trips."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tripline.llm import packing, token_blocks, token_files, tokens
from tripline.llm.queries import QUERIES
from tripline.sources.session import scratch

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = ["", "  ", "a\x1cb c", "É é ΑΣ x", "<|startoftext|>a <|endoftext|>", "日本 ‘x’",
       "don't I'LL 123 4,5!!", "İstanbul ﬁ Ǆ", "é ́ a", "\x85\xa0a", "\x00b", "a" * 9000,
       "a's 's 'S 'lla 'reé x''t _a__b- 1,23.4'd", "Straße ÀÖ×÷ØÞßàÿ", "a\x0bb\x0cc\rd", "!!?? !"]


def crc(ids) -> int:
    return zlib.crc32(np.asarray(ids, dtype="<u4").tobytes())


@pytest.mark.parametrize("text", ODD)
def test_encoders_equal_the_library(text):
    for encode in (tokens.word_encoder(WORD), tokens.byte_encoder(BYTE, RANKS)):
        assert encode(text).tolist() == encode.library.encode(text, add_special_tokens=False).ids


def test_encoders_equal_the_library_on_every_text(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    for encode in (tokens.word_encoder(WORD), tokens.byte_encoder(BYTE, RANKS)):
        want = encode.library.encode_batch([r.text for r in rows], add_special_tokens=False)
        assert all(encode(r.text).tolist() == w.ids for r, w in zip(rows, want))
    assert tokens.word_encoder(WORD).merged is not None


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, token_blocks.MOST_IDS - 1), max_size=400))
def test_block_round_trip(ids):
    assert token_blocks.decode(token_blocks.encode(np.array(ids, dtype=np.uint32))).tolist() == ids


@pytest.mark.parametrize("count", [1, 4095, 4096, 70_001, 300_000])
def test_block_round_trip_large(count):
    rng = np.random.default_rng(count)
    for ids in (np.zeros(count), rng.integers(0, 3, count), rng.integers(0, 49_408, count),
                np.minimum(rng.zipf(1.2, count), 49_407)):
        block = token_blocks.encode(ids)
        assert np.array_equal(token_blocks.decode(block), ids)
    assert len(token_blocks.encode(np.zeros(count))) < count // 8 + 3000


def test_contexts_pay():
    """A sequence that repeats codes far below its order-0 entropy (10 bits an id)."""
    ids = np.tile(np.random.default_rng(1).permutation(1000), 300)
    assert len(token_blocks.encode(ids)) < len(ids) / 2


def test_damage_is_found():
    block = bytearray(token_blocks.encode(np.arange(500)))
    for at in (0, 9, 40, len(block) - 1):
        bad = bytearray(block)
        bad[at] ^= 1
        with pytest.raises(token_blocks.Corrupt):
            token_blocks.decode(bytes(bad))
    with pytest.raises(token_blocks.Corrupt):
        token_blocks.decode(bytes(block[:-5]))
    with pytest.raises(ValueError):
        token_blocks.encode(np.array([token_blocks.MOST_IDS]))


def expected(rows, path, end):
    library = Tokenizer.from_file(path)
    return [(i, library.encode(t or "", add_special_tokens=False).ids + [end]) for i, t in rows]


def test_files_hold_every_id(spark, sf_dir):
    rows = sorted((r.doc_id, r.text) for r in
                  spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    got = {r.doc_id: r for r in QUERIES["op5_token_blocks"](spark, sf_dir).collect()}
    at = 0
    for doc_id, ids in expected(rows, WORD, 2):
        r = got[doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), crc(ids))
        at += len(ids)


def test_files_edges(spark, edges, edge_rows, nothing):
    path = scratch(spark, "test-blocks")
    token_files.write(edges, path, WORD, 2, block_ids=300)
    rows = token_files.read(spark, path).collect()
    got = sorted((r.doc_id is not None, r.doc_id or 0, crc(r.ids)) for r in rows)
    assert got == sorted((i is not None, i or 0, crc(ids))
                         for i, ids in expected(edge_rows, WORD, 2))
    order = sorted(rows, key=lambda r: r.start)
    ids = [r.doc_id or 0 for r in order]
    assert ids == sorted(ids)
    assert [r.start for r in order] == np.cumsum([0] + [len(r.ids) for r in order])[:-1].tolist()
    empty = scratch(spark, "test-blocks")
    token_files.write(nothing, empty, WORD, 2)
    assert token_files.digest(spark, empty).count() == 0


def check_pieces(rows, wanted, length=2048):
    whole, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        whole[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for doc_id, ids in wanted:
        at = 0
        for r in sorted(whole[doc_id], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == crc(ids[at:at + r.length])
            at += r.length
        assert at == len(ids)
    padding = 0
    for places in sequences.values():
        at = 0
        for offset, size in sorted(places):
            assert offset == at
            at += size
        assert at <= length
        padding += 0 if at & (at - 1) == 0 else length - at
    return padding / sum(r.length for r in rows)


def test_packing_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in
            spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = QUERIES["op7_packing"](spark, sf_dir).collect()
    assert check_pieces(rows, expected(docs, BYTE, 1)) < 0.02


def test_packing_edges(spark, edges, edge_rows, nothing):
    rows = packing.pieces(edges, BYTE, RANKS, 1, group=4).collect()
    once = [(i, t) for i, t in edge_rows if i not in (None, 4)]
    check_pieces(rows, expected(once, BYTE, 1))
    total = sum(len(ids) for _, ids in expected(edge_rows, BYTE, 1))
    assert sum(r.length for r in rows) == total
    assert sum(r.start == 0 for r in rows) == len(edge_rows)
    assert packing.pieces(nothing, BYTE, RANKS, 1).count() == 0


def test_tournament_is_first_fit():
    rng = np.random.default_rng(3)
    totals = rng.integers(1, 6000, 500).tolist()
    got = packing.pack(totals)
    bins: list[int] = []
    for doc, start, size, into, offset in sorted(got, key=lambda p: (-p[2], p[0], p[1])):
        first = next((i for i, used in enumerate(bins) if used + size <= 2048), len(bins))
        if first == len(bins):
            bins.append(0)
        assert (into, offset) == (first, bins[first])
        bins[first] += size
