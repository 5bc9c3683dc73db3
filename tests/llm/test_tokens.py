"""Tokenizer operators against the tokenizers library, and packing by its invariants."""

import hashlib
import random
import time
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from cartpulse.llm import bpe, packing, token_counts
from cartpulse.llm.queries import BYTE_BPE, WORD_BPE

ALPHABET = ("abcXYZ  '''strevelmd\n\t\x0b\x1c\x1f\x85\xa0 ²½٣१ÉéßΣİſ𝐀ﬁ한글ㄱ中文​　!?#|<>😀"
            "é ")
HARD = ["", " ", "\n \n", "aaaa" * 500, "<|endoftext|>", "it's 'S we'll 'llama x''s  \n\n 's",
        "x<|endoftext|> y  <|endoftext|><|endoftext|>'s", "<|startoftext|>Á<|endoftext|",
        "ab" * 3000, "word " * 20_000]


def texts(n=300):
    chosen = random.Random(5)
    return HARD + ["".join(chosen.choice(ALPHABET) for _ in range(chosen.randint(0, 50)))
                   for _ in range(n)]


def frame(spark, rows):
    """Rows with columns whose names clash with those of the operators."""
    return spark.createDataFrame(
        [(i, t, 1, "x", True) for i, t in rows],
        "doc_id long, text string, key int, ids string, leftover boolean")


def library(file, text):
    return Tokenizer.from_file(file).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("file", [BYTE_BPE, WORD_BPE])
def test_ids_equal_the_library(file):
    tokenizer, held = Tokenizer.from_file(file), texts(2000)
    encoded = bpe.vocabulary(file).encode(held)
    for i, text in enumerate(held):
        ids = encoded.ids[encoded.bounds[i]:encoded.bounds[i + 1]].tolist()
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("file", [BYTE_BPE, WORD_BPE])
def test_every_code_point_as_the_library_has_it(file):
    """Alone, between letters, and before a mark, up to U+1FFFF and at the ends of planes."""
    tokenizer, known = Tokenizer.from_file(file), bpe.vocabulary(file)
    points = [c for c in [*range(0x20000), 0x2FFFD, 0x30000, 0x3134A, 0xE0001, 0x10FFFD]
              if not 0xD800 <= c < 0xE000]
    held = [f"a{chr(c)}b {chr(c)}\u0301 1{chr(c)}" for c in points]
    encoded = known.encode(held)
    wanted = tokenizer.encode_batch(held, add_special_tokens=False)
    wrong = [hex(c) for c, a, b, w in zip(points, encoded.bounds, encoded.bounds[1:], wanted)
             if encoded.ids[a:b].tolist() != w.ids]
    assert wrong == []


def test_very_many_special_strings_in_one_text():
    text = "x<|endoftext|>" * 60_000
    began = time.perf_counter()
    encoded = bpe.vocabulary(BYTE_BPE).encode([text])
    assert len(encoded.ids) == 120_000 and time.perf_counter() - began < 5


def test_decoding_equals_the_library_for_any_ids():
    tokenizer, known = Tokenizer.from_file(BYTE_BPE), bpe.vocabulary(BYTE_BPE)
    ids = np.random.default_rng(3).integers(0, known.size, 3000).astype(np.int32)
    bounds = np.arange(0, 3001, 3)
    for text, at in zip(known.decode(bpe.Encoded(ids, bounds)), bounds):
        assert text == tokenizer.decode(ids[at:at + 3].tolist(), skip_special_tokens=False)


def test_roundtrip_digests(spark):
    rows = [*enumerate(texts(40)), (900, None), (900, None), (None, "a b")]
    found = bpe.roundtrip_digests(frame(spark, rows), BYTE_BPE).collect()
    assert len(found) == len(rows)
    wanted = dict(rows)
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    for r in found:
        ids = library(BYTE_BPE, wanted[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_decode_of_encoded_column(spark):
    rows = frame(spark, [(1, "Ünï code\n"), (2, None)])
    back = bpe.decode(bpe.encode(rows, BYTE_BPE), BYTE_BPE).collect()
    assert {r.doc_id: r.decoded for r in back} == {1: "Ünï code\n", 2: ""}


@pytest.mark.parametrize("block", [1, 32_000_000])
def test_token_counts(spark, block):
    rows = [*enumerate(texts(60)), (900, None), (900, None), (None, "a b")]
    counted = token_counts.token_counts(frame(spark, rows), WORD_BPE, block_bytes=block)
    wanted = dict(rows)
    found = counted.collect()
    assert len(found) == len(rows)
    for r in found:
        text = wanted[r.doc_id] or ""
        assert (r.n_bytes, r.n_tokens) == (len(text.encode()), len(library(WORD_BPE, text)))


def test_over_limit_is_strict(spark):
    rows = frame(spark, [(1, "a " * 5), (2, "a " * 6)])
    found = token_counts.token_budget(rows, WORD_BPE, limit=5).collect()
    assert {r.doc_id: r.over_limit for r in found} == {1: False, 2: True}


def packed_well(rows, wanted, window):
    """Every id in one piece, no gap, no sequence beyond the window."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(wanted)
    for doc, held in by_doc.items():
        ids, at = library(WORD_BPE, wanted[doc]) + [2], 0
        for r in sorted(held, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for held in by_sequence.values():
        at = 0
        for r in sorted(held, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    return len(by_sequence)


@pytest.mark.parametrize("group", [2, 16_384])
def test_packing(spark, group):
    wanted = {i: t for i, t in enumerate(texts(150))} | {900: None}
    rows = frame(spark, wanted.items()).repartition(5)
    found = packing.pack(rows, WORD_BPE, window=64, open_windows=3, group=group).collect()
    sequences = packed_well(found, wanted, 64)
    if group > 2:
        assert sum(r.length for r in found) > 0.95 * 64 * sequences


def test_packing_keeps_repeated_rows(spark):
    rows = packing.pack(frame(spark, [(1, "a"), (1, "a")]), WORD_BPE).collect()
    assert sorted((r.start, r.length, r.offset) for r in rows) == [(0, 2, 0), (0, 2, 2)]


def test_empty_tables(spark):
    nothing = frame(spark, [(1, "a")]).limit(0)
    assert bpe.roundtrip_digests(nothing, BYTE_BPE).count() == 0
    assert token_counts.token_budget(nothing, WORD_BPE).count() == 0
    assert packing.pack(nothing, WORD_BPE).count() == 0
