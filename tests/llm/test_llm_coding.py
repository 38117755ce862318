"""Byte-level BPE and packing against the public libraries."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from episodica.llm import bpe, packing
from episodica.llm.queries import op4_byte_bpe

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
CODER = bpe.coder(RANKS, public_tokenizers.PATTERN)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=CODER.ranks, special_tokens={})
TOKENIZER = Tokenizer.from_file(VOCABULARY)
TRICKY = [
    "", " ", "  ", "a  b", " a", "a ", "a\n\nb", "a \n b", "x\n y", "\n", "\na", "a\n", " \n", "\x1c\x1d a\x1cb", "\x85x\xa0y",
    "don't I'll 'S", "日本語 текст 123 ½ ²", "👍🏽 a‍b", "　x y", "<|endoftext|> x", "a" * 5000, "é" * 300 + " é",
    "\r\n a\tb", "_ __ a_b", "\x00\x01", "ﬁ İ",
]


def ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


@pytest.mark.parametrize("text", TRICKY)
def test_tricky_texts(text):
    assert ids(CODER.words.ids(text)) == LIBRARY.encode_ordinary(text)
    assert CODER.decode(CODER.words.ids(text)) == text.encode()
    assert ids(packing._coder(VOCABULARY)(text)) == TOKENIZER.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs", "Cn"]), max_size=60) | st.text("ab \n\t'sé1.", max_size=40))
def test_any_text(text):
    assert ids(CODER.words.ids(text)) == LIBRARY.encode_ordinary(text)
    assert CODER.decode(CODER.words.ids(text)) == text.encode()
    assert ids(packing._coder(VOCABULARY)(text)) == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_query_over_documents(spark):
    got = {r.doc_id: r for r in op4_byte_bpe(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        want = np.array(LIBRARY.encode_ordinary(d.text or ""), "<u4")
        r = got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(want), hashlib.sha256(want.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()


def test_coding_keeps_columns_and_replaces_results(spark):
    df = spark.createDataFrame([(1, None, 5, "x"), (2, "ab", 6, "y")], "doc_id long, text string, ids int, decoded string")
    out = bpe.decode(bpe.encode(df, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    assert out.columns == ["doc_id", "text", "ids", "decoded"]
    assert [(bytes(r.ids) == b"", bytes(r.decoded)) for r in out.orderBy("doc_id").collect()] == [(True, b""), (False, b"ab")]
    assert bpe.encode(df.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def check_pieces(rows, docs, limits=packing.Limits()):
    """Every id lies in exactly one piece; sequences are gapless and within the limits."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == {d for d, _ in docs}
    for doc_id, text in docs:
        want = np.array([*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(want)
            assert r.ids_crc32 == zlib.crc32(want[at : at + r.length].tobytes())
            at += r.length
        assert at == len(want)
    padded = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= limits.tokens and len(pieces) <= limits.segments
        assert sum(r.loss_tokens for r in pieces) <= limits.loss_tokens
        padded += 0 if at & (at - 1) == 0 else limits.tokens - at
    return padded


def test_packing_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = [(r.doc_id, r.text) for r in df.collect()]
    assert check_pieces(packing.pack(df, VOCABULARY).collect(), docs) == 0


def test_packing_maps_added_tokens_in_texts(spark):
    plain = Tokenizer.from_file(VOCABULARY)
    end = "<|endoftext|>"
    texts = ["a <|endoftext|> b", end, end * 3, f" {end}\n\n{end} x  y", f"x{end}y", "<|endoftext|", f"é\n{end[:-1]}{end} 's", f"{end} " * 900]
    docs = list(enumerate([*texts, None, "", *TRICKY]))
    assert ids(packing._coder(VOCABULARY)(texts[0])) == [64, 220, 50256, 275]
    for _, text in docs:
        assert ids(packing._coder(VOCABULARY)(text)) == plain.encode(text or "", add_special_tokens=False).ids
    out = packing.pack(spark.createDataFrame(docs, "doc_id long, text string"), VOCABULARY).collect()
    for doc_id, text in docs:
        want = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        pieces = sorted((r for r in out if r.doc_id == doc_id), key=lambda r: r.start)
        assert sum(r.length for r in pieces) == len(want) == pieces[0].doc_tokens
        assert all(r.ids_crc32 == zlib.crc32(want[r.start : r.start + r.length].tobytes()) for r in pieces)


def test_packing_edge_cases(spark):
    docs = [(1, None), (2, ""), (3, "x" * 20_000), (4, "a b"), (5, "word " * 30_000), (6, "a b")]
    df = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, start int, prompt int").repartition(2)
    assert check_pieces(packing.pack(df, VOCABULARY).collect(), docs) == 0
    assert packing.pack(df.limit(0), VOCABULARY).count() == 0
    twice = packing.pack(df.where("doc_id = 4").union(df.where("doc_id = 4")), VOCABULARY).collect()
    assert sum(r.length for r in twice) == 2 * twice[0].doc_tokens


def test_all_limits_hold_at_once(spark):
    docs = [(i, "some words " * (i % 40)) for i in range(300)]
    limits = packing.Limits(tokens=256, segments=3, loss_tokens=100)
    df = spark.createDataFrame([(*d, (d[0] * 7) % 90) for d in docs], "doc_id long, text string, prompt_len int")
    rows = packing.pack(df, VOCABULARY, limits, open_bins=4, prompt_tokens="prompt_len").collect()
    check_pieces(rows, docs, limits)
    prompts = {i: (i * 7) % 90 for i, _ in docs}
    for r in rows:
        assert r.loss_tokens == max(0, r.start + r.length - max(r.start, prompts[r.doc_id]))
    with pytest.raises(ValueError):
        packing.pack(df, VOCABULARY, packing.Limits(tokens=0))
