import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from hushline.llm import bpe, token_counts

RANKS, WORDS = P.path("byte_bpe_multi_50k.tiktoken"), P.path("word_bpe_49k.json")
TEXTS = [
    None, "", " ", "a", "a" * 5000, "don't we'll  HE'S\n\n\tx", "日本語のテキスト ¡¿ ́á 😀👨‍👩 İΣς ΟΔΟΣ", "!?" * 200 + "   x",
    "\x00\x1c\x85 12345 ²³", "<|startoftext|> a <|endoftext|>b<|endoftext|>", "<|endoftext", "é Å ﬁ",
]
SIGNS = st.text(max_size=80)


@pytest.fixture(scope="module")
def codec():
    with open(RANKS, "rb") as f:
        return bpe.Codec(f.read(), P.PATTERN)


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as f:
        ranks = bpe.read_ranks(f.read())
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(SIGNS)
def test_encoding_equals_the_library(codec, library, text):
    ids = codec.encode(text)
    assert ids.tolist() == library.encode_ordinary(text)
    assert "".join(codec.decode(ids)) == text


@given(st.binary(max_size=40))
@settings(max_examples=200, deadline=None)
def test_transducer_equals_plain_merging_also_when_tables_are_dropped(piece):
    ranks = {bytes([b]): b for b in range(256)}
    for k, t in enumerate([b"ab", b"abc", b"bc", b"aa", b"aaaa", b"ca", b"cab", b"\x00\x01", b"abcab"]):
        ranks[t] = 256 + k
    piece = bytes(b"abc\x00\x01"[b % 5] for b in piece)
    for states in (100, 3):
        machine = bpe.Transducer(ranks, states=states)
        want = [ranks[piece]] if piece in ranks else machine.merged(piece) if piece else []
        assert machine.encode(piece) == want and machine.encode(piece) == want


@given(st.lists(st.binary(max_size=6), max_size=8), SIGNS, st.integers(1, 5))
@settings(max_examples=300, deadline=None)
def test_utf8_stream_gives_whole_decoding(parts, text, step):
    whole = text.encode()
    for pieces in (parts, [whole[i:i + step] for i in range(0, len(whole), step)]):
        stream = bpe.Utf8Stream()
        got = "".join(stream.feed(p) for p in pieces) + stream.finish()
        assert got == b"".join(pieces).decode("utf-8", "replace")


def test_round_trip_and_columns(spark, library):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "x y"), (3, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, bpe.round_trip(docs, RANKS, P.PATTERN).collect()), key=str)
    want = []
    for key, text in rows:
        ids = library.encode_ordinary(text or "")
        want.append((key, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    clash = docs.selectExpr("doc_id", "text", "1 AS ids")
    coded = bpe.encoded(clash, RANKS, P.PATTERN)
    assert coded.columns == ["doc_id", "ids", "ids_"]
    back = bpe.decoded(coded, RANKS, P.PATTERN, ids="ids_")
    assert sorted(map(str, (r["text"] for r in back.collect()))) == sorted((t or "") for _, t in rows)
    assert bpe.round_trip(docs.limit(0), RANKS, P.PATTERN).collect() == []


@settings(max_examples=200, deadline=None)
@given(SIGNS)
def test_counts_equal_the_library(text):
    assert _counter().count(text) == len(_tokenizer().encode(text, add_special_tokens=False).ids)


_kept = {}


def _counter():
    if "c" not in _kept:
        with open(WORDS, "rb") as f:
            _kept["c"] = token_counts.Counter(f.read(), remembered=50)
    return _kept["c"]


def _tokenizer():
    if "t" not in _kept:
        _kept["t"] = Tokenizer.from_file(WORDS)
    return _kept["t"]


def test_counting_rows(spark):
    rows = [(i, t, 1) for i, t in enumerate(TEXTS)] + [(None, "x y", 2), (3, "a", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = token_counts.with_token_counts(docs, WORDS, limit=3)
    assert got.columns == ["doc_id", "text", "n_tokens", "n_bytes", "n_tokens_", "over_limit"]
    for r in got.collect():
        n = len(_tokenizer().encode(r["text"] or "", add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens_"], r["over_limit"]) == (len((r["text"] or "").encode()), n, n > 3)
    assert token_counts.with_token_counts(docs.limit(0), WORDS).collect() == []
