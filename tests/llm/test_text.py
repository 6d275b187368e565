import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from hushline.llm.arrowtext import Hasher, WindowHasher, chunks, words

SIGNS = st.text(st.sampled_from(" \t\n\r\x0b\x0c\x1c\x85\xa0abAB日é😀"), max_size=60)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), SIGNS), max_size=6), st.integers(1, 30))
def test_words_are_those_of_bytes_split(texts, limit):
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    seen, plain, folded = [], Hasher(1), Hasher(1, fold=True)
    for chunk in chunks([batch], "text", limit):
        found, low = words(chunk, plain), words(chunk, folded)
        for i in range(len(chunk)):
            a, b = found.first[i], found.first[i + 1]
            cut = [chunk.data[s:e].tobytes() for s, e in zip(found.starts[a:b], found.ends[a:b])]
            seen.append(cut)
            assert [int(h) for h in found.hashes[a:b]] == [plain.of(w) for w in cut]
            assert [int(h) for h in low.hashes[a:b]] == [folded.of(w.lower()) for w in cut]
    assert seen == [(t or "").encode().split() for t in texts]


def test_windows_hash_equal_runs_equally_and_others_not():
    h = np.array([1, 2, 3, 1, 2, 3, 2, 1], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    got = WindowHasher(2).windows(h, np.arange(6), 3)
    assert got[0] == got[3] and len(set(got.tolist())) == 5


def test_long_word_over_many_pieces():
    text = "a" * 1_500_000 + " b"
    (chunk,) = chunks([pa.RecordBatch.from_arrays([pa.array([text])], names=["text"])], "text")
    assert words(chunk, Hasher(1)).counts.tolist() == [2]
