import random
import re
import zlib
from collections import Counter

import pytest

from hushline.llm import spelling

SCHEMA = "doc_id long, text string"


def plain(rows):
    """The contract, word by word and pair by pair."""
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}

    def near(a, b):
        if len(a) < len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))

    forms, out = {}, {}
    for w, n in words.items():
        others = [v for v in words if near(w, v)]
        best = min(others, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best and words[best] >= 10 * n else None
        out[w] = [n, len(others), words[best] if forms[w] else None]
    for w, found in out.items():
        root = w
        while forms[root]:
            root = forms[root]
        found[:0] = [forms[w], root]
    return {w: tuple(v) for w, v in out.items()}


def ours(docs):
    rows = spelling.variants(docs).collect()
    found = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    draw = random.Random(seed)
    stems = ["".join(draw.choice("abñé") for _ in range(draw.randrange(6, 15))) for _ in range(12)]
    words = []
    for stem in stems:
        words += [stem] * draw.choice([2, 30, 400])
        for _ in range(8):
            at, kind = draw.randrange(len(stem)), draw.choice("idr")
            sign = draw.choice("abñÉ")
            other = stem[:at] + ("" if kind == "d" else sign) + stem[at + (kind != "i"):]
            words += [other] * draw.choice([1, 2, 3, 40])
    draw.shuffle(words)
    rows = [(i if i % 7 else None, " ".join(words[i * 20:(i + 1) * 20])) for i in range(len(words) // 20 + 1)]
    assert ours(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_runs_of_equal_signs_and_chains(spark):
    words = ["aaaaaaa"] * 2 + ["aaaaaaaa"] * 20 + ["aaaaaaaab"] * 200 + ["aaaabaaab"] * 2000 + ["zzzzzzz"] * 3
    rows = [(1, f"{w.upper() if i % 2 else w};") for i, w in enumerate(words)]
    found = ours(spark.createDataFrame(rows, SCHEMA))
    assert found == plain(rows)
    assert any(v[1] not in (w, v[0]) for w, v in found.items())


def test_nulls_empty_long_texts_and_clashing_columns(spark):
    long = "wordlike, wordlyke " * 100_000 + "x" * 3_000_000 + " " + "x" * 3_000_000
    rows = [(1, None), (2, ""), (None, "alphabet alphabet 東京 alphabetΔalphabet"), (3, long), (3, long), (4, "short")]
    docs = spark.createDataFrame([(*r, 1, "k", 2) for r in rows], f"{SCHEMA}, word int, key string, n int")
    found = ours(docs)
    assert {"alphabet", "wordlike"} <= {w[:8] for w in found}
    small = [(k, t) for k, t in rows if t is None or len(t) < 100]
    assert {w: v for w, v in ours(spark.createDataFrame(small, SCHEMA)).items()} == plain(small)
    assert sum(v[2] for v in found.values() if v[2] > 100) >= 400_000
    assert ours(docs.limit(0)) == {}


def test_short_words_are_refused(spark):
    with pytest.raises(ValueError):
        spelling.variants(spark.createDataFrame([], SCHEMA), least_length=3)
