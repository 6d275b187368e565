import math
import zlib
from collections import Counter

import brute
import numpy as np
import pytest

from hushline.llm import lm


def plain(docs):
    tokens = [brute.WORD.findall((t or "").translate(brute.FOLD)) + [None] for _, t in docs]
    held = [zlib.crc32(("" if k is None else str(k)).encode()) % 7 == 2 for k, _ in docs]
    c = Counter(w for ws, h in zip(tokens, held) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    return [
        (k, h, len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws))
        for (k, _), ws, h in zip(docs, tokens, held)
    ]


@pytest.mark.parametrize("known", [300_000, 20])
def test_base_scores_equal_plain_counting(spark, prose, monkeypatch, known):
    monkeypatch.setattr(lm, "KNOWN", known)
    docs = [(i, prose(i, 3 * i, 30 + i)) for i in range(60)] + [(70, None), (71, ""), (None, "A b"), (5, prose(5, 15, 35)), (72, "ünseen ÉÉ a")]
    got = lm.scored(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    key = lambda r: (str(r[0]), r[2], r[5])
    got, want = sorted(map(tuple, got), key=key), sorted(plain(docs), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(abs(g[5] - w[5]) < 1e-6 and math.isfinite(g[6]) and g[6] < 0 for g, w in zip(got, want))
    assert lm.scored(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_model_beats_the_base_on_held_out_text(spark):
    # Words follow one another in a cycle with noise, which counts alone can't know.
    draw = np.random.default_rng(2)
    def text():
        at, out = draw.integers(20), []
        for _ in range(400):
            at = (at + 1) % 20 if draw.random() < 0.9 else draw.integers(20)
            out.append(f"w{at}")
        return " ".join(out)

    docs = spark.createDataFrame([(i, text()) for i in range(600)], "doc_id long, text string")
    rows = lm.scored(docs).where("held_out").collect()
    assert len(rows) > 40
    assert sum(r["score"] for r in rows) > 0.8 * sum(r["base_score"] for r in rows)


def made(own=30, buckets=4, seen=200, seed=1):
    """Counts of `seen` words, of which `own` are units."""
    draw = np.random.default_rng(seed)
    hashes = np.sort(draw.choice(1 << 62, seen, replace=False).astype(np.uint64))
    n = draw.integers(1, 100, seen)
    top = np.sort(np.argsort(-n, kind="stable")[:own])
    rest = np.setdiff1d(np.arange(seen), top)
    masses = np.ones(buckets)
    np.add.at(masses, lm.bucket_of(hashes[rest], buckets), n[rest] + 1)
    return lm.Counts.of(hashes, n, hashes[top], n[top] + 1, masses, 40)


def test_probabilities_sum_to_one_over_all_words():
    counts, draw = made(), np.random.default_rng(3)
    model = lm.Model(counts.masses)
    for part in model.parts():
        part += draw.standard_normal(part.shape).astype(np.float32)
    context = draw.integers(0, counts.begin + 1, (7, lm.CONTEXT))
    words = np.append(counts.hashes, lm.END)
    unit, shared = counts.numbers(words)
    n = np.append(counts.counts, 0)
    assert shared.sum() == 170 and len(counts.masses) == 35
    for c in context:
        log = model.log_probabilities(model.by_place(), np.tile(c, (len(words), 1)), unit)
        p = np.exp(log) * np.where(shared, (n + 1) / counts.masses[unit], 1)
        # What is left is the share of words never seen in each shared unit.
        unseen = counts.bucket_numbers
        log = model.log_probabilities(model.by_place(), np.tile(c, (len(unseen), 1)), unseen)
        assert abs(p.sum() + (np.exp(log) / counts.masses[unseen]).sum() - 1) < 1e-5


@pytest.mark.parametrize("scale", [1, 60])
def test_normalised_equals_plain_arithmetic(scale):
    draw = np.random.default_rng(4)
    vector, table = draw.standard_normal((50, 25)).astype(np.float32), scale * draw.standard_normal((30, 25)).astype(np.float32)
    chosen = draw.integers(0, 30, 50)
    scores = vector.astype(float) @ table.T.astype(float)
    top = scores.max(axis=1)
    want = scores[np.arange(50), chosen] - top - np.log(np.exp(scores - top[:, None]).sum(axis=1))
    assert np.allclose(lm._normalised(vector, table, chosen), want, atol=1e-3, rtol=1e-4)


def test_an_untrained_model_is_the_smoothed_counts():
    counts = made()
    model = lm.Model(counts.masses)
    unit = np.arange(len(counts.masses))
    log = model.log_probabilities(model.by_place(), np.full((len(unit), lm.CONTEXT), counts.begin), unit)
    assert np.allclose(np.exp(log), counts.masses / counts.masses.sum(), rtol=1e-4)


def test_splits_do_not_change_the_model(spark, prose, monkeypatch):
    monkeypatch.setattr(lm, "SHARD_TOKENS", 3000)
    rows = [(i, prose(i, 40 + i, 60)) for i in range(150)] + [(None, "a b a"), (None, "a b a"), (7, None)]
    got = []
    for splits in (1, 8):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(splits)
        got.append(sorted((str(r["doc_id"]), r["n_tokens"], r["score"]) for r in lm.scored(df).collect()))
    assert [g[:2] for g in got[0]] == [g[:2] for g in got[1]]
    assert all(abs(a[2] - b[2]) < 1e-6 * abs(a[2]) for a, b in zip(*got))


def test_units_grow_with_the_corpus(spark, prose):
    def units(n):
        docs = spark.createDataFrame([(prose(i, 400, 100 + 20 * n),) for i in range(n)], "text string")
        counts = lm.token_counts(docs)
        return lm.frequent(counts, counts.count())
    small, large = units(5), units(60)
    assert len(large.own) > 4 * len(small.own) and len(large.bucket_numbers) > len(small.bucket_numbers)


def test_very_long_text_and_clashing_columns(spark, prose):
    rows = [(1, prose(1, 60_000, 300), "x", 1, 2.0, 3), (3, "a", "y", 1, 2.0, 3), (5, "", "z", 1, 2.0, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string, row int, score double, shard int")
    got = {r["doc_id"]: r for r in lm.scored(docs).collect()}
    assert got[1]["n_tokens"] == 60_001 and got[3]["n_tokens"] == 2 and got[5]["n_tokens"] == 1
    assert all(math.isfinite(r["score"]) for r in got.values())


def test_contexts_do_not_cross_texts():
    counts = made()
    got = counts.contexts(np.array([5, 6, 7, 8, 9]), np.array([0, 3, 4, 5]))
    b = counts.begin
    assert got.tolist() == [[b, b, b], [5, b, b], [6, 5, b], [b, b, b], [b, b, b]]


def test_pieces_do_not_depend_on_batches(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(lm, "PIECE", 16)
    counts = made()
    texts = [" ".join(f"w{j}" for j in range(i % 23)) for i in range(60)]
    table = pa.table({"text": texts, "shard": pa.array([0] * 25 + [2] * 35, pa.int32())})
    cut = [[(s, c.tolist(), u.tolist()) for s, c, u in lm._pieces(counts, table.to_batches(max_chunksize=n))] for n in (60, 7, 1)]
    assert cut[0] == cut[1] == cut[2]
    assert sum(len(u) for _, _, u in cut[0]) == sum(i % 23 for i in range(60)) + 60 and all(len(u) <= 16 for _, _, u in cut[0])
