import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from hushline.llm import toxicity
from hushline.llm.arrowtext import chunks

SCHEMA = "doc_id long, text string"


def keys(rows):
    return [zlib.crc32(str(k).encode()) % 4 == 2 for k, *_ in rows]


def corpus(n, seed=1):
    draw = random.Random(seed)
    rows, marks = [], []
    for i in range(n):
        words = [f"word{draw.choice('abcdefghij')}{draw.choice('klmnop')}" for _ in range(draw.randrange(20, 80))]
        toxic = draw.random() < 0.15
        if toxic:
            for _ in range(2):
                words.insert(draw.randrange(len(words)), draw.choice(["nastyfool", "NASTYFOOL!", "vileclot", "grimlout's"]))
        rows.append((i, " ".join(words)))
        marks.append((i, int(toxic)))
    return rows, marks


@pytest.fixture(scope="module")
def result(spark):
    rows, marks = corpus(1500)
    # Labels for a part only; the others are text of any kind.
    given = [m for m in marks if m[0] % 3]
    docs, labels = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(given, "doc_id long, toxic int")
    found = {r["doc_id"]: r for r in toxicity.scored(docs, labels).collect()}
    return rows, dict(marks), given, found, docs, labels


def test_held_out_accuracy(result):
    rows, marks, _, found, *_ = result
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 for r in found.values())
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in found.values())
    assert [found[k]["held_out"] for k, _ in rows] == keys(rows)
    held = [(marks[k], r["predicted"]) for k, r in found.items() if r["held_out"]]
    caught = sum(p for m, p in held if m) / sum(m for m, _ in held)
    wrong = sum(p for m, p in held if not m) / sum(1 - m for m, _ in held)
    assert caught >= 0.95 and wrong <= 0.01


def test_held_out_labels_and_splits_change_nothing(spark, result):
    _, _, given, found, docs, _ = result
    other = [(k, 1 - m if zlib.crc32(str(k).encode()) % 4 == 2 else m) for k, m in given]
    again = toxicity.scored(docs.repartition(3), spark.createDataFrame(other, "doc_id long, toxic int")).collect()
    assert max(abs(r["score"] - found[r["doc_id"]]["score"]) for r in again) < 1e-9


def test_nulls_empty_long_texts_repeats_and_clashing_columns(spark):
    rows, marks = corpus(300)
    extra = [(None, "nastyfool you nastyfool"), (1000, None), (1001, ""), (1001, ""), (1002, "12 34 東京"), (1003, "worda " * 400_000 + "nastyfool vileclot")]
    docs = spark.createDataFrame([(*r, 1, "b", 0.5) for r in rows + extra], f"{SCHEMA}, toxic int, mark string, score double")
    labels = spark.createDataFrame([*marks, (None, 1), (5, None), (marks[0][0], 1 - marks[0][1])], "doc_id long, toxic int")
    out = toxicity.scored(docs, labels).collect()
    assert len(out) == len(rows + extra)
    empty = [r["score"] for r in out if r["doc_id"] in (1000, 1001)]
    assert len(empty) == 3 and len(set(empty)) == 1 and empty[0] < 0.3
    assert toxicity.scored(docs.limit(0), labels).collect() == []
    nobody = toxicity.scored(docs, labels.limit(0)).collect()
    assert {r["score"] for r in nobody} == {0.5}


def test_features_are_words_and_beginnings_with_any_capitals():
    def of(*texts):
        (chunk,) = chunks([pa.record_batch({"t": pa.array(texts)})], "t")
        owner, feature = toxicity._distinct(*toxicity.features(chunk))
        return [set(feature[owner == i].tolist()) for i in range(len(texts))]

    a, b, c, d = of("Élan, ABCDEFGHIJ", "élan abcdefghij", "", "abcdefghi")
    assert a == b and not c and len(a) == 6
    assert len(a & d) == len(toxicity.PREFIXES)


def test_the_risk_is_not_followed_below_zero():
    draw = np.random.default_rng(1)
    positive = [(np.array([0, 2 + draw.integers(20)]), np.ones(2), 1) for _ in range(40)]
    negative = [(np.array([1, 2 + draw.integers(20)]), np.ones(2), 1) for _ in range(160)]
    model = toxicity.fit(positive, positive + negative, 22, 0.2, 0)
    margin = lambda d: model.weights[d[0]] @ d[1] + model.bias
    assert min(map(margin, positive)) > 0 > max(map(margin, negative))
