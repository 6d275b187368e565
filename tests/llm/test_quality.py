import brute
from hushline.llm import quality

TEXTS = [
    None, "", " \n\t", "one two three", "a b c d e f g h i j", "same line here\nsame line here\nother\n \n\n", "x y z v w " * 10,
    "é😀 日本 # * $ a|b <c> % & " * 3, "A\nA\nA\nB\n" * 5, "SHOUT!! LOUD!! " + "NOW!! " * 20, "aa aa bb bb cc cc dd dd ee ee ff ff", "w " * 20000,
]


def test_base_measures_equal_plain_counting(spark, prose):
    texts = TEXTS + [prose(i, 60 * i, 30) for i in range(8)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, "x"), (3, "x")], "doc_id long, text string")
    rows = quality.verdicts(quality.ledger(docs)).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        text = "x" if r["doc_id"] is None or (r["doc_id"] == 3 and r["n_words"] == 1) else texts[r["doc_id"]]
        got = tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))
        assert got == brute.quality(text)
        assert not (r["kept"] and r["base_failed"])
    assert quality.ledger(docs.limit(0)).collect() == []


def test_policies_and_ablations_are_bits(spark):
    ledger = spark.createDataFrame([(f,) for f in [0, 0, 1, 2, 3, 4, 4, 12, 32, 96]], "failed long")
    kept = {v: quality.verdicts(ledger, v).where("kept").count() for v in quality.POLICIES}
    assert kept == {"v1": 7, "v2": 2}
    got = {r["rule"]: (r["n_failed"], r["n_only_this"], r["n_documents"]) for r in quality.ablations(ledger, "v2").collect()}
    assert got["symbols"] == (3, 2, 10) and got["few_words"] == (2, 1, 10) and got["capitals"] == (2, 1, 10)
    assert {r["rule"]: r["n_only_this"] for r in quality.ablations(ledger, "v1").collect()} == {"few_words": 1, "repeated_windows": 1}


def test_good_documents_stay_as_they_are(spark, prose):
    good = [(i, prose(i, 40 + i), "n") for i in range(20)] + [(3, prose(3, 43), "n"), (None, prose(50, 30), None)]
    bad = [(100 + i, t, "b") for i, t in enumerate(TEXTS[:4] + TEXTS[6:12])]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string, n_words string")
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, (tuple(r) for r in kept.collect()))) == sorted(map(str, good))
