"""Merging and replacing against plain Python, on random spans."""

import random
import re

from pyspark.sql import functions as F

from hushline.functions.spans import SPANS_TYPE, locate_all, merged, replaced
from hushline.rules import DEFAULT_RULES, LABEL_ORDER
from hushline.functions.text import any_of, fold, pattern


def merge(spans):
    blocks = []
    for s in sorted(spans, key=lambda s: (s[0], s[1], s[2])):
        if blocks and s[0] < max(x[1] for x in blocks[-1]):
            blocks[-1].append(s)
        else:
            blocks.append([s])
    rank = {n: i for i, n in enumerate(LABEL_ORDER)}
    out = []
    for b in blocks:
        best = min(b, key=lambda s: (s[0] - s[1], -s[4], rank.get(s[2], 99), s[2]))
        out.append((b[0][0], max(s[1] for s in b), best[2]))
    return out


def test_merge_and_replace(spark):
    rng = random.Random(11)
    text = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789" * 40
    kinds = [*LABEL_ORDER, "ZEBRA", "AARDVARK"]
    cases = []
    for i in range(300):
        spans = []
        # Few spans are merged one by one, many in parts.
        for _ in range(rng.choice([0, 1, 3, 7, 32, 33, 40, 150])):
            a = rng.randint(0, 60)
            a = a * rng.choice([1, 1, 20])
            spans.append((a, a + rng.choice([1, 2, 3, 10, 200 * (i % 3 == 0) + 1]), rng.choice(kinds), "", rng.choice([0.85, 1.0]), "d"))
        cases.append((i, text, spans))
    df = spark.createDataFrame(cases, f"i int, t string, s {SPANS_TYPE}").withColumn("b", merged(F.col("s")))
    df = df.withColumn("r", replaced(F.col("t"), F.col("b"), DEFAULT_RULES.placeholders))
    for row in df.collect():
        spans = cases[row.i][2]
        expected = merge(spans)
        assert [tuple(b) for b in row.b] == expected
        out, at = "", 0
        for start, end, label in expected:
            out += text[at:start] + DEFAULT_RULES.placeholders.get(label, "[REDACTED]")
            at = end
        assert row.r == out + text[at:]


def test_offsets_are_those_of_a_plain_search(spark):
    rng = random.Random(5)
    alphabet = ["AB", "12", " ", "  ", "\n", "\U0001F600", "é", "\x02", "7", "X"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.choice([0, 5, 30, 200, 900]))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for regex in (r"[0-9]+", r"AB", r"[A-Z0-9]+"):
        spans = locate_all(fold(F.col("t")), regex, "E", "d", 1.0)
        got = {r.i: [(s.start, s.end, s.matched) for s in r.s] for r in df.select("i", spans.alias("s")).collect()}
        for i, t in enumerate(texts):
            assert got[i] == [(m.start(), m.end(), m.group()) for m in re.finditer(regex, t)]


def test_time_grows_about_linearly_with_spans(spark):
    import time

    from hushline.operators.redaction import redact_text, turn_spans

    def seconds(n):
        df = spark.createDataFrame([("MY NUMBER IS 07912345678 " * n,)], "t string")
        found = turn_spans(F.col("t"), F.lit(1 << 8), only="phone")
        began = time.perf_counter()
        (row,) = df.select(redact_text(F.col("t"), found).alias("r"), F.size(found).alias("n")).collect()
        assert row.n == n and row.r == "MY NUMBER IS [REDACTED PHONE] " * n
        return time.perf_counter() - began

    seconds(1000)
    small, large = seconds(5000), seconds(40_000)
    assert large < 60 and large < 8 * 4 * max(small, 0.5)


def test_any_of_matches_exactly_the_words():
    words = ["SIX", "SIXTEEN", "SIXTY", "SEVEN", "I'M", "A", "AN", "AND", "E-MAIL", "C++", "x.y"]
    compiled = re.compile(any_of(words))
    for w in words:
        assert compiled.fullmatch(w)
    for w in ("SI", "SIXT", "xzy", "C+", "", "ANDY"):
        assert not compiled.fullmatch(w)
    assert pattern("a") == "(?U)a"
