"""Token detectors against plain loops over tokens, on random answers."""

import random
import re
from itertools import groupby

from pyspark.sql import functions as F

from hushline.functions.context import BIT
from hushline.operators.redaction import turn_spans
from hushline.rules import DEFAULT_RULES as R

VOCABULARY = [
    *R.number_words, *"ABCDEFGHIJ", "7", "42", "19121289", "²", "X2", "O'BRIEN", "É", "ÉCOLE", "IS", "MY", "IT'S", "AND",
    "YES", "WELL", "PLEASE", "WILL", "CLEAR", "GOOD", "JOHN", "SMITH", "ROSE", "BEESTON", "MO", "DRIVE", "THE", "I'M",
]
GAPS = [" ", " ", " ", "  ", "\n", " "]


def tokens_of(text):
    return [(m.group(), m.start(), m.end()) for m in re.finditer(r"\S+", text)]


def runs(tokens, wanted):
    """Neighbouring tokens which are all wanted."""
    return [list(g) for yes, g in groupby(tokens, key=lambda t: wanted(t[0])) if yes]


def reach(group):
    return (group[0][1], group[-1][2])


def number(w):
    return w in R.number_words


def letter(w):
    return len(w) == 1 and w.isalpha()


def content(w):
    return w not in R.filler_words and (w.isalpha() or w.isdigit() or number(w))


def expect_reference(text):
    spelled = [reach(g) for g in runs(tokens_of(text), number) if len(g) >= 5]
    return spelled + [m.span() for m in re.finditer(r"\b\d{7,}\b", text)]


def expect_location(text):
    kept = [t for t in tokens_of(text) if content(t[0])]
    return [reach(kept)] if len(kept) > 1 else []


def expect_postcode(text):
    words = [w for w, _, _ in tokens_of(text) if content(w)]
    both = any(w.isalpha() and not number(w) for w in words) and any(w.isdigit() or number(w) for w in words)
    return expect_location(text) if both else []


def expect_password(text):
    tokens = tokens_of(text)
    part = lambda w: (letter(w) or number(w) or w.isdigit()) and w not in R.deny_words
    long = [g for g in runs(tokens, part) if len(g) >= 2]
    if long:
        return [reach(long[0])]
    words = [w for w, _, _ in tokens]
    plain = [w for w in words if w not in R.deny_words]
    mixed = any(map(letter, words)) and any(number(w) or w.isdigit() for w in words)
    return [(0, len(text))] if mixed and len(words) <= 15 and len(plain) >= 0.6 * len(words) else []


def expect_person(text):
    tokens = tokens_of(text)
    places = [i for i, (w, _, _) in enumerate(tokens) if letter(w) and w not in R.deny_words]
    if len(places) >= 3 and all(b - a <= 2 for a, b in zip(places, places[1:])):
        return [(0, len(text))]
    rows = [m for m in re.finditer(r"\b[A-Z](?:\s+[A-Z]\b)+", text)]
    spelled = [m.span() for m in rows if sum(c not in R.deny_words for c in m.group().split()) >= 3]
    if spelled:
        return spelled
    barred = {*R.deny_words, *R.non_name_words}
    name = lambda w: w.isalpha() and len(w) >= 3 and w not in barred
    asked = [t for t in tokens if t[0] not in R.filler_words]
    groups = runs(asked, name)
    return [reach(groups[0])] if groups and len(groups[0]) <= 3 else []


def expect_phone(text):
    return [reach(g) for g in runs(tokens_of(text), number) if len(g) >= 9]


CHECKS = {
    "reference_number": ("reference_number", expect_reference),
    "location": ("address", expect_location),
    "postcode": ("postcode", expect_postcode),
    "password": ("password", expect_password),
    "person": ("name", expect_person),
    "phone": ("phone_number", expect_phone),
}


def answers(rng, count):
    for _ in range(count):
        # Few words at a time, so that runs and repeats happen.
        words = rng.sample(VOCABULARY, rng.randint(2, 12))
        if rng.random() < 0.3:
            words = rng.sample(R.number_words, 3)
        picked = [rng.choice(words) for _ in range(rng.randint(0, 18))]
        text = "".join(w + rng.choice(GAPS) for w in picked)
        yield text if rng.random() < 0.3 else text.strip()


def test_detectors(spark):
    texts = list(answers(random.Random(2024), 1500))
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(8)
    cols = [
        turn_spans(F.col("t"), F.lit(BIT[kind]), only=name, filtered=False).alias(name)
        for name, (kind, _) in CHECKS.items()
    ]
    wrong = []
    for row in df.select("i", "t", *cols).collect():
        for name, (_, expect) in CHECKS.items():
            got = sorted((s.start, s.end) for s in row[name])
            want = sorted(set(expect(row.t)))
            if got != want:
                wrong.append((name, row.t, got, want))
    assert wrong[:5] == [] and not wrong
