"""Worked examples: what a turn becomes after the turn before it, traced by hand."""

import pytest
from pyspark.sql import functions as F

from hushline.functions.context import BIT
from hushline.functions.text import fold
from hushline.operators.redaction import redact_text, redact_transcripts, turn_spans
from hushline.operators.registry import register, unregister
from hushline.functions.spans import locate_all
from hushline.rules import DEFAULT_RULES
from hushline.sources.transcripts import parse_transcripts

import json

TALKS = [
    ("CAN I HAVE YOUR REFERENCE NUMBER PLEASE", "YES IT'S ONE NINE ONE TWO ONE TWO EIGHT NINE", "YES IT'S [REDACTED REFERENCE]"),
    ("WHAT ARE THE LAST TWO DIGITS OF YOUR ACCOUNT", "FIVE SIX", "FIVE SIX"),
    ("CAN I TAKE THE LAST FOUR DIGITS OF YOUR CARD", "ONE TWO THREE FOUR", "[REDACTED CARD]"),
    ("CAN I HAVE YOUR FULL NAME", "IT'S ADRIAN BEESTON", "IT'S [REDACTED NAME]"),
    ("HOW DO YOU SPELL THAT", "A D R I A N", "A D R I A N"),
    (None, "THANK YOU FOR CALLING MY NAME IS SHAUNA", "THANK YOU FOR CALLING MY NAME IS [REDACTED NAME]"),
    ("WHAT'S YOUR ADDRESS", "IT'S TWO MILTON DRIVE", "IT'S [REDACTED LOCATION]"),
    ("CAN I HAVE YOUR FULL NAME AND ADDRESS", "YES SO IT'S BETTER C FOUR SIX WEDNESDAY BILL", "YES SO IT'S [REDACTED LOCATION]"),
    ("WHAT'S YOUR POSTCODE", "IT'S ER SEVEN SIX Q T", "IT'S [REDACTED POSTCODE]"),
    ("AND YOUR POSTCODE", "HD TWO FIVE C F", "[REDACTED POSTCODE]"),
    ("WHAT'S YOUR EMAIL ADDRESS", "IT'S ADRIAN BEESTON THIRTEEN AT GMAIL DOT COM", "IT'S [REDACTED LOCATION]"),
    ("CAN YOU PROVIDE YOUR PASSWORD", "IT IS WRITTEN DOWN SOMEWHERE THREE THREE TWO C D C Q I J SEVEN SIX EIGHT E",
     "IT IS WRITTEN DOWN SOMEWHERE [REDACTED PASSWORD] I J SEVEN SIX EIGHT E"),
    ("WHAT'S YOUR PASSWORD", "O B", "[REDACTED PASSWORD]"),
    ("CAN I HAVE YOUR MOBILE NUMBER", "IS ZERO DOUBLE SEVEN NINE FOUR FIVE OH FIVE EIGHT THREE SIX", "IS [REDACTED PHONE]"),
    (None, "MY NUMBER IS 07945058361", "MY NUMBER IS [REDACTED PHONE]"),
    # A trigger inside another word fires; lower case and accents do not matter.
    ("I WENT SHOPPING", "O B", "[REDACTED PASSWORD]"),
    ("can i have your full name", "it's Adrian Beeston", "it's [REDACTED NAME]"),
    ("Füll náme: what is your name", "Straße ß adrian", "[REDACTED NAME] ß adrian"),
    ("WHAT'S YOUR ADDRESS", "   ", "   "),
    ("FULL NAME AND ADDRESS WITH THE POSTCODE", "  ", "  "),
    ("AND YOUR EMAIL", "MY MAIL IS john.smith@example.com OK", "MY MAIL IS [REDACTED EMAIL] OK"),
    (None, "PAY WITH 4111 1111 1111 1111 OR 4111 1111 1111 1112", "PAY WITH [REDACTED CARD] OR 4111 1111 1111 1112"),
    (None, "IBAN GB82 WEST 1234 5698 7654 32 NOT GB83WEST12345698765432", "IBAN [REDACTED] NOT GB83WEST12345698765432"),
    (None, "", ""),
]

#: context kinds, text, spans kept after the filters as (entity, start, end)
PATTERNS = [
    ("reference_number", "19121289", [("REFERENCE_NUMBER", 0, 8)]),
    ("reference_number", "ONE NINE 12 12 89", []),
    ("reference_number", "ONE NINE DASH ONE TWO", []),
    ("bank_digits", "56", [("BANK_ACCOUNT_LAST_DIGITS", 0, 2)]),
    ("bank_digits", "FIVE 6", [("BANK_ACCOUNT_LAST_DIGITS", 5, 6)]),
    ("bank_digits", "UM FIVE SIX", []),
    ("bank_digits", "double 5 and 123 or 7", [("BANK_ACCOUNT_LAST_DIGITS", 0, 8), ("BANK_ACCOUNT_LAST_DIGITS", 20, 21)]),
    ("name", "G R A C E", []),
    ("name", "MY NAME IS J O H N", []),
    ("", "MY NAME IS ROSEMARY", [("PERSON", 11, 19)]),
    ("name", "I'M CALLED ADRIAN", [("PERSON", 11, 17)]),
    ("email", "JOHN AT EXAMPLE DOT COM", [("EMAIL_ADDRESS", 0, 23)]),
    ("password", "A B C ONE TWO 3", [("PASSWORD", 2, 5)]),
    ("password", "A 1", []),
    ("", "07945058361", [("PHONE_NUMBER", 0, 11)]),
    ("reference_number", "YEAH ONE NINE ONE TWO ONE TWO EIGHT THAT'S THE SKY FAMILY", [("REFERENCE_NUMBER", 5, 35)]),
    ("address", "C FOUR SIX WEDNESDAY BILL", [("LOCATION", 0, 25)]),
    ("email", "S DOT DAVIES AT J M U DOT AC DOT UK", [("EMAIL_ADDRESS", 0, 35)]),
    ("name", "GREY G R A C E", []),
    ("name", "CLEAR STANLEY DAVIS", [("PERSON", 6, 19)]),
    ("address postcode", "DAMIEN O'BRIEN TWENTY WILL BOOK LAUNDRY BRIAN AND FORTY AND V FIVE EIGHT FIVE",
     [("LOCATION", 0, 77), ("UK_POSTCODE", 0, 77)]),
    # Offsets: no drift with double blanks, newlines, no-break spaces, or a sign of two code units.
    ("name", "IT'S  ADRIAN   BEESTON", [("PERSON", 6, 22)]),
    ("name", "IT'S\nADRIAN BEESTON", [("PERSON", 5, 19)]),
    ("name", "\U0001F600 PLANNED TRIP", [("PERSON", 2, 14)]),
    ("name", "UNPLANNED. ANN", [("PERSON", 11, 14)]),
    ("name", "JOHN PAUL GEORGE RINGO", []),
    ("name", "G R E Y", [("PERSON", 0, 7)]),
    ("name", "G ODD R TWO E WAY Y", [("PERSON", 0, 19)]),
    # Letters too far apart: no spelled name, the direct answer finds ODD ONES? no, ONE is denied.
    ("name", "G IS THE R E", []),
    ("name", "CALLED MISTER SMITH JONES", [("PERSON", 7, 19)]),
    ("name", "TELL THEM J O H N S", []),
    ("name", "J O H N THEM OVER THERE S", [("PERSON", 0, 7)]),
    ("address", "NUMBER ONE-A", []),
    ("address", "TWO MILTON'S DRIVE", [("LOCATION", 0, 18)]),
    ("address", "DRIVE", []),
    ("postcode", "SEVEN SIX", []),
    ("postcode", "ER Q T", []),
    ("card_digits", "1 2 X 3", [("CREDIT_CARD", 0, 1), ("CREDIT_CARD", 2, 3), ("CREDIT_CARD", 6, 7)]),
    ("card_digits", "1 TWO 3 FOUR 5", [("CREDIT_CARD", 0, 12)]),
    ("card_digits", "9034", []),
    ("password", "B WITH 1 X2", [("PASSWORD", 0, 11)]),
    ("password", " ".join(["B", "1X"] * 8), []),
    ("password", " ".join(["B", "1X"] * 7 + ["7"]), [("PASSWORD", 0, 36)]),
    ("email", "S FOR AT SKY DOT COM", [("EMAIL_ADDRESS", 0, 20), ("EMAIL_ADDRESS", 2, 20)]),
    ("email", "JAMES DOT DAVIES AT J M U DOT AC", [("EMAIL_ADDRESS", 4, 32)]),
    ("", "MY NAME'S JOHN, HELLO AND MY NAME IS WILL.", [("PERSON", 10, 14)]),
    ("", "TAMMY NAME IS JOHN", [("PERSON", 14, 18)]),
    ("", "MY NAME IS JOHN SMITH", []),
    ("address postcode", "MY NAME IS JOHN", [("LOCATION", 0, 15)]),
    ("", "1" * 9, []),
    ("", "ONE TWO THREE FOUR FIVE SIX SEVEN EIGHT NINETY", [("PHONE_NUMBER", 0, 46)]),
    ("", "ONE TWO THREE FOUR FIVE SIX SEVEN EIGHT NINETYS", []),
]


def spans_of(spark, cases, rules=DEFAULT_RULES):
    rows = [(i, sum(BIT[k] for k in kinds.split()), text) for i, (kinds, text) in enumerate(cases)]
    df = spark.createDataFrame(rows, "i int, context int, content string").repartition(4)
    out = df.select("i", turn_spans(F.col("content"), F.col("context"), rules).alias("s")).collect()
    return [[(s.entity, s.start, s.end) for s in r.s] for r in sorted(out)]


def test_talks(spark):
    rows = []
    for i, (before, text, _) in enumerate(TALKS):
        turns = ([{"role": "agent", "content": before}] if before is not None else [])
        rows.append((i, json.dumps([*turns, {"role": "customer", "content": text}])))
    done = redact_transcripts(parse_transcripts(spark.createDataFrame(rows, "i int, transcription string")))
    got = {r.i: r.redacted[-1].content for r in done.select("i", "redacted").collect()}
    assert [got[i] for i in range(len(TALKS))] == [t[2] for t in TALKS]


def test_patterns(spark):
    got = spans_of(spark, [p[:2] for p in PATTERNS])
    wrong = [(p, g) for p, g in zip(PATTERNS, got) if p[2] != g]
    assert wrong == []


def test_number_words_of_any_length_in_a_row(spark):
    # Long runs must neither be cut nor exhaust the matcher.
    text = " ".join(["SEVEN"] * 50_000)
    letters = " ".join(["B"] * 50_000)
    got = spans_of(spark, [("reference_number", text), ("name", letters), ("password", text), ("address", text)])
    assert got[0] == [("PHONE_NUMBER", 0, len(text)), ("REFERENCE_NUMBER", 0, len(text))]
    assert got[1] == [("PERSON", 0, len(letters))]
    assert ("PASSWORD", 0, len(text)) in got[2]
    assert ("LOCATION", 0, len(text)) in got[3]


def test_deny_scope_keeps_spelled_names(spark):
    lenient = DEFAULT_RULES.with_(deny_scope="gazetteer")
    assert spans_of(spark, [("name", "G R A C E")], lenient) == [[("PERSON", 0, 9)]]


def test_strict_bounds_cover_the_whole_word(spark):
    strict = DEFAULT_RULES.with_(strict_bounds=True)
    case = ("email", "JAMES DOT DAVIES AT J M U DOT AC")
    assert spans_of(spark, [case], strict) == [[("EMAIL_ADDRESS", 0, 32)]]


def test_score_gate_is_strict(spark):
    assert spans_of(spark, [("", "07945058361")], DEFAULT_RULES.with_(min_score=0.85)) == [[]]
    assert spans_of(spark, [("", "07945058361")], DEFAULT_RULES.with_(min_score=0.84)) != [[]]


def test_added_detector(spark):
    def order_number(turn):
        return locate_all(turn.text, r"ORD-[0-9]+", "ORDER_NUMBER", "order_number", 0.9)

    register("order_number", order_number)
    try:
        rows = spark.createDataFrame([('[{"role":"a","content":"see ord-17 now"}]',)], "transcription string")
        done = redact_transcripts(parse_transcripts(rows)).first()
    finally:
        unregister("order_number")
    assert done.redacted[0].content == "see [REDACTED] now"
    assert done.redacted[0].spans[0].matched == "ord-17"
    with pytest.raises(ValueError):
        register("phone", order_number)


def test_fold_keeps_length_and_hides_the_mark(spark):
    texts = ["straße", "ſıx", "a\x01b", "ÉCOLE é", "\U0001F600x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(fold(F.col("t"))).collect()]
    assert got == ["STRAßE", "SIX", "A\x02B", "ÉCOLE é", "\U0001F600X"]


def test_text_with_the_mark_is_redacted_at_the_right_place(spark):
    df = spark.createDataFrame([("a\x01b 07945058361 \x01",)], "t string")
    spans = turn_spans(F.col("t"), F.lit(0))
    assert df.select(redact_text(F.col("t"), spans)).first()[0] == "a\x01b [REDACTED PHONE] \x01"


def test_redaction_is_idempotent_without_context(spark):
    texts = [t for _, t, _ in TALKS]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    once = df.select(redact_text(F.col("t"), turn_spans(F.col("t"), F.lit(0))).alias("t"))
    twice = once.select("t", redact_text(F.col("t"), turn_spans(F.col("t"), F.lit(0))).alias("u"))
    assert all(r.t == r.u for r in twice.collect())
