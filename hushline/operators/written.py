"""Detectors for personal data in written form (D2 to D5); they need no context."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from hushline.functions.spans import locate_all, no_spans
from hushline.functions.text import either, pattern
from hushline.operators.spoken import Turn

#: Scores of the written forms: a check digit is worth full confidence.
CHECKED_SCORE = 1.0
PATTERN_SCORE = 0.85

EMAIL = r"[A-Z0-9][A-Z0-9._%+-]*@[A-Z0-9-]+(?:\.[A-Z0-9-]+)*\.[A-Z]{2,}"
#: Thirteen to nineteen digits in one piece, or in the groups printed on cards.
CARD = (
    r"(?<![0-9])(?:[0-9]{13,19}"
    r"|[0-9]{4}(?:[ -][0-9]{4}){2}[ -][0-9]{1,7}"
    r"|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5})(?![0-9])"
)
#: Country, check digits and 11 to 30 more letters or digits, blanks every four.
IBAN = r"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Z0-9])"
AGE = r"(?<![0-9])[0-9]{1,3}[ -]YEARS?[ -]OLD\b|\bAGED? [0-9]{1,3}\b"
MONEY = r"[£$€] ?[0-9]+(?:,[0-9]{3})*(?:\.[0-9]{1,2})?|\b[0-9]+(?:\.[0-9]{1,2})? (?:POUNDS|DOLLARS|EUROS|PENCE)\b"


def luhn_ok(number: Column) -> Column:
    """The check-digit sum of a card number is a multiple of ten."""
    digits = F.reverse(F.regexp_extract_all(number, F.lit("[0-9]"), F.lit(0)))

    def share(digit: Column, i: Column) -> Column:
        value = digit.cast("int")
        twice = value * 2
        return either(i % 2 == 0, value, twice - either(twice > 9, F.lit(9), F.lit(0)))

    total = F.aggregate(F.transform(digits, share), F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


def iban_ok(iban: Column) -> Column:
    """Country and check digits moved to the end, letters as 10 to 35: 1 modulo 97."""
    bare = F.replace(iban, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(bare, 5, 34), F.substring(bare, 1, 4))

    def fold_in(acc: Column, ch: Column) -> Column:
        code = F.ascii(ch)
        return either(code < 58, (acc * 10 + code - 48) % 97, (acc * 100 + code - 55) % 97)

    chars = F.regexp_extract_all(turned, F.lit("[A-Z0-9]"), F.lit(0))
    return (F.aggregate(chars, F.lit(0), fold_in) == 1) & F.length(bare).between(15, 34)


def written_email(turn: Turn) -> Column:
    spans = locate_all(turn.text, pattern(EMAIL), "EMAIL_ADDRESS", "written_email", CHECKED_SCORE)
    return either(turn.text.contains("@"), spans, no_spans())


def written_card(turn: Turn) -> Column:
    spans = locate_all(turn.text, pattern(CARD), "CREDIT_CARD", "written_card", CHECKED_SCORE)
    good = F.filter(spans, lambda s: luhn_ok(s["matched"]))
    return either(turn.text.rlike("[0-9]{4}"), good, no_spans())


def iban(turn: Turn) -> Column:
    spans = locate_all(turn.text, pattern(IBAN), "IBAN_CODE", "iban", CHECKED_SCORE)
    good = F.filter(spans, lambda s: iban_ok(s["matched"]))
    return either(turn.text.rlike("[A-Z]{2}[0-9]{2}"), good, no_spans())


def age(turn: Turn) -> Column:
    return locate_all(turn.text, pattern(AGE), "AGE", "age", PATTERN_SCORE)


def money(turn: Turn) -> Column:
    return locate_all(turn.text, pattern(MONEY), "MONEY", "money", PATTERN_SCORE)
