"""Detectors for personal data spoken in a call.

Each detector maps a turn (folded text and context bits) to an array of spans.
Runs of tokens are found with one pattern over the text, built from the word
lists: a token is a literal or a class with blanks, or the edge of the text, on
both sides. Repeated groups are possessive, so a long turn costs linear time and
does not exhaust the matcher's stack.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from hushline.functions import context as ctx
from hushline.functions.spans import joined, locate_all, locate_first, no_spans, whole
from hushline.functions.text import (
    BLANK, DIGIT_CHAR, INK, TOKEN_END, TOKEN_START, any_of, but_not, count_tokens, either, is_blank, is_one_of,
    let, pattern, token,
)
from hushline.rules import SPOKEN_SCORE, Rules


@dataclass(frozen=True)
class Turn:
    """One turn as the detectors see it."""

    text: Column
    context: Column
    rules: Rules

    def expects(self, kind: str) -> Column:
        return ctx.expects(self.context, kind)

    @property
    def combined(self) -> Column:
        return ctx.combined(self.context)


def _run(body: str, at_least: int) -> str:
    """A maximal run of at least so many tokens."""
    return f"{token(body)}(?:{BLANK}++(?:{body}){TOKEN_END}){{{at_least - 1},}}+"


def _when(gate: Column, spans: Column) -> Column:
    return either(gate, spans, no_spans())


# -- C1 ---------------------------------------------------------------------

def reference_number(turn: Turn) -> Column:
    words = pattern(_run(any_of(turn.rules.number_words), 5))
    digits = pattern(r"\b\d{7,}\b")
    return _when(turn.expects("reference_number"), joined(
        locate_all(turn.text, words, "REFERENCE_NUMBER", "reference_in_words", SPOKEN_SCORE),
        locate_all(turn.text, digits, "REFERENCE_NUMBER", "reference_in_digits", SPOKEN_SCORE),
    ))


# -- C2 ---------------------------------------------------------------------

def bank_digits(turn: Turn) -> Column:
    # Leftmost match of the alternation: a digit inside "DOUBLE 5" is not found again.
    regex = pattern(rf"\bDOUBLE{BLANK}+\d\b|\b\d{{1,2}}\b")
    spans = locate_all(turn.text, regex, "BANK_ACCOUNT_LAST_DIGITS", "bank_digits", SPOKEN_SCORE)
    return _when(turn.expects("bank_digits"), spans)


# -- C3 ---------------------------------------------------------------------

def card_digits(turn: Turn) -> Column:
    unit = f"(?:{any_of(turn.rules.card_digit_words)}|\\d)"
    four = pattern(rf"\b{unit}(?:{BLANK}+{unit}){{3}}\b")
    fours = locate_all(turn.text, four, "CREDIT_CARD", "card_four_in_a_row", SPOKEN_SCORE)
    singles = locate_all(turn.text, pattern(r"\b\d\b"), "CREDIT_CARD", "card_lone_digit", SPOKEN_SCORE)
    best = let(fours, lambda found: either(F.size(found) > 0, found, singles))
    return _when(turn.expects("card_digits"), best)


# -- C4 ---------------------------------------------------------------------

def _introduced(turn: Turn) -> Column:
    """MY NAME IS ..., which needs no context."""
    rules = turn.rules
    after = rf"(?={BLANK}+{any_of(rules.name_boundaries)}|{BLANK}*[,.]|{BLANK}*\z)"
    regex = pattern(rf"(MY{BLANK}+NAME(?:{BLANK}+IS|'S){BLANK}+)([A-Z]{{3,}})\b{after}")
    spans = locate_all(turn.text, regex, "PERSON", "after_my_name_is", SPOKEN_SCORE, group=True)
    named = F.filter(spans, lambda s: ~is_one_of(s["matched"], rules.deny_words))
    return _when(_may_introduce(turn), named)


def _may_introduce(turn: Turn) -> Column:
    return turn.text.contains("NAME") & turn.text.contains("MY")


def _letter(rules: Rules) -> str:
    """A single letter which is not a common word such as I or A."""
    barred = [w for w in rules.deny_words if len(w) == 1]
    return rf"{but_not(barred)}\p{{L}}{TOKEN_END}"


def _spelled_out(turn: Turn) -> Column:
    """Three or more single letters, never more than one other token apart."""
    letter = _letter(turn.rules)
    other = f"(?!{letter}){INK}++"
    return turn.text.rlike(pattern(
        rf"\A{BLANK}*+(?:{other}{BLANK}++)*+{letter}"
        rf"(?:{BLANK}++(?:{other}{BLANK}++)?+{letter}){{2,}}+"
        rf"(?:{BLANK}++{other})*+{BLANK}*+\z"
    ))


def _spelled(turn: Turn) -> Column:
    """A row of single letters inside the turn."""
    regex = pattern(rf"\b[A-Z](?:{BLANK}++[A-Z]\b){{2,}}+")
    letter = _letter(turn.rules)
    spans = locate_all(turn.text, regex, "PERSON", "letters_in_a_row", SPOKEN_SCORE)
    return F.filter(spans, lambda s: count_tokens(s["matched"], letter) >= 3)


def _after_cue(turn: Turn) -> Column:
    """NAME IS ... and CALLED ..., with a title or with one or two words (C4d)."""
    titled = rf"{any_of(turn.rules.titles)}{BLANK}+[A-Z]{{3,}}"
    plain = rf"[A-Z]{{3,}}(?:{BLANK}+[A-Z]{{3,}})?"
    found = []
    for word, cue in (("NAME", f"NAME{BLANK}+IS"), ("CALLED", "CALLED")):
        spans = [
            locate_all(turn.text, pattern(f"({cue}{BLANK}+)({name})"), "PERSON", "after_name_cue",
                       SPOKEN_SCORE, group=True)
            for name in (titled, plain)
        ]
        found.append(_when(turn.text.contains(word), joined(*spans)))
    return F.array_distinct(joined(*found))


def _direct_answer(turn: Turn) -> Column:
    """One to three name words in a row, fillers in between allowed (C4e)."""
    rules = turn.rules
    filler = any_of(rules.filler_words) + TOKEN_END
    barred = (*rules.deny_words, *rules.non_name_words, *rules.filler_words)
    name = rf"{but_not(barred)}\p{{L}}{{3,}}+{TOKEN_END}"
    regex = pattern(rf"{TOKEN_START}{name}(?:(?:{BLANK}++{filler})*+{BLANK}++{name})*+")
    spans = locate_first(turn.text, regex, "PERSON", "name_words", SPOKEN_SCORE)
    return F.filter(spans, lambda s: count_tokens(s["matched"], name) <= 3)


def person(turn: Turn) -> Column:
    """Names. An introduction or a fully spelled answer ends the search (C4)."""
    spelled_out = whole(turn.text, "PERSON", "letters_throughout", SPOKEN_SCORE)
    cued = joined(_spelled(turn), _after_cue(turn))
    by_context = let(cued, lambda s: either(F.size(s) > 0, s, _direct_answer(turn)))

    def search(intro: Column) -> Column:
        asked = either(_spelled_out(turn), spelled_out, by_context)
        return either(F.size(intro) > 0, intro, either(turn.expects("name"), asked, no_spans()))

    worth_it = turn.expects("name") | _may_introduce(turn)
    return _when(worth_it & ~turn.combined, let(_introduced(turn), search))


# -- C5, C6 -----------------------------------------------------------------

def _first_to_last(rules: Rules) -> str:
    """From the first significant token to the last; there must be two.

    Significant: letters only, digits only, or a number word, and no filler.
    """
    edge = token(
        rf"{but_not(rules.filler_words)}"
        rf"(?:\p{{L}}++|{DIGIT_CHAR}++|{any_of(rules.number_words)})"
    )
    return pattern(rf"(?s){edge}.*{edge}")


def location(turn: Turn) -> Column:
    answer = locate_all(
        turn.text, _first_to_last(turn.rules), "LOCATION", "first_to_last_word", SPOKEN_SCORE
    )
    everything = whole(turn.text, "LOCATION", "whole_answer", SPOKEN_SCORE)
    nothing = ~turn.expects("address") | is_blank(turn.text)
    return either(nothing, no_spans(), either(turn.combined, everything, answer))


def postcode(turn: Turn) -> Column:
    rules = turn.rules
    number = any_of(rules.number_words)
    letters = pattern(token(rf"{but_not((*rules.filler_words, *rules.number_words))}\p{{L}}++"))
    numbers = pattern(token(rf"{but_not(rules.filler_words)}(?:{DIGIT_CHAR}++|{number})"))
    spans = locate_all(
        turn.text, _first_to_last(rules), "UK_POSTCODE", "letters_and_numbers", SPOKEN_SCORE
    )
    return _when(turn.expects("postcode") & turn.text.rlike(letters) & turn.text.rlike(numbers), spans)


# -- C7 ---------------------------------------------------------------------

def email(turn: Turn) -> Column:
    dots = rf"(?:{BLANK}++DOT{BLANK}++[A-Z]++)++"
    at = rf"{BLANK}++(?:AT|@){BLANK}++"
    head = r"\b[A-Z]++" if turn.rules.strict_bounds else "[A-Z]"
    regexes = (
        rf"{head}{dots}{at}[A-Z](?={BLANK})(?:{BLANK}++[A-Z](?={BLANK}))*+{dots}",
        rf"[A-Z]++{at}[A-Z]++{dots}",
        rf"[A-Z]{BLANK}++FOR{at}[A-Z]++{dots}",
    )
    spans = [
        locate_all(turn.text, pattern(r), "EMAIL_ADDRESS", "email_in_words", SPOKEN_SCORE)
        for r in regexes
    ]
    return _when(turn.expects("email") & turn.text.contains("DOT"), F.array_distinct(joined(*spans)))


# -- C8 ---------------------------------------------------------------------

def password(turn: Turn) -> Column:
    rules = turn.rules
    number = any_of(rules.number_words)
    barred = [w for w in rules.deny_words if len(w) == 1 or w.isdigit() or w in rules.number_words]
    piece = rf"{but_not(barred)}(?:\p{{L}}|{DIGIT_CHAR}++|{number})"
    run = locate_first(turn.text, pattern(_run(piece, 2)), "PASSWORD", "password_run", SPOKEN_SCORE)

    letter = turn.text.rlike(pattern(token(r"\p{L}")))
    digit = turn.text.rlike(pattern(token(f"{DIGIT_CHAR}++|{number}")))
    words = count_tokens(turn.text)
    plain = count_tokens(turn.text, but_not(rules.deny_words) + INK + "++")
    short = letter & digit & (words <= 15) & (plain >= words * F.lit(0.6))
    everything = whole(turn.text, "PASSWORD", "short_answer_with_digit", SPOKEN_SCORE)

    def choose(found: Column) -> Column:
        return either(F.size(found) > 0, found, either(short, everything, no_spans()))

    return _when(turn.expects("password"), let(run, choose))


# -- C9 ---------------------------------------------------------------------

def phone(turn: Turn) -> Column:
    """Phone numbers, spoken or written; needs no context."""
    number = any_of(turn.rules.number_words)
    spoken = pattern(rf"\b{number}(?:{BLANK}++{number}\b){{8,}}+")
    written = pattern(r"\b0\d{9,10}\b")
    # Nine words and their blanks have a least length, and every written number a zero:
    # these tests keep the patterns away from many turns.
    shortest = 9 * min(map(len, turn.rules.number_words)) + 8
    return joined(
        _when(F.length(turn.text) >= shortest,
              locate_all(turn.text, spoken, "PHONE_NUMBER", "phone_in_words", SPOKEN_SCORE)),
        _when(turn.text.contains("0"),
              locate_all(turn.text, written, "PHONE_NUMBER", "phone_in_digits", SPOKEN_SCORE)),
    )
