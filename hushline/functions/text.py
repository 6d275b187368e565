"""Text helpers shared by all detectors. Every function maps columns to columns."""

from __future__ import annotations

import re
import string
from collections.abc import Callable, Iterable
from itertools import groupby
from os.path import commonprefix

from pyspark.sql import Column, functions as F

#: Blanks as a word split sees them: Unicode white space and the four separators.
BLANK = r"[\s\x1c-\x1f]"
INK = r"[^\s\x1c-\x1f]"
#: A match starts, or ends, at the edge of a blank-separated token.
TOKEN_START = rf"(?<!{INK})"
TOKEN_END = rf"(?!{INK})"
#: Digits as str.isdigit sees them: decimal digits, and the digit-valued signs
#: such as superscripts and circled digits (fixed values of the Unicode tables).
DIGIT_CHAR = (
    r"[\p{Nd}²³¹፩-፱᧚⁰⁴-⁹₀-₉①-⑨"
    r"⑴-⑼⒈-⒐⓪⓵-⓽⓿❶-❾➀-➈"
    r"➊-➒]"
)

#: Puts a mark around each match. The folded text never holds it.
MARK = "\x01"
MARK_STAND_IN = "\x02"


def fold(text: Column) -> Column:
    """Upper-case without changing the length, so offsets hold in the original text.

    All lists and patterns are ASCII; the two other letters whose upper case is an
    ASCII letter are folded too. The mark used by the span functions is replaced
    by another control character, which no pattern tells apart from it. Plain
    ASCII text takes the built-in upper, which is many times faster. The text is
    used several times: bind it, and the result, with ``let`` inside a lambda.
    """
    plain = (F.octet_length(text) == F.length(text)) & ~text.contains(MARK)
    return either(plain, F.upper(text), F.translate(
        text,
        string.ascii_lowercase + "ſı" + MARK,
        string.ascii_uppercase + "SI" + MARK_STAND_IN,
    ))


def pattern(regex: str) -> str:
    """Make ``\\s``, ``\\d`` and ``\\b`` cover all of Unicode."""
    return "(?U)" + regex


def any_of(words: Iterable[str]) -> str:
    """A pattern for any of the literal words, common beginnings written once.

    The matcher then tries one branch per next letter, not one per word, and none
    where many branches have other first letters. A longer word is tried before the
    one it begins with, so that it never stops short. Groups are dear (the matcher keeps
    a place for each, and clears them for every text), so letters without a branch have none.
    """
    unique = sorted(set(words))
    branches, initials = [], ""
    for first, group in groupby((w for w in unique if w), key=lambda w: w[0]):
        alike = list(group)
        head = commonprefix(alike)
        rests = [w[len(head):] for w in alike]
        branches.append(quote(head) + (any_of(rests) if rests != [""] else ""))
        initials += quote(first)
    if not branches:
        return ""
    if "" in unique:
        return f"(?:{'|'.join(branches)})?"
    return f"(?:(?=[{initials}])(?:{'|'.join(branches)}))" if len(branches) > 4 else f"(?:{'|'.join(branches)})"


def quote(word: str) -> str:
    """A literal for a Java pattern; blanks inside match as written."""
    return re.sub(r"([^\w\s])", r"\\\1", word)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once and use it many times inside ``body``.

    Inside a lambda the optimizer cannot share a repeated expression. An aggregate
    over nothing starts with the value and hands it to its finishing lambda, so it is
    evaluated exactly once. (Taking the item of a one-element transform does the same,
    but works out the type of the whole body again for every row.)
    """
    nothing = F.array().cast("array<int>")
    return F.aggregate(nothing, value, lambda acc, _: acc, body)


def either(test: Column, yes: Column, no: Column) -> Column:
    """``yes`` where the test holds, else ``no``.

    Where nothing is compiled (in lambdas) a CASE walks the list of its branches for each row.
    """
    return F.call_function("if", test, yes, no)


def token(body: str) -> str:
    """A whole blank-separated token."""
    return f"{TOKEN_START}(?:{body}){TOKEN_END}"


def but_not(words: Iterable[str]) -> str:
    """Placed before a token: it is none of the words."""
    words = tuple(words)
    return f"(?!{any_of(words)}{TOKEN_END})" if words else ""


def count_tokens(text: Column, body: str = INK + "++") -> Column:
    """How many tokens of that form; by default, how many words."""
    return F.regexp_count(text, F.lit(pattern(token(body))))


def is_one_of(text: Column, words: Iterable[str]) -> Column:
    """The whole text is one of the words."""
    return text.isin(*sorted(set(words)))


def has_word(text: Column, words: Iterable[str]) -> Column:
    """Some token of the text is one of the words."""
    return text.rlike(pattern(token(any_of(words))))


def is_one_word(text: Column) -> Column:
    return ~text.rlike(pattern(BLANK))


def is_blank(text: Column) -> Column:
    return ~text.rlike(pattern(INK))


#: Control characters whose escape holds a letter; the JSON writer gives it in upper case.
_LETTERED = ("0B", "0E", "0F", "1A", "1B", "1C", "1D", "1E", "1F")


def ascii_json(json: Column) -> Column:
    """JSON text in ASCII alone, byte for byte as the job publishes it.

    Every other sign, and the one that deletes, becomes the escapes of its UTF-16 units (two for signs outside the basic
    plane), in lower-case hexadecimal; so do the escapes of control characters. JSON text holds no
    control character as such, so the mark cannot be part of it. Plain text is left as it is.
    """
    def lowered(text: Column) -> Column:
        for code in _LETTERED:
            # An escape begins with a backslash that is not itself escaped.
            text = F.regexp_replace(text, rf"(?<!\\)((?:\\\\)*+)\\u00{code}", rf"$1\\u00{code.lower()}")
        return text

    def escaped(text: Column) -> Column:
        pieces = F.split(F.regexp_replace(text, F.lit(r"[^\x00-\x7E]+"), F.lit(f"{MARK}$0{MARK}")), MARK)
        units = lambda run: F.regexp_replace(F.lower(F.hex(F.encode(run, "UTF-16BE"))), "(.{4})", r"\\u$1")
        return F.array_join(F.transform(pieces, lambda piece, i: either(i % 2 == 1, units(piece), piece)), "")

    def ascii_only(text: Column) -> Column:
        plain = (F.octet_length(text) == F.length(text)) & ~text.contains("\x7f")
        return either(plain, text, escaped(text))

    return let(json, lambda text: let(either(text.contains("\\u00"), lowered(text), text), ascii_only))
