"""What a turn makes us expect in the next one, packed into the bits of one integer."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from hushline.functions.text import any_of, either
from hushline.rules import KINDS, Rules

BIT = {kind: 1 << i for i, kind in enumerate(KINDS)}
COMBINED = BIT["address"] | BIT["postcode"]


def _needed(phrases: tuple[str, ...]) -> list[str]:
    """Phrases that hold no other phrase: the shorter one fires whenever the longer does."""
    return [p for p in phrases if not any(q != p and q in p for q in phrases)]


def _any(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)


def holds_any(folded: Column, phrases: tuple[str, ...]) -> Column:
    """The text holds one of the phrases. Those with a word in common are tried only where that word is."""

    def sharing(word: str) -> list[str]:
        return [p for p in left if word in p]

    left, tests = list(phrases), []
    while left:
        words = sorted({w for p in left for w in p.split()}, key=lambda w: (-len(sharing(w)), -len(w), w))
        word = words[0] if words else left[0]
        group = sharing(word)
        if len(group) < 3:
            # Testing two phrases costs no more than the test for their word.
            group, word = left, ""
        together = _any([folded.contains(p) for p in group])
        tests.append(folded.contains(word) & together if word else together)
        left = [p for p in left if p not in group]
    return _any(tests)


def signals(folded: Column, rules: Rules) -> Column:
    """The kinds this turn asks for (B1 to B9); substring tests, no word boundary.

    Most turns hold no phrase at all, which one pattern for all of them tells sooner.
    """
    bits = []
    for kind in KINDS:
        hit = holds_any(folded, tuple(_needed(rules.indicators[kind])))
        bits.append(either(hit, F.lit(BIT[kind]), F.lit(0)))
    every = _needed(tuple({p: None for kind in KINDS for p in rules.indicators[kind]}))
    return either(folded.rlike(any_of(every)), reduce(lambda a, b: a + b, bits), F.lit(0))


def expects(context: Column, kind: str) -> Column:
    return context.bitwiseAND(F.lit(BIT[kind])) != 0


def combined(context: Column) -> Column:
    """Address and postcode were asked for together."""
    return context.bitwiseAND(F.lit(COMBINED)) == COMBINED
