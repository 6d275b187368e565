"""The list of detectors (C10). A user adds one with ``register``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from hushline.functions.spans import joined, no_spans
from hushline.functions.text import either
from hushline.operators import spoken, written
from hushline.operators.spoken import Turn

Detector = Callable[[Turn], Column]

#: Run for every turn, in this order.
SPOKEN: dict[str, Detector] = {
    "reference_number": spoken.reference_number,
    "bank_digits": spoken.bank_digits,
    "card_digits": spoken.card_digits,
    "person": spoken.person,
    "location": spoken.location,
    "postcode": spoken.postcode,
    "email": spoken.email,
    "password": spoken.password,
    "phone": spoken.phone,
}

#: Run when named in ``Rules.written``.
WRITTEN: dict[str, Detector] = {
    "written_email": written.written_email,
    "written_card": written.written_card,
    "iban": written.iban,
    "age": written.age,
    "money": written.money,
}

#: Those which find nothing where the turn before asked for nothing, and those which find nothing without a
#: digit: one test passes over all of them, as most turns have neither.
BY_CONTEXT = ("reference_number", "bank_digits", "card_digits", "location", "postcode", "email", "password")
BY_DIGIT = ("written_card", "iban")

_added: dict[str, Detector] = {}


def register(name: str, detector: Detector) -> None:
    """Add a detector: a function from a ``Turn`` to an array of spans.

    Build the spans with ``functions.spans.locate_all``.
    """
    if name in SPOKEN or name in WRITTEN:
        raise ValueError(f"{name!r} is taken by a built-in detector")
    _added[name] = detector


def unregister(name: str) -> None:
    _added.pop(name, None)


def all_detectors(turn: Turn) -> list[Detector]:
    unknown = set(turn.rules.written) - set(WRITTEN)
    if unknown:
        raise ValueError(f"unknown written-form detectors {sorted(unknown)}")
    return [*SPOKEN.values(), *(WRITTEN[n] for n in turn.rules.written), *_added.values()]


def detect(turn: Turn, only: str | None = None) -> Column:
    """All spans of a turn, unfiltered; with ``only``, those of one detector."""
    if only is not None:
        return {**SPOKEN, **WRITTEN, **_added}[only](turn)
    known = {**SPOKEN, **WRITTEN}
    by_context, by_digit = ([known[n] for n in names] for names in (BY_CONTEXT, BY_DIGIT))
    wanted = all_detectors(turn)

    def group(among: list[Detector], gate: Column) -> list[Column]:
        found = [d(turn) for d in wanted if d in among]
        return [either(gate, joined(*found), no_spans())] if found else []

    return joined(
        *group(by_context, turn.context != 0), *group(by_digit, turn.text.rlike("[0-9]")),
        *[d(turn) for d in wanted if d not in by_context and d not in by_digit],
    )


def signature() -> tuple:
    """Changes whenever a detector is added or taken away."""
    return tuple(_added.items())
