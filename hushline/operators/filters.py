"""Filters on detected spans."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from hushline.functions.text import any_of, count_tokens, either, has_word, is_one_of, is_one_word
from hushline.operators.spoken import Turn
from hushline.rules import Rules

#: Detectors which are a table of names or a model, not a rule on the turn.
LOOKUP_DETECTORS = ("gazetteer", "model")


def _denied(span: Column, rules: Rules) -> Column:
    """The text, or any word of it, is a deny word."""
    phrases = [w for w in rules.deny_words if " " in w]
    # Where there is no blank, the text is its only word.
    denied = is_one_of(span["matched"], rules.deny_words) | (
        ~is_one_word(span["matched"]) & has_word(span["matched"], rules.deny_words)
    )
    return denied | is_one_of(span["matched"], phrases) if phrases else denied


def deny_filter(spans: Column, rules: Rules) -> Column:
    def keep(s: Column) -> Column:
        in_scope = s["entity"] == "PERSON"
        if rules.deny_scope == "gazetteer":
            in_scope = in_scope & s["detector"].isin(*LOOKUP_DETECTORS)
        return ~either(in_scope, _denied(s, rules), F.lit(False))

    return F.filter(spans, keep)


def score_filter(spans: Column, rules: Rules) -> Column:
    """Strictly above the threshold."""
    return F.filter(spans, lambda s: s["score"] > rules.min_score)


def combined_filter(spans: Column, combined: Column) -> Column:
    """No names where the whole answer is taken as an address."""
    return F.filter(spans, lambda s: ~(combined & (s["entity"] == "PERSON")))


def _deny_count(text: Column, rules: Rules) -> Column:
    return count_tokens(text, any_of(rules.deny_words))


def conversational_share(text: Column, rules: Rules) -> Column:
    """Share of deny words among the words of a folded text; null for a blank one."""
    return F.try_divide(_deny_count(text, rules), count_tokens(text))


def looks_conversational(text: Column, rules: Rules) -> Column:
    """One or two words: all of them deny words. More: a share above the limit (E5)."""
    if not rules.check_conversational:
        return F.lit(False)
    words, denied = count_tokens(text), _deny_count(text, rules)
    return either(words <= 2, denied == words, denied / words > rules.max_conversational_ratio)


def conversational_filter(spans: Column, turn: Turn) -> Column:
    """Name-table and model hits where no name is expected must not be small talk (E5)."""

    def keep(s: Column) -> Column:
        looked_up = (s["entity"] == "PERSON") & s["detector"].isin(*LOOKUP_DETECTORS)
        return ~either(looked_up & ~turn.expects("name"), looks_conversational(s["matched"], turn.rules), F.lit(False))

    return F.filter(spans, keep)


def apply_filters(spans: Column, turn: Turn, lookups: bool = False) -> Column:
    """E1 to E4, and E5 when spans of a name table or model may be among them."""
    kept = combined_filter(score_filter(deny_filter(spans, turn.rules), turn.rules), turn.combined)
    return conversational_filter(kept, turn) if lookups else kept
