"""Detect, filter, merge and replace, for turns and for whole conversations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from hushline.functions.memo import per_application
from hushline.functions.rows import explode_items
from hushline.functions.spans import SPANS_TYPE, as_written, joined, merged, no_spans, replaced
from hushline.functions.text import ascii_json, either, fold, let
from hushline.operators.context import elements_context, with_context
from hushline.operators.filters import apply_filters
from hushline.operators.registry import detect, signature
from hushline.operators.spoken import Turn
from hushline.rules import DEFAULT_RULES, Rules


def turn_spans(
    content: Column, context: Column, rules: Rules = DEFAULT_RULES, *,
    only: str | None = None, filtered: bool = True, lookups: Column | None = None, folded: Column | None = None,
) -> Column:
    """Spans of one turn in order of (start, end, entity), with the text they cover.

    ``lookups`` are spans found elsewhere (name table, model) for the same turn, ``folded`` is its folded text, if
    at hand.
    """

    def search(folded: Column) -> Column:
        turn = Turn(folded, context, rules)
        found = detect(turn, only)
        if lookups is not None:
            found = joined(found, F.coalesce(lookups, no_spans()))

        def finish(spans: Column) -> Column:
            kept = apply_filters(spans, turn, lookups is not None) if filtered else spans
            return let(F.array_sort(kept), lambda s: as_written(content, s))

        return if_any(found, finish)

    def if_any(spans: Column, body: Callable[[Column], Column]) -> Column:
        """Most turns have no span, and nothing is to be done for them."""
        return let(spans, lambda s: either(F.size(s) == 0, no_spans(), body(s)))

    return either(content.isNull(), no_spans(), let(fold(content) if folded is None else folded, search))


@per_application
def _column_spans(content: str, context: str, rules: Rules, lookups: str | None, signature: tuple) -> Column:
    extra = None if lookups is None else F.col(lookups)
    return turn_spans(F.col(content), F.col(context), rules, lookups=extra)


def redact_text(content: Column, spans: Column, rules: Rules = DEFAULT_RULES, ordered: bool = False) -> Column:
    """The text with every block of overlapping spans replaced; ``ordered`` as for ``merged``."""
    done = let(merged(spans, ordered), lambda blocks: replaced(content, blocks, rules.placeholders))
    return either(F.size(spans) == 0, content, done)


def redact_elements(
    elements: Column, rules: Rules = DEFAULT_RULES, context_in: Column | None = None, lookups: Column | None = None,
) -> Column:
    """Redact a conversation held as an array, in place and in order.

    The array never leaves its row: no shuffle, and no size limit beyond the row.
    ``context_in`` is the context of the first element. ``lookups`` holds spans found
    elsewhere, a map from the place of an element to its spans.
    """

    def each(contexts: Column, items: Column, folded: Column) -> Column:
        def one(e: Column, i: Column) -> Column:
            def rebuild(spans: Column) -> Column:
                return F.struct(
                    e["is_turn"].alias("is_turn"),
                    e["raw"].alias("raw"),
                    e["role"].alias("role"),
                    redact_text(e["content"], spans, rules, ordered=True).alias("content"),
                    spans.alias("spans"),
                )

            extra = None if lookups is None else F.try_element_at(lookups, i)
            spans = turn_spans(e["content"], F.get(contexts, i), rules, lookups=extra, folded=F.get(folded, i))
            return let(either(e["is_turn"], spans, no_spans()), rebuild)

        return F.transform(items, one)

    def known(items: Column, folded: Column) -> Column:
        return let(elements_context(items, rules, context_in, folded), lambda contexts: each(contexts, items, folded))

    # Folded once, for the context and the search.
    return let(elements, lambda items: let(F.transform(items, lambda e: fold(e["content"])), lambda folded: known(items, folded)))


@per_application
def _redacted_column(elements: str, start: str | None, lookups: str | None, rules: Rules, signature: tuple) -> Column:
    named = [None if c is None else F.col(c) for c in (start, lookups)]
    return redact_elements(F.col(elements), rules, *named)


def redact_transcripts(
    parsed: DataFrame, rules: Rules = DEFAULT_RULES, lookups: DataFrame | None = None, keys: tuple[str, ...] = (),
) -> DataFrame:
    """Add ``redacted``: the conversation with its spans, null where parsing failed.

    A column ``context_in`` is the context of the first turn (see ``assemble_transcripts``).
    ``lookups`` are detections of a name table or model in the turns of ``explode_turns``,
    by ``keys`` and ``turn``. They become one map a conversation before they are joined,
    so the transcripts themselves are shuffled at most once.
    """
    start = "context_in" if "context_in" in parsed.columns else None
    if lookups is None:
        return parsed.withColumn("redacted", _redacted_column("elements", start, None, rules, signature()))
    spans = lookup_spans(lookups, *keys, "turn")
    entry = F.struct(F.col("turn").cast("int").alias("key"), F.col("_lookups").alias("value"))
    maps = spans.groupBy(*keys).agg(F.map_from_entries(F.collect_list(entry)).alias("_lookups"))
    joined = parsed.join(maps, list(keys), "left")
    return joined.withColumn(
        "redacted", _redacted_column("elements", start, "_lookups", rules, signature())
    ).drop("_lookups")


def redact_turns(
    turns: DataFrame, rules: Rules = DEFAULT_RULES, lookups: DataFrame | None = None, **columns: str
) -> DataFrame:
    """Redact a table with one row per turn; one row out for each row in.

    Adds ``context``, ``spans``, ``redacted`` and ``status``. Rows without a
    conversation id have no context to judge by, so their text is withheld.
    """
    conversation = columns.get("conversation", "conv_id")
    turn = columns.get("turn", "turn")
    text = columns.get("content", "content")
    content = F.col(text)
    known = with_context(turns, rules, **columns)
    extra = None
    if lookups is not None:
        known = known.join(lookup_spans(lookups, conversation, turn), [conversation, turn], "left")
        extra = "_lookups"
    placed = F.col(conversation).isNotNull() & F.col(turn).isNotNull()
    return (
        known.withColumn("spans", _column_spans(text, "context", rules, extra, signature()))
        .drop("_lookups")
        .withColumn("redacted", F.when(placed, redact_text(content, F.col("spans"), rules)))
        .withColumn("status", either(placed, F.lit("ok"), F.lit("no_conversation")))
    )


def lookup_spans(detections: DataFrame, *keys: str) -> DataFrame:
    """Spans of a name table or model, one array per turn.

    A turn has at most one span per place in its text, so the group is bounded by
    the turn; copies are combined before the shuffle.
    """
    span = F.struct("start", "end", "entity", F.upper("matched").alias("matched"), "score", "detector")
    return detections.groupBy(*keys).agg(
        F.collect_set(span).cast(SPANS_TYPE).alias("_lookups")
    )


# -- shapes of a redacted conversation ---------------------------------------

def transcript_json(redacted: Column) -> Column:
    """Compact ASCII JSON of the conversation; elements which are no turns keep their value.

    Usually all are turns, and one call writes the array.
    """
    options = {"ignoreNullFields": "false"}

    def turn(e: Column) -> Column:
        return F.struct(e["role"].alias("role"), e["content"].alias("content"))

    def text(e: Column) -> Column:
        return either(e["is_turn"], F.to_json(turn(e), options), e["raw"])

    mixed = F.concat(F.lit("["), F.array_join(F.transform(redacted, text), ","), F.lit("]"))
    plain = F.forall(redacted, lambda e: e["is_turn"])
    return ascii_json(either(plain, F.to_json(F.transform(redacted, turn), options), mixed))


def flat_transcript(redacted: Column) -> Column:
    """The contents of all turns joined by one blank."""
    contents = F.transform(F.filter(redacted, lambda e: e["is_turn"]), lambda e: e["content"])
    return F.array_join(contents, " ")


def redacted_turns(redacted: DataFrame, *keys: str) -> DataFrame:
    """One row per turn of redacted conversations."""
    rows = explode_items(redacted, F.col("redacted"), *keys, position="turn").where(F.col("_item.is_turn"))
    return rows.select(*keys, "turn", "_item.role", "_item.content", "_item.spans")
