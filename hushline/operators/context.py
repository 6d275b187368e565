"""What the turn before makes us expect, for tables with one row per turn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from hushline.functions import context as ctx
from hushline.functions.text import either, fold, let
from hushline.rules import DEFAULT_RULES, KINDS, Rules

def text_signals(content: Column, rules: Rules) -> Column:
    """The kinds a turn asks for; the text is folded once."""
    return let(fold(content), lambda folded: ctx.signals(folded, rules))


def with_context(
    turns: DataFrame,
    rules: Rules = DEFAULT_RULES,
    conversation: str = "conv_id",
    turn: str = "turn",
    content: str = "content",
    slices: int | None = None,
) -> DataFrame:
    """Add ``context``: the bits of the latest earlier turn which has text, else 0.

    A segmented scan over all turns in the order of (conversation, turn). Only narrow rows
    (conversation, turn, bits) take part; redelivered turns are combined before their first
    shuffle. The rows are dealt to ``slices`` (by default as many as there are shuffle
    partitions) by ranges of that order, so a conversation of any length is cut wherever its
    share of the rows says, however its turns are numbered. Inside a slice each row looks
    at the one before it. The first row of a slice finds it among the edges, two rows a slice,
    which are one small group. What comes before belongs to the same conversation, or counts
    as nothing. The wide rows then join on (conversation, turn), a key which spreads a long
    conversation evenly; copies of one turn on the wide side are left to the skew join of
    adaptive execution.
    """
    if slices is None:
        slices = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    seen = (
        turns.where(F.col(conversation).isNotNull() & F.col(turn).isNotNull() & F.col(content).isNotNull())
        .select(
            F.col(conversation), F.col(turn),
            text_signals(F.col(content), rules).alias("_bits"),
        )
        .groupBy(conversation, turn)
        .agg(F.bit_or("_bits").alias("_bits"))
    )
    # The number of a slice is made once, below the one plan that uses it.
    dealt = seen.repartitionByRange(slices, conversation, turn).withColumn("_slice", F.spark_partition_id())
    own = F.struct(F.col(conversation).alias("conversation"), F.col("_bits").alias("bits"))
    in_slice = Window.partitionBy("_slice").orderBy(conversation, turn)
    looked = dealt.select(
        conversation, turn, "_bits", "_slice", F.lag(own).over(in_slice).alias("_before"),
        F.lead(F.lit(True)).over(in_slice).isNull().alias("_last"),
    )
    edge = F.col("_before").isNull() | F.col("_last")
    edges = Window.partitionBy(F.when(edge, F.lit(-1)).otherwise(F.col("_slice"))).orderBy(conversation, turn)
    found = looked.select(conversation, turn, F.coalesce("_before", F.lag(own).over(edges)).alias("_before"))
    before = found.select(
        conversation, turn,
        F.when(F.col("_before.conversation") == F.col(conversation), F.col("_before.bits")).otherwise(F.lit(0)).alias("context"),
    )
    return turns.join(before, [conversation, turn], "left").withColumn(
        "context", F.coalesce("context", F.lit(0))
    )


def flag_columns(context: Column, prefix: str = "expects_") -> list[Column]:
    """The nine flags and the combined mode as boolean columns."""
    flags = [ctx.expects(context, kind).alias(prefix + kind) for kind in KINDS]
    return [*flags, ctx.combined(context).alias(prefix + "address_with_postcode")]


def elements_context(
    elements: Column, rules: Rules, context_in: Column | None = None, folded: Column | None = None,
) -> Column:
    """Context bits for each element of a conversation held as an array.

    Elements which are no turns, and turns without text, do not move the context.
    ``context_in`` is the context of the first element, where the array is a later part
    of a conversation. One running pass over the bits, however many elements have none:
    the bits of a stretch are looked up by the number of the latest element with text.
    What the last element asks for is asked of no other. ``folded`` holds the folded contents, if they are at hand.
    """
    def asks(e: Column, i: Column) -> Column:
        bits = text_signals(e["content"], rules) if folded is None else ctx.signals(F.get(folded, i), rules)
        heard = (i < F.size(elements) - 1) & e["is_turn"] & e["content"].isNotNull()
        return either(heard, bits, F.lit(None).cast("int"))

    own = F.transform(elements, asks)
    start = F.lit(0) if context_in is None else F.coalesce(context_in, F.lit(0))

    def look_back(bits: Column) -> Column:
        def before(_: Column, i: Column) -> Column:
            return F.coalesce(F.get(bits, i - 1), either(i == 0, start, F.lit(None).cast("int")))

        direct = F.transform(bits, before)
        # Only where an element without text comes in between is there anything to fill.
        return either(~F.exists(direct, lambda b: b.isNull()), direct, filled(bits, start))

    return let(own, look_back)


def filled(bits: Column, start: Column) -> Column:
    """For each place the latest earlier value which is not null, else ``start``.

    The values and their places are gathered once; each then holds up to the place of
    the next, so a repeat of it covers its stretch.
    """
    places = F.filter(F.transform(bits, lambda b, i: either(b.isNotNull(), i, F.lit(None).cast("int"))), lambda i: i.isNotNull())
    size = F.size(bits)

    def stretches(at: Column) -> Column:
        head = F.array_repeat(start, F.coalesce(F.get(at, F.lit(0)) + 1, size))

        def stretch(i: Column, k: Column) -> Column:
            until = F.coalesce(F.get(at, k + 1), size - 1)
            return F.array_repeat(F.get(bits, i), until - i)

        return F.slice(F.concat(head, F.flatten(F.transform(at, stretch))), F.lit(1), size)

    return let(places, stretches)
