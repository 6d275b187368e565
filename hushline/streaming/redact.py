"""The same redaction on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hushline.operators.context import text_signals
from hushline.operators.redaction import redact_text, redact_transcripts, turn_spans
from hushline.rules import DEFAULT_RULES, Rules
from hushline.sources.sinks import output_rows
from hushline.sources.transcripts import parse_transcripts


def redact_transcript_stream(rows: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Whole transcripts, one per row: stateless, the batch expressions as they are."""
    return output_rows(redact_transcripts(parse_transcripts(rows), rules), rules)


def redact_turn_stream(
    turns: DataFrame, rules: Rules = DEFAULT_RULES, wait: str = "10 minutes", first_turn: int = 0
) -> DataFrame:
    """Turns arriving one by one: conv_id, turn, role, content, ts; out without content.

    Each turn meets the bits of the turn numbered one less in a stream-stream outer
    join on (conversation, turn number). That key spreads a busy conversation over
    all tasks, where per-conversation state would sit in one. The look-back side
    keeps nine bits and no text. First turns need no look-back and come out at once.
    A redelivered turn of the look-back side is dropped, so no turn comes out twice
    because of it.

    No text comes out unless its context is known. When the turn before is not seen
    within ``wait`` of event time, has no text, or is missing from the numbering, the
    turn comes out with ``redacted`` null and status ``context_missing``: the batch, which
    can look further back, then gives its text. Rows without a conversation, a number or
    a time come out withheld as ``no_conversation``, as in the batch. Rows later than the
    watermark are dropped by Spark, which counts them in the progress of the query.
    """
    timed = turns.withWatermark("ts", wait)
    placed = F.col("conv_id").isNotNull() & F.col("turn").isNotNull() & F.col("ts").isNotNull()
    # A condition that is never null, so that every row goes one of the two ways.
    at_once = ~placed | F.coalesce(F.col("turn") <= first_turn, F.lit(True))
    first = timed.where(at_once).select(
        "conv_id", "turn", "role", "content", "ts",
        F.lit(0).alias("context"), F.when(placed, "ok").otherwise("no_conversation").alias("status"),
    )
    asked = (
        turns.where(placed & F.col("content").isNotNull()).select(
            F.col("conv_id").alias("_conv"),
            (F.col("turn") + 1).alias("_next"),
            text_signals(F.col("content"), rules).alias("_bits"),
            F.col("ts").alias("_ts"),
        )
        .withWatermark("_ts", wait)
        .dropDuplicatesWithinWatermark(["_conv", "_next"])
    )
    near = F.expr(f"_ts >= ts - interval {wait} and _ts <= ts + interval {wait}")
    later = timed.where(~at_once).join(
        asked, (F.col("conv_id") == F.col("_conv")) & (F.col("turn") == F.col("_next")) & near, "left"
    ).select(
        "conv_id", "turn", "role", "content", "ts",
        F.coalesce("_bits", F.lit(0)).alias("context"),
        F.when(F.col("_bits").isNull(), "context_missing").otherwise("ok").alias("status"),
    )
    content, known = F.col("content"), F.col("status") == "ok"
    return (
        first.unionByName(later)
        .withColumn("spans", F.when(known, turn_spans(content, F.col("context"), rules)))
        .withColumn("redacted", F.when(known, redact_text(content, F.col("spans"), rules)))
        .drop("content")
    )
