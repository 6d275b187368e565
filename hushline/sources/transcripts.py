"""Reading and parsing call transcripts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from hushline.functions import context as ctx
from hushline.functions.rows import explode_items
from hushline.functions.text import fold, let
from hushline.rules import Rules
from hushline.sources.cap import first_rows

TURNS_TYPE = "array<struct<role:string,content:string>>"
ELEMENT_TYPE = "struct<is_turn:boolean,raw:string,role:string,content:string>"
ELEMENTS_TYPE = f"array<{ELEMENT_TYPE}>"

DEFAULT_FIELDS = ("transaction_id", "transaction_identifier", "file_date", "transcription")


def select_rows(
    rows: DataFrame,
    fields: tuple[str, ...] | None = DEFAULT_FIELDS,
    condition: str = "1=1",
    limit: int | None = None,
    order_by: str | tuple[str, ...] | None = None,
) -> DataFrame:
    """Select list, row predicate and row cap (A1 to A3).

    The cap takes the first rows in ``order_by`` (by default the first field), so
    that a run can be repeated. A cap which the rows do not reach changes nothing.
    """
    out = rows.where(F.expr(condition))
    if fields:
        out = out.select(*fields)
    if limit is not None:
        keys = (order_by,) if isinstance(order_by, str) else order_by
        out = first_rows(out, limit, tuple(keys or out.columns[:1]))
    return out


def read_transcripts(
    spark: SparkSession, source: str, format: str = "table", options: dict[str, str] | None = None, **query
) -> DataFrame:
    """Scan a table, or files and other formats Spark reads, then ``select_rows``."""
    reader = spark.read.options(**(options or {}))
    if format == "table":
        rows = reader.table(source)
    elif format == "jdbc":
        rows = reader.format("jdbc").option("dbtable", source).load()
    else:
        rows = reader.format(format).load(source)
    return select_rows(rows, **query)


def _plain_elements(turns: Column) -> Column:
    return F.transform(turns, lambda t: F.struct(
        F.lit(True).alias("is_turn"),
        F.lit(None).cast("string").alias("raw"),
        F.coalesce(t["role"], F.lit("")).alias("role"),
        t["content"].alias("content"),
    )).cast(ELEMENTS_TYPE)


def _mixed_elements(text: Column) -> Column:
    """Any JSON array: an object with ``content`` is a turn, the rest is kept as JSON text."""

    def element(v: Column) -> Column:
        is_turn = F.try_variant_get(v, "$.content", "variant").isNotNull()
        return F.struct(
            is_turn.alias("is_turn"),
            F.when(~is_turn, F.to_json(v)).alias("raw"),
            F.when(is_turn, F.coalesce(F.try_variant_get(v, "$.role", "string"), F.lit(""))).alias("role"),
            F.try_variant_get(v, "$.content", "string").alias("content"),
        )

    items = F.try_variant_get(F.try_parse_json(text), "$", "array<variant>")
    return F.transform(items, element).cast(ELEMENTS_TYPE)


#: What ``parse_transcripts`` says of a transcript.
STATUSES = ("ok", "missing", "unparsable", "not_an_array")


def _is_one_array(text: Column) -> Column:
    """Nothing follows the array: its last bracket is the first that closes all that are open.

    Where no bracket closes but the last sign, that is plain to see. Of other texts the strings
    are taken out (one quote stands for each), the brackets that are left are counted up and
    down, and the count may come to nothing at the end only. The parsers cannot tell: they
    stop after the first value, whatever is behind it.
    """
    plain = text.rlike(r"\A\s*\[[^\]]*+\]\s*\z")
    looks_like = text.rlike(r"(?s)\A\s*\[.*\]\s*\z")
    bare = F.regexp_replace(text, r'(?s)"(?:[^"\\]++|\\.)*+"', '"')

    def closed_at_end(bare: Column) -> Column:
        brackets = F.regexp_replace(bare, r"[^\[\]]++", "")
        start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("ends"))

        def step(acc: Column, sign: Column) -> Column:
            depth = acc["depth"] + F.when(sign == "[", 1).otherwise(-1)
            return F.struct(depth.alias("depth"), (acc["ends"] + F.when(depth == 0, 1).otherwise(0)).alias("ends"))

        counted = F.aggregate(F.split(brackets, "(?<=.)(?=.)"), start, step, lambda acc: (acc["depth"] == 0) & (acc["ends"] == 1))
        return bare.rlike(r"\]\s*\z") & ((brackets == "[]") | counted)

    return plain | (looks_like & let(bare, closed_at_end))


def parse_transcripts(
    rows: DataFrame, column: str = "transcription", keep_original: str | None = "transcript_original"
) -> DataFrame:
    """Parse the JSON text to ``elements`` and say in ``status`` how it went.

    Most transcripts are arrays of plain turns, which one typed parse reads. Only
    where that one finds something else is the text parsed as a variant.
    ``status`` is ok, missing, unparsable or not_an_array; ``elements`` is null
    unless ok.
    """
    text = F.col(column)

    def parse(one_array: Column) -> Column:
        def choose(turns: Column) -> Column:
            plain = turns.isNotNull() & F.forall(turns, lambda t: t["content"].isNotNull())
            return F.when(plain, _plain_elements(turns)).when(one_array, _mixed_elements(text))

        # The typed parse alone would stop after the first value and lose what follows.
        return let(F.when(one_array, F.from_json(text, TURNS_TYPE)), choose)

    elements = let(_is_one_array(text), parse)
    status = (
        F.when(text.isNull(), F.lit("missing"))
        .when(F.col("elements").isNotNull(), F.lit("ok"))
        .when(F.try_parse_json(text).isNull() | text.rlike(r"\A\s*\["), F.lit("unparsable"))
        .otherwise(F.lit("not_an_array"))
    )
    parsed = rows.withColumn("elements", elements).withColumn("status", status)
    return parsed if keep_original is None else parsed.withColumn(keep_original, text)


def explode_turns(parsed: DataFrame, *keys: str) -> DataFrame:
    """One row per turn in order; elements which are no turns are left out (A5)."""
    rows = explode_items(parsed, F.col("elements"), *keys, position="turn").where(F.col("_item.is_turn"))
    return rows.select(*keys, "turn", "_item.role", "_item.content")


def quarantined(parsed: DataFrame, *keys: str) -> DataFrame:
    """Rows whose transcript could not be read. Their text is not carried along."""
    return parsed.where(F.col("status") != "ok").select(*keys, "status")


def unplaced_turns(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Turn rows without a conversation or a number; they have no place in any transcript."""
    return turns.where(F.col(conversation).isNull() | F.col(turn).isNull())


def assemble_transcripts(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn",
    role: str = "role", content: str = "content", part_turns: int = 10_000,
    rules: Rules | None = None,
) -> DataFrame:
    """Turn rows to JSON transcripts, in parts of a bounded number of turns.

    A conversation of usual length is one part, number 0. A long one becomes several
    rows, so no row and no task has to hold all of it; read in order of ``part``
    they are the whole conversation. A redelivered copy of a turn counts once, and is
    dropped before the shuffle where it meets its twin. Rows of ``unplaced_turns`` are
    left out.

    With ``rules`` each part gets ``context_in``: the bits of the latest earlier turn
    with text, from whichever part before. ``redact_transcripts`` starts from it, so
    an answer just after a border is judged by its question.
    """
    placed = turns.where(F.col(conversation).isNotNull() & F.col(turn).isNotNull()).withColumn(
        "part", F.floor(F.col(turn) / part_turns)
    )
    entry = F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(content).alias("content"))
    grouped = placed.groupBy(conversation, "part").agg(F.sort_array(F.collect_set(entry)).alias("_turns"))
    as_turns = F.transform("_turns", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content")))
    parts = grouped.select(
        conversation, "part", F.size("_turns").alias("turns"),
        F.to_json(as_turns, {"ignoreNullFields": "false"}).alias("transcription"),
        F.array_join(F.transform("_turns", lambda t: t["content"]), " ").alias("flat"),
    )
    if rules is None:
        return parts
    # Nine bits a part: a window over these, never over the texts.
    bits = let(fold(F.col(content)), lambda folded: ctx.signals(folded, rules))
    ends = placed.where(F.col(content).isNotNull()).groupBy(conversation, "part", turn).agg(F.bit_or(bits).alias("_bits"))
    ends = ends.groupBy(conversation, "part").agg(F.max_by("_bits", turn).alias("_bits"))
    known = placed.select(conversation, "part").distinct().join(ends, [conversation, "part"], "left")
    earlier = Window.partitionBy(conversation).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    start = known.select(
        conversation, "part", F.coalesce(F.last("_bits", ignorenulls=True).over(earlier), F.lit(0)).alias("context_in")
    )
    return parts.join(start, [conversation, "part"])
