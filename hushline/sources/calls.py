"""Call-shaped transcripts derived from the ``orders`` table.

The given tables hold no trigger phrase, so the context-bound detectors would
find nothing in them. These calls are a function of the order key: four turns,
as many scenarios as there are questions, and every expected result is known in closed form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hushline.functions.rows import explode_items

NAMES = ("SHAUNA", "ADRIAN", "ROSEMARY", "TERRY", "GRACE", "STANLEY", "DAMIEN", "WILL")
DIGIT_WORDS = ("ZERO", "ONE", "TWO", "THREE", "FOUR", "FIVE", "SIX", "SEVEN", "EIGHT", "NINE")

QUESTIONS = (
    "CAN I HAVE YOUR REFERENCE NUMBER PLEASE",
    "CAN I HAVE YOUR REF NUMBER",
    "WHAT ARE THE LAST TWO DIGITS OF YOUR ACCOUNT",
    "AND THE FINAL 2 DIGITS OF THE ACCOUNT",
    "CAN I TAKE THE LAST FOUR DIGITS OF YOUR CARD",
    "CAN I HAVE YOUR FULL NAME",
    "HOW DO YOU SPELL YOUR SURNAME",
    "WHAT'S YOUR ADDRESS",
    "WHAT'S YOUR POSTCODE",
    "FULL NAME AND ADDRESS WITH THE POSTCODE",
    "WHAT IS YOUR E MAIL",
    "WHAT IS YOUR EMAIL ADDRESS",
    "CAN YOU PROVIDE YOUR PASSWORD",
    "CAN I HAVE YOUR MOBILE",
    "ANYTHING ELSE TO ADD",
    "IS THERE ANYTHING ELSE",
    "CAN I TAKE THE LAST FOUR DIGITS OF YOUR CARD",
    "HOW DO YOU SPELL YOUR SURNAME",
    "CAN I HAVE YOUR FULL NAME",
    "WHAT IS YOUR E MAIL",
    "CAN YOU PROVIDE YOUR PASSWORD",
)
SCENARIOS = len(QUESTIONS)


def dealt(rows: DataFrame) -> DataFrame:
    """The same rows in even parts, some for each core.

    For narrow rows from which texts are made: a table of a few megabytes is read in one or two tasks, but the
    text made of it is many times its size.
    """
    return rows.repartition(2 * rows.sparkSession.sparkContext.defaultParallelism)


def _name(key: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in NAMES]), (key % 8 + 1).cast("int"))


def _padded(key: Column, width: int) -> Column:
    return F.lpad(key.cast("string"), width, "0")


def _in_words(digits: Column) -> Column:
    words = digits
    for i, word in enumerate(DIGIT_WORDS):
        words = F.replace(words, F.lit(str(i)), F.lit(word + " "))
    return F.trim(words)


def _answers(key: Column) -> tuple[Column, ...]:
    eight = _padded(key, 8)
    return (
        F.concat(F.lit("YES IT'S "), _in_words(eight)),
        F.concat(F.lit("IT IS "), eight),
        F.concat(F.lit("DOUBLE "), (key % 10).cast("string")),
        F.concat(F.lit("IT ENDS "), _padded(key % 100, 2)),
        _in_words(_padded(key % 10000, 4)),
        F.concat(F.lit("IT'S "), _name(F.floor(key / 16)), F.lit(" BEESTON")),
        F.lit("G R E Y"),
        F.concat(F.lit("IT'S "), _in_words((key % 90 + 10).cast("string")), F.lit(" MILTON DRIVE")),
        F.lit("IT'S ER SEVEN SIX Q T"),
        F.lit("DAMIEN O'BRIEN TWENTY MILTON DRIVE F V FIVE EIGHT"),
        F.lit("S DOT DAVIES AT J M U DOT AC DOT UK"),
        F.lit("IT'S ADRIAN BEESTON THIRTEEN AT GMAIL DOT COM"),
        F.concat(F.lit("IT IS WRITTEN DOWN SOMEWHERE "), _in_words(_padded(key % 1000, 3)), F.lit(" C D")),
        F.concat(F.lit("IS ZERO DOUBLE SEVEN "), _in_words(eight)),
        F.concat(F.lit("MY NUMBER IS 079"), eight),
        F.lit("NO THANK YOU THAT IS FINE"),
        F.concat(F.lit("IT ENDS WITH A "), (key % 10).cast("string")),
        F.lit("IT IS B R K AND THEN AFTER THAT S T"),
        F.lit("I AM CALLED MILLICENT BEESTON"),
        F.lit("M FOR AT GMAIL DOT COM"),
        F.lit("X MARKS 7 ROSES"),
    )


def _pick(key: Column, choices) -> Column:
    out = None
    for i, choice in enumerate(choices):
        value = choice if isinstance(choice, Column) else F.lit(choice)
        out = F.when(key % SCENARIOS == i, value) if out is None else out.when(key % SCENARIOS == i, value)
    return out


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per call: conv_id, file_date, turns (array of role and content)."""
    key = F.col("o_orderkey")
    greeting = F.concat(
        F.lit("THANK YOU FOR CALLING MY NAME IS "), _name(F.floor(key / 3)), F.lit(" HOW CAN I HELP")
    )
    contents = (
        greeting,
        F.lit("YEAH HI I WANT TO CHANGE MY ORDER PLEASE"),
        _pick(key, QUESTIONS),
        _pick(key, _answers(key)),
    )
    turns = F.array(*[
        F.struct(F.lit("agent" if i % 2 == 0 else "customer").alias("role"), c.alias("content"))
        for i, c in enumerate(contents)
    ])
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderdate")
    return dealt(orders).select(
        key.alias("conv_id"), F.to_date("o_orderdate").alias("file_date"), turns.alias("turns")
    )


def call_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per turn: conv_id, turn, role, content."""
    rows = explode_items(calls(spark, sf_dir), F.col("turns"), "conv_id", position="turn")
    return rows.select("conv_id", "turn", "_item.role", "_item.content")


def call_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per call with the transcript as JSON text, as the job reads it."""
    return calls(spark, sf_dir).select(
        F.col("conv_id").cast("string").alias("transaction_id"),
        F.concat(F.lit("call-"), F.col("conv_id").cast("string")).alias("transaction_identifier"),
        "file_date",
        F.to_json("turns").alias("transcription"),
    )
