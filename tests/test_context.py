"""The look-back over turn rows against a plain loop."""

import random

from pyspark.sql import functions as F

from hushline.functions.context import BIT
from hushline.operators.context import with_context
from hushline.operators.redaction import redact_turns
from hushline.rules import DEFAULT_RULES, KINDS
from hushline.sources.transcripts import assemble_transcripts

PHRASES = ["WHAT IS YOUR NAME", "YOUR ADDRESS AND POSTCODE", "YOUR PIN PLEASE", "HELLO", "REF NO", None, "e-mail?"]


def bits(text):
    out = 0
    for kind in KINDS:
        if any(p in text.upper() for p in DEFAULT_RULES.indicators[kind]):
            out |= BIT[kind]
    return out


def brute(rows):
    """Bits of the latest earlier turn number with text; copies of it count together."""
    expected = []
    for conv, turn, _, _ in rows:
        earlier = [(t, c) for v, t, _, c in rows if v == conv and t < turn and c is not None]
        last = max((t for t, _ in earlier), default=None)
        value = 0
        for t, c in earlier:
            if t == last:
                value |= bits(c)
        expected.append(value)
    return expected


def check(spark, rows, **options):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, content string")
    got = with_context(df.repartition(5), **options).collect()
    assert len(got) == len(rows)
    pairs = sorted((r[:4], e) for r, e in zip(rows, brute(rows)) if r[3] is not None)
    ours = sorted(((r.conv_id, r.turn, r.role, r.content), r.context) for r in got if r.content is not None)
    assert ours == pairs


def test_gaps_copies_and_slices(spark):
    rng = random.Random(7)
    rows = []
    for conv in range(12):
        for turn in sorted(rng.sample(range(60), rng.randint(1, 30))):
            rows.append((conv, turn, "agent", rng.choice(PHRASES)))
    rows += rng.sample(rows, 25)
    rng.shuffle(rows)
    check(spark, rows)
    check(spark, rows, slices=7)
    check(spark, rows, slices=1)
    check(spark, rows, slices=200)


def test_one_conversation_holds_most_turns(spark):
    rng = random.Random(3)
    rows = [(1, t, "agent", rng.choice(PHRASES)) for t in range(400)]
    rows += [(2 + i, 0, "agent", "YOUR PIN PLEASE") for i in range(50)]
    check(spark, rows, slices=16)
    # Numbers with any gaps, as time stamps have.
    check(spark, [(c, (t - 200) * 10**15 + t * t, r, x) for c, t, r, x in rows], slices=16)
    check(spark, [], slices=3)


def test_hot_conversation_is_spread(spark):
    """No shuffle is by the conversation alone, and no slice holds more than its share."""
    df = spark.range(20000).select(
        F.when(F.col("id") < 3, F.col("id")).otherwise(7).alias("conv_id"), (F.col("id") * 10**12).alias("turn"),
        F.lit("agent").alias("role"), F.lit("YOUR PIN PLEASE").alias("content"),
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        known = with_context(df, slices=8)
        plan = known._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    keys = [line.split("partitioning(")[1] for line in plan.splitlines() if "Exchange " in line]
    assert sum("conv_id" in k and "turn" in k for k in keys) == 4 and len(keys) == 6, keys
    assert not any("conv_id" in k and "turn" not in k for k in keys), keys
    dealt = df.repartitionByRange(8, "conv_id", "turn").groupBy(F.spark_partition_id()).count()
    assert dealt.agg(F.max("count")).first()[0] < 2 * 20000 / 8
    assert known.where("context > 0").count() == 20000 - 4


def test_rows_without_conversation_are_withheld(spark):
    rows = [(None, 0, "agent", "MY NAME IS SHAUNA"), (1, 0, "agent", "MY NAME IS SHAUNA")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, content string")
    got = {r.conv_id: (r.redacted, r.status) for r in redact_turns(df).collect()}
    assert got == {None: (None, "no_conversation"), 1: ("MY NAME IS [REDACTED NAME]", "ok")}


def test_no_state_between_conversations_and_any_row_order(spark):
    rows = [(c, t, "agent", "YOUR PASSWORD" if t % 2 == 0 else "B C 7") for c in range(5) for t in range(6)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, content string")
    got = {(r.conv_id, r.turn): r.redacted for r in redact_turns(df).collect()}
    for (_, turn), text in got.items():
        assert text == ("YOUR PASSWORD" if turn % 2 == 0 else "[REDACTED PASSWORD]")


def test_long_conversations_come_in_parts(spark):
    rows = [(1, t, "agent", f"T{t}") for t in range(25)] + [(2, 0, "agent", "ONLY")] * 3
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, content string")
    got = sorted((r.conv_id, r.part, r.turns, r.flat) for r in assemble_transcripts(df, part_turns=10).collect())
    assert [g[:3] for g in got] == [(1, 0, 10), (1, 1, 10), (1, 2, 5), (2, 0, 1)]
    assert " ".join(g[3] for g in got[:3]) == " ".join(f"T{t}" for t in range(25))
