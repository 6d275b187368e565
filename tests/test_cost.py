"""What a turn costs: few groups in the patterns, one screen for all phrases, narrow rows dealt before texts are made."""

import json
import random
import re

from pyspark.sql import functions as F

from hushline.functions.context import BIT, signals
from hushline.functions.spans import SPANS_TYPE
from hushline.functions.text import any_of, pattern
from hushline.operators.context import elements_context
from hushline.operators.redaction import redact_elements, transcript_json
from hushline.plans.catalogue import queries
from hushline.rules import DEFAULT_RULES as R, INDICATORS
from hushline.sources.transcripts import ELEMENTS_TYPE


def test_letters_without_a_branch_have_no_group():
    assert any_of(["SOMEWHERE"]) == "(?:SOMEWHERE)"
    # A group a letter made 500 of them, all cleared for every text.
    assert any_of(R.deny_words).count("(") < len(set(R.deny_words))


def test_any_of_takes_the_longest_word_of_a_beginning(spark):
    rng = random.Random(3)
    for size in (1, 2, 6, 60):
        words = ["".join(rng.choice("AB'-. É") for _ in range(rng.randint(1, 5))).strip() or "A" for _ in range(size)]
        texts = ["".join(rng.choice("AB'-. É") for _ in range(30)) for _ in range(50)]
        plain = "|".join(re.escape(w) for w in sorted(set(words), key=lambda w: (-len(w), w)))
        rows = spark.createDataFrame([(t,) for t in texts], "t string")
        found = rows.select("t", F.regexp_extract_all("t", F.lit(pattern(any_of(words))), F.lit(0)).alias("f"))
        assert all(row.f == re.findall(plain, row.t) for row in found.collect())


def test_signals_are_plain_substring_tests(spark):
    rng = random.Random(4)
    parts = sorted({w for ps in INDICATORS.values() for p in ps for w in p.split()}) + ["A", "XNAMEX", "É"]
    texts = [rng.choice([" ", "", "  "]).join(rng.choice(parts) for _ in range(rng.randint(0, 5))) for _ in range(400)]
    texts += [p for ps in INDICATORS.values() for p in ps]
    for rules in (R, R.with_(indicators={**INDICATORS, "name": ("WHO ARE", "WHO IS", "WHO WAS", " ", "A-B"), "email": ("[X]",)})):
        rows = spark.createDataFrame([(t,) for t in [*texts, "WHO IS [X]", "A-B ^"]], "t string")
        for row in rows.select("t", signals(F.col("t"), rules).alias("bits")).collect():
            wanted = sum(BIT[k] for k, ps in rules.indicators.items() if any(p in row.t for p in ps))
            assert row.bits == wanted, row.t


def test_narrow_rows_are_dealt_before_texts_are_made_of_them(spark, sf_dir):
    """A table in one row group is read by one task, whatever becomes of its rows."""
    for name in ("json_bytes", "parse_transcripts", "detect_written_iban", "detect_age_money"):
        plan = queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "RoundRobinPartitioning" in plan, name


def test_transcripts_of_turns_alone_are_written_at_once(spark):
    """The same JSON as turn by turn; a null transcript stays null."""
    turn = lambda role, content: (True, None, role, content, [])
    rows = [
        [], [turn("agent", None)], [turn("", 'É "Q" \\ 😀'), turn("customer", "B")],
        [turn("agent", "A"), (False, '{"note":1}', None, None, [])], None,
    ]
    shape = f"i int, r array<struct<is_turn:boolean,raw:string,role:string,content:string,spans:{SPANS_TYPE}>>"
    column = transcript_json(F.col("r"))
    made = spark.createDataFrame(list(enumerate(rows)), shape).select("i", column.alias("json"))
    for row in made.collect():
        items = rows[row.i]
        wanted = items and [json.loads(raw) if raw else {"role": role, "content": said} for _, raw, role, said, _ in items]
        assert row.json == (None if items is None else json.dumps(wanted, separators=(",", ":")))
    assert "forall" in made._jdf.queryExecution().optimizedPlan().toString()


def test_no_case_is_left_in_the_lambdas_of_a_redaction(spark):
    """Where nothing is compiled, a CASE walks the list of its branches for each row; IF does not."""
    elements = F.from_json(F.lit("[]"), ELEMENTS_TYPE)
    plan = spark.range(1).select(redact_elements(F.when(F.col("id") >= 0, elements)).alias("r"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("CASE WHEN") == 1 and plan.count("upper(") == 1


def test_the_last_turn_asks_nothing(spark):
    """Its bits are nobody's context, also behind turns without text."""
    rows = [("A", [(True, None, "agent", c) for c in said]) for said in (
        ["YOUR NAME"], ["YOUR NAME", None, "YOUR EMAIL"], [None, "YOUR NAME", None], ["YOUR EMAIL", "X", "YOUR NAME", None, None], [],
    )]
    found = spark.createDataFrame(rows, f"k string, elements {ELEMENTS_TYPE}").select(elements_context(F.col("elements"), R).alias("c"))
    name, email = BIT["name"], BIT["email"]
    assert [r.c for r in found.collect()] == [[0], [0, name, name], [0, 0, name], [0, email, 0, name, name], []]
