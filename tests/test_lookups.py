"""Name tables and models next to the detectors."""

import re

from pyspark.sql import functions as F

from hushline.operators.lookups import gazetteer_detections, model_detections, name_table
from hushline.operators.redaction import redact_turns

ROWS = [
    (1, 0, "agent", "How are you"),
    (1, 1, "customer", "ask for Zelda or zelda, or Will, said ZELDA"),
    (2, 0, "agent", None),
    (3, 0, "agent", "Zelda?"),
]


def turns(spark):
    return spark.createDataFrame(ROWS, "conv_id long, turn long, role string, content string")


def test_name_table_both_ways(spark):
    names = name_table(spark.createDataFrame([("Zelda",), ("WILL",), (" ",), ("zelda ",)], "name string"))
    expected = [(1, 1, 8, 13, "Zelda"), (1, 1, 17, 22, "zelda"), (1, 1, 38, 43, "ZELDA"), (3, 0, 0, 5, "Zelda")]
    for limit in ("10m", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        found = gazetteer_detections(turns(spark), names, "conv_id")
        assert sorted((r.conv_id, r.turn, r.start, r.end, r.matched) for r in found.collect()) == expected
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_name_forms(spark):
    names = name_table(spark.createDataFrame(
        [("Zelda",), ("Jean-Paul",), ("O'Brien",), ("Mary  Ann",), ("Bo",), ("Ann",), ("A B C D E F G",)], "name string"
    ))
    texts = {
        0: "this is Zelda, and Jean-Paul met O’Brien with Mary Ann and Bo. Zelda? Zelda",
        1: "Mary, Ann; xBo Bo2 Zelda's (JEAN-PAUL)'s Mary\tann's a b c d e f x",
        2: "Jean Paul, Zelda-Bo, Bonnie O'Brienne",
    }
    rows = [(k, 0, "agent", t) for k, t in texts.items()]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, content string")
    found = gazetteer_detections(df, names, "conv_id").collect()
    got = {k: sorted(r.matched for r in found if r.conv_id == k) for k in texts}
    assert got[0] == sorted(["Zelda", "Jean-Paul", "O’Brien", "Mary Ann", "Ann", "Bo", "Zelda", "Zelda"])
    # Seven words are found by the first six, unless a deny word (A) begins them.
    assert got[1] == sorted(["Ann", "Zelda", "JEAN-PAUL", "Mary\tann", "ann"])
    assert got[2] == []
    assert all(texts[r.conv_id][r.start:r.end] == r.matched for r in found)


def test_long_names_are_compared_whole(spark):
    long = "Zelda Maria del Carmen Ruiz y Picasso Blasco"
    names = name_table(spark.createDataFrame([(long,), ("Bo",)], "name string"))
    texts = {
        0: f"this is {long.upper()} speaking",
        1: "Zelda Maria del Carmen Ruiz y Ortega",
        2: f"{long}'s dog",
        3: "Zelda Maria del Carmen Ruiz y Picasso",
    }
    rows = [(k, 0, "agent", t) for k, t in texts.items()]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, content string")
    found = gazetteer_detections(df, names, "conv_id")
    assert sorted((r.conv_id, r.matched) for r in found.collect()) == [(0, long.upper()), (2, long)]
    got = {r.conv_id: r.redacted for r in redact_turns(df, lookups=found).collect()}
    assert got[0] == "this is [REDACTED NAME] speaking" and got[1] == texts[1]
    assert gazetteer_detections(df, names.limit(0), "conv_id").collect() == []


def test_redaction_with_names(spark):
    names = name_table(spark.createDataFrame([("Zelda",)], "name string"))
    found = gazetteer_detections(turns(spark), names, "conv_id")
    got = {(r.conv_id, r.turn): r.redacted for r in redact_turns(turns(spark), lookups=found).collect()}
    assert got[1, 1] == "ask for [REDACTED NAME] or [REDACTED NAME], or Will, said [REDACTED NAME]"
    assert got[2, 0] is None and got[3, 0] == "[REDACTED NAME]?"


def test_model_hook(spark):
    def load_model():
        def model(texts):
            return [[("PERSON", m.start(), m.end(), 0.9) for m in re.finditer("[Zz]elda", t)] for t in texts]

        return model

    found = model_detections(turns(spark), load_model, "conv_id")
    got = sorted((r.conv_id, r.start, r.matched, r.detector) for r in found.collect())
    assert got == [(1, 8, "Zelda", "model"), (1, 17, "zelda", "model"), (3, 0, "Zelda", "model")]
    red = {(r.conv_id, r.turn): r.redacted for r in redact_turns(turns(spark), lookups=found).collect()}
    assert red[3, 0] == "[REDACTED NAME]?"


def test_model_hits_which_are_small_talk_go(spark):
    from hushline.operators.filters import looks_conversational
    from hushline.rules import DEFAULT_RULES

    texts = ["YOU'RE CAN'T", "JOHN SMITH PLEASE", "JOHN", "HELLO", "HELLO JOHN", "YES PLEASE JOHN", "YES JOHN SMITH NO"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(looks_conversational(F.col("t"), DEFAULT_RULES)).collect()]
    assert got == [True, False, False, True, False, True, False]


def test_names_which_begin_alike_are_joined_whole(spark):
    n = 400
    spoken = [f"Van der {chr(65 + i // 20)}{chr(97 + i % 20)}q" for i in range(n)] + [f"Mary {chr(65 + i // 20)}{chr(97 + i % 20)}z" for i in range(n)]
    names = name_table(spark.createDataFrame([(x,) for x in spoken], "name string"))
    rows = [(k, 0, "agent", f"it is {x}, not {x}'s or Mary Van der") for k, x in enumerate(spoken)]
    found = gazetteer_detections(spark.createDataFrame(rows, "conv_id long, turn long, role string, content string"), names, "conv_id")
    assert sorted((r.conv_id, r.matched) for r in found.collect()) == sorted((k, x) for k, x in enumerate(spoken) for _ in range(2))
    # One join, on all words of a name: rows of words are not multiplied by the names which begin like them.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    inner = re.findall(r"Join Inner, \((\w+)#\d+ = (\w+)#\d+\)", plan)
    assert ("_name", "_name") in inner and not any("_first" in pair for pair in inner)
