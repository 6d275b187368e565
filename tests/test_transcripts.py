"""Parsing, edge inputs, JSON output, sinks, rules and the whole job."""

import datetime
import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hushline.operators.audit import audit_string
from hushline.operators.redaction import flat_transcript, redact_transcripts, transcript_json
from hushline.plans.job import Job, JobError, redacted_output, run_job
from hushline.rules import DEFAULT_RULES, Rules, RulesError
from hushline.sources.calls import call_transcripts
from hushline.sources.sinks import OUTPUT_COLUMNS, output_rows, write_rows
from hushline.sources.transcripts import (
    assemble_transcripts, parse_transcripts, quarantined, read_transcripts, select_rows, unplaced_turns,
)

EDGES = {
    "empty": ("[]", "ok", []),
    "null": (None, "missing", None),
    "no json": ("hello", "unparsable", None),
    "cut": ('[{"role":"a","content":"x"}', "unparsable", None),
    "trailing": ('[{"role":"a","content":"x"}] more', "unparsable", None),
    "object": ('{"role":"a","content":"x"}', "not_an_array", None),
    "number": ("7", "not_an_array", None),
    "json null": ("null", "not_an_array", None),
    "blank": ("", "unparsable", None),
    "plain": (' [ {"role":"a","content":"x"} ] ', "ok", [{"role": "a", "content": "x"}]),
    "extra keys": ('[{"id":1,"role":"a","content":"x"}]', "ok", [{"role": "a", "content": "x"}]),
    "no role": ('[{"content":"x"}]', "ok", [{"role": "", "content": "x"}]),
    "null content": ('[{"role":"a","content":null}]', "ok", [{"role": "a", "content": None}]),
    "number content": ('[{"role":"a","content":5}]', "ok", [{"role": "a", "content": "5"}]),
    "bare": ('["s",{"note":[1,{"k":"v"}]},7,null,{"role":"a","content":"x"}]', "ok",
             ["s", {"note": [1, {"k": "v"}]}, 7, None, {"role": "a", "content": "x"}]),
    "unicode": ('[{"role":"a","content":"\\u00e9 \\ud83d\\ude00 \\"q\\" \\\\ \\n"}]', "ok",
                [{"role": "a", "content": 'é \U0001F600 "q" \\ \n'}]),
    # What is no turn does not move the context, nor does a turn without text.
    "context": ('[{"role":"a","content":"YOUR PASSWORD"},"YOUR NAME",{"role":"b","content":null},'
                '{"role":"c","content":"B C 7"}]', "ok",
                [{"role": "a", "content": "YOUR PASSWORD"}, "YOUR NAME", {"role": "b", "content": None},
                 {"role": "c", "content": "[REDACTED PASSWORD]"}]),
}


def test_edge_inputs(spark):
    rows = [(k, v[0]) for k, v in EDGES.items()]
    done = redact_transcripts(parse_transcripts(spark.createDataFrame(rows, "k string, transcription string")))
    for r in done.select("k", "status", transcript_json(F.col("redacted")).alias("j")).collect():
        _, status, turns = EDGES[r.k]
        assert (r.k, r.status) == (r.k, status)
        assert (None if r.j is None else json.loads(r.j)) == turns


def test_quarantine_carries_no_text(spark):
    rows = [(k, v[0]) for k, v in EDGES.items()]
    out = quarantined(parse_transcripts(spark.createDataFrame(rows, "k string, transcription string")), "k")
    assert out.columns == ["k", "status"]
    assert {r.k for r in out.collect()} == {k for k, v in EDGES.items() if v[1] != "ok"}


def test_flat_text_and_audit(spark):
    text = ('[{"role":"agent","content":"MY NAME IS JANE"},{"role":"customer","content":"CALL 07945058361 OR 07945058362"},'
            '{"note":1},{"role":"x","content":null},{"role":"agent","content":"BYE"}]')
    done = redact_transcripts(parse_transcripts(spark.createDataFrame([(text,)], "transcription string")))
    red = F.col("redacted")
    hashed = DEFAULT_RULES.with_(audit_text="none")
    row = done.select(flat_transcript(red).alias("f"), audit_string(red).alias("a"), audit_string(red, hashed).alias("n")).first()
    assert row.f == "MY NAME IS [REDACTED NAME] CALL [REDACTED PHONE] OR [REDACTED PHONE] BYE"
    assert row.a == ("[agent] PERSON: JANE (score: 0.85); [customer] PHONE_NUMBER: 07945058361 (score: 0.85); "
                     "[customer] PHONE_NUMBER: 07945058362 (score: 0.85)")
    assert row.n.startswith("[agent] PERSON:  (score: 0.85); ")


def test_no_shuffle_between_scan_and_write(spark, sf_dir, tmp_path):
    call_transcripts(spark, sf_dir).write.parquet(str(tmp_path / "calls"))
    plan = output_rows(redact_transcripts(parse_transcripts(spark.read.parquet(str(tmp_path / "calls")))))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Python" not in text
    # The text is parsed once and each pattern is looked for once.
    assert text.count("from_json") == 1


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    rows = read_transcripts(
        spark, f"{sf_dir}/documents.parquet", "parquet", fields=("doc_id", "lang"), condition="n_chars > 500"
    )
    text = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(n_chars,500)" in text
    assert "text:" not in text.split("ReadSchema")[1]


def test_row_cap_is_ordered(spark, monkeypatch):
    from hushline.sources import cap

    df = spark.range(1000, 0, -1).withColumn("x", F.lit(1))
    for few in (10_000, 3):
        monkeypatch.setattr(cap, "FEW", few)
        got = select_rows(df, ("id",), limit=5)
        assert sorted(r.id for r in got.collect()) == [1, 2, 3, 4, 5]
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "TakeOrdered" not in plan and "SinglePartition" not in plan and "Exchange" not in plan
    # A cap which is not reached leaves the scan as it is.
    whole = select_rows(df, ("id",), limit=999_999_999)
    assert whole.count() == 1000 and "Filter" not in whole._jdf.queryExecution().executedPlan().toString()
    assert select_rows(df, ("id",), limit=0).collect() == []


def test_row_cap_with_ties_nulls_and_repeats(spark, monkeypatch):
    import random

    from hushline.sources import cap

    monkeypatch.setattr(cap, "FEW", 5)
    monkeypatch.setattr(cap, "BORDERS", 4)
    draw = random.Random(1)
    rows = [(draw.choice([None, "a", "b", "b", "b", "c"]), draw.choice([None, 1, 2, 3]), draw.randrange(40)) for _ in range(400)]
    rows += [("b", 2, 7)] * 50
    df = spark.createDataFrame(rows, "s string, n int, v int").repartition(5)
    order = lambda r: tuple((x is not None, x or 0) if not isinstance(x, str) else (True, x) for x in r[:2])
    for limit in (1, 60, 150, 222, 300, 449, 450):
        got = [tuple(r) for r in cap.first_rows(df, limit, ("s", "n")).collect()]
        assert len(got) == limit
        # The keys are those of the first rows; no row comes more often than it is there.
        assert sorted(map(order, got)) == sorted(map(order, rows))[:limit]
        assert not Counter(got) - Counter(rows)
    again = cap.first_rows(df.repartition(3), 222, ("s", "n")).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, cap.first_rows(df, 222, ("s", "n")).collect()))


def test_text_after_the_array_is_unparsable(spark):
    one = '[{"role":"a","content":"x"}]'
    texts = [one, one + " ", one + one, one + "," + one, one + ' null,["y"]', one + " junk [1]", '[{"content":"a ] b"}]', '["]"] ', '[[1],[2]]']
    got = parse_transcripts(spark.createDataFrame([(t,) for t in texts], "transcription string")).collect()
    assert [r.status for r in got] == ["ok", "ok"] + ["unparsable"] * 4 + ["ok"] * 3


def test_arrays_that_close_and_open_again(spark):
    x, y = '{"role":"a","content":"x ] y"}', '{"role":"b","content":"[ z \\" ]"}'
    lost = [
        f"[{x}]] junk [[{y}]", f"[{x}]] , [[{y}]", f"[{x}]][[{y}]", f"[{x}][{y}]", f"[[{x}]]] [[[{y}]]", f'[{x}] "[" , "]"', f'[{x}] ["]',
        f"[{x}]]", f"[[{x}]", f'[{x},"]"] ]',
    ]
    whole = [f"[{x},{y}]", f"[[{x}],[[]],{y}]", f' [ {x} , ["]"], {y} ] \n', '["[[", "]", "\\\\"]', "[[[[]]]]", f"[{x}, {{\"a\":[1,[2]]}}]"]
    got = parse_transcripts(spark.createDataFrame([(t,) for t in lost + whole], "transcription string")).collect()
    assert [r.status for r in got] == ["unparsable"] * len(lost) + ["ok"] * len(whole)
    assert [len(r.elements) for r in got[len(lost):]] == [2, 3, 3, 3, 1, 2]
    deep = "[" * 400 + "]" * 400
    many = "[" + ",".join(['{"content":"]"},[]'] * 20_000) + "]"
    got = parse_transcripts(spark.createDataFrame([(many,), (many + "]",), (deep,)], "transcription string")).collect()
    assert [r.status for r in got][:2] == ["ok", "unparsable"] and len(got[0].elements) == 40_000


def test_table_replace_keeps_the_table_and_other_partitions(spark):
    rows = spark.range(10).select("id", (F.col("id") % 2).alias("part"))
    put = lambda df, **options: write_rows(df, "kept", format="table", partition_by=("part",), **options)
    spark.sql("DROP TABLE IF EXISTS kept")
    assert put(rows) == 10
    spark.sql("ALTER TABLE kept SET TBLPROPERTIES ('owner_note' = 'mine')")
    new = spark.createDataFrame([(1, 100), (1, 101)], "part long, id long")
    assert put(new, only_touched_partitions=True) == 2
    assert sorted(map(tuple, spark.table("kept").select("id", "part").collect())) == [(0, 0), (2, 0), (4, 0), (6, 0), (8, 0), (100, 1), (101, 1)]
    assert put(rows.where("id < 3")) == 3 and spark.table("kept").count() == 3
    assert put(rows.where("id = 9"), mode="append") == 1 and spark.table("kept").count() == 4
    assert "owner_note" in str(spark.sql("SHOW TBLPROPERTIES kept").collect())
    with pytest.raises(ValueError):
        put(rows.drop("id"))
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_context_passes_part_borders(spark):
    turns = spark.createDataFrame(
        [(1, 0, "agent", "CAN YOU PROVIDE YOUR PASSWORD"), (1, 1, "customer", None), (1, 2, "customer", None),
         (1, 3, "customer", None), (1, 4, "customer", "B C SEVEN SEVEN"), (2, 0, "a", "HI"), (None, 1, "x", "lost"), (3, None, "x", "lost")],
        "conv_id long, turn long, role string, content string",
    )
    for size in (1, 2, 3, 100):
        parts = assemble_transcripts(turns, part_turns=size, rules=DEFAULT_RULES)
        done = redact_transcripts(parse_transcripts(parts))
        texts = [e.content for r in done.where("conv_id = 1").orderBy("part").collect() for e in r.redacted]
        assert texts == ["CAN YOU PROVIDE YOUR PASSWORD", None, None, None, "[REDACTED PASSWORD]"]
        assert {r.conv_id for r in done.collect()} == {1, 2}
    assert unplaced_turns(turns).count() == 2


def test_overwrite_append_and_count(spark, sf_dir, tmp_path):
    target = str(tmp_path / "out")
    rows = spark.range(10).select("id", (F.col("id") % 2).alias("part"))
    assert write_rows(rows, target, partition_by=("part",)) == 10
    assert write_rows(rows, target, partition_by=("part",)) == 10
    assert spark.read.parquet(target).count() == 10
    assert write_rows(rows.where("part = 1"), target, mode="append", partition_by=("part",)) == 5
    assert spark.read.parquet(target).count() == 15
    # Only the touched partition is replaced.
    new = rows.where("part = 1").limit(2)
    assert write_rows(new, target, partition_by=("part",), only_touched_partitions=True) == 2
    assert spark.read.parquet(target).count() == 7
    assert write_rows(rows, str(tmp_path / "json"), format="json", batch_size=3) == 10
    with pytest.raises(ValueError):
        write_rows(rows, target, mode="merge")


def job_file(tmp_path):
    doc = {
        "dataset": {"input": "default", "output": "default"},
        "tables": {
            "source": {"name": "calls_in", "columns": {
                "transaction_id": "transaction_id", "transaction_identifier": "transaction_identifier",
                "transcription_file_dt": "day", "input_transcript": "words"}},
            "target": {"name": "calls_out", "columns": {"file_date": "day", "redacted_entity": "found"}},
        },
        "processing": {
            "limit": 100, "batch_size": 40, "condition": "1=1",
            "selected_fields": ["transaction_id", "transaction_identifier", "day", "words"],
        },
        "pii_entities": {"PERSON": "<NAME>", "PHONE_NUMBER": "<PHONE>"},
        "context_indicators": {k: list(v) for k, v in DEFAULT_RULES.indicators.items()},
    }
    path = tmp_path / "job.json"
    path.write_text(json.dumps(doc))
    return path


def test_job_from_tables_to_table(spark, sf_dir, tmp_path):
    path = job_file(tmp_path)
    source = call_transcripts(spark, sf_dir).withColumnsRenamed({"file_date": "day", "transcription": "words"})
    broken = spark.createDataFrame(
        [("x1", "bad", datetime.date(2020, 1, 1), "oops")],
        "transaction_id string, transaction_identifier string, day date, words string",
    )
    source.unionByName(broken).write.mode("overwrite").saveAsTable("calls_in")
    job, rules = Job.from_file(str(path)), Rules.from_files(str(path))
    assert run_job(spark, job, rules) == 100
    assert run_job(spark, job, rules) == 100
    out = spark.table("calls_out")
    assert out.count() == 100
    assert out.columns == ["day", "transaction_id", "transaction_identifier", "transcription_redacted", "found", "load_dt"]
    first = out.where("transaction_id = '0'").first()
    assert "MY NAME IS <NAME> HOW" in first.transcription_redacted
    # No cap, with the unreadable call set aside.
    whole = Job.from_file(str(path), limit=None, target="calls_all")
    assert run_job(spark, whole, rules, quarantine_target="calls_bad") == 1501
    assert [tuple(r)[:2] for r in spark.table("calls_bad").collect()] == [("x1", "bad")]
    # Counted during the write: the same, and no second scan where all were read.
    counts = {}
    assert run_job(spark, whole, rules, quarantine_target="calls_bad", counts=counts) == 1501
    assert (counts["status ok"], counts["status unparsable"], counts["status missing"]) == (1500, 1, 0)
    # Spans of entities which this job's placeholders do not name are in the whole number alone.
    assert counts["entities"] > sum(n for name, n in counts.items() if name.startswith("entity ")) > 1500
    assert spark.table("calls_bad").count() == 1
    read = Job.from_file(str(path), limit=None, target="calls_read", condition="transaction_id <> 'x1'")
    assert run_job(spark, read, rules, quarantine_target="calls_bad", counts=counts) == 1500
    assert spark.table("calls_bad").count() == 0
    with pytest.raises(JobError):
        run_job(spark, Job("calls_in", "calls_all", mode="append", skip_loaded=True), rules, counts={})
    assert spark.table("calls_all").where("transaction_id = 'x1'").first().transcription_redacted is None


def test_job_with_missing_columns_fails_early(spark, tmp_path):
    spark.createDataFrame([(1,)], "transaction_id int").write.mode("overwrite").saveAsTable("calls_thin")
    with pytest.raises(JobError):
        redacted_output(spark, Job("calls_thin", "x", fields=("transaction_id",)))
    path = tmp_path / "bad.json"
    path.write_text('{"tables": {}}')
    with pytest.raises(JobError):
        Job.from_file(str(path))


def test_output_columns(spark, sf_dir):
    out = output_rows(redact_transcripts(parse_transcripts(call_transcripts(spark, sf_dir))))
    assert tuple(out.columns) == OUTPUT_COLUMNS
    assert dict(out.dtypes)["load_dt"] == "timestamp" and dict(out.dtypes)["file_date"] == "date"


def test_rules_from_yaml_keep_words_and_fail_loudly(tmp_path):
    yaml = pytest.importorskip("yaml")
    words = tmp_path / "words.yaml"
    doc = {"deny_list": ["I", "Yes"], "number_words": ["ONE"], "filler_words": ["so"], "name_boundaries": ["x"],
           "validation": {"person_entity": {"max_conversational_ratio": 0.25, "enabled": False}},
           "detection_scores": {"min_score_threshold": 0.5}}
    words.write_text(yaml.safe_dump(doc).replace("- x", "- ON\n- OFF"))
    rules = Rules.from_files(str(job_file(tmp_path)), str(words))
    assert rules.name_boundaries == ("ON", "OFF") and rules.deny_words == ("I", "YES")
    assert (rules.min_score, rules.max_conversational_ratio, rules.check_conversational) == (0.5, 0.25, False)
    words.write_text("deny_list: [A]\n")
    with pytest.raises(RulesError):
        Rules.from_files(str(job_file(tmp_path)), str(words))
    for broken in ({"number_words": ()}, {"indicators": {}}, {"audit_text": "x"}, {"deny_scope": "x"}):
        with pytest.raises(RulesError):
            Rules(**broken)
    assert Rules() == DEFAULT_RULES and hash(Rules()) == hash(DEFAULT_RULES)
