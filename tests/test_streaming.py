"""Streams give what batches give."""

import datetime
import json

from pyspark.sql import functions as F

from hushline.operators.redaction import redact_turns
from hushline.sources.calls import call_transcripts, call_turns
from hushline.streaming.redact import redact_transcript_stream, redact_turn_stream

NOON = datetime.datetime(2024, 1, 1, 12, tzinfo=datetime.timezone.utc)


def run(stream, name, tmp_path):
    query = (
        stream.writeStream.format("memory").queryName(name).outputMode("append")
        .option("checkpointLocation", str(tmp_path / f"{name}_cp")).start()
    )
    query.processAllAvailable()
    query.stop()


def test_transcripts(spark, sf_dir, tmp_path):
    rows = call_transcripts(spark, sf_dir)
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    run(redact_transcript_stream(stream), "whole", tmp_path)
    got = spark.table("whole")
    assert got.count() == 1500
    shown = json.loads(got.where("transaction_id = '13'").first().transcription_redacted)
    assert shown[3]["content"] == "IS [REDACTED PHONE]"


def test_turns_one_by_one(spark, sf_dir, tmp_path):
    schema = "conv_id long, turn long, role string, content string, ts timestamp"
    source = tmp_path / "turns"
    at = F.lit(NOON) + F.make_dt_interval(secs=F.col("turn"))
    whole = call_turns(spark, sf_dir).where("conv_id < 64").withColumn("ts", at)
    # A question without text, a gap in the numbers, and rows which have no place.
    whole = whole.withColumn("content", F.expr("if(conv_id = 13 and turn = 2, null, content)")).withColumn(
        "turn", F.expr("if(conv_id = 14 and turn = 3, 7, turn)")
    )
    odd = spark.createDataFrame(
        [(None, 1, "customer", "SECRET", NOON), (60, None, "customer", "SECRET", NOON)], schema
    )
    whole = whole.unionByName(odd)
    # Answers arrive before their questions; one question never arrives.
    late = whole.where("turn >= 3 or turn is null or conv_id is null")
    rest = whole.where("turn < 3 and conv_id is not null and not (conv_id = 12 and turn = 2)")
    later = spark.createDataFrame([(-1, 0, "agent", "BYE", NOON + datetime.timedelta(hours=h)) for h in (2, 4)], schema)
    # Files are read one a batch, in the order of their times.
    for i, part in enumerate([late, rest, rest.where("turn = 2"), later.limit(1), later.orderBy(F.desc("ts")).limit(1)]):
        part.coalesce(1).write.mode("append").parquet(str(source))
        import time

        time.sleep(1.1 if i < 4 else 0)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(source))
    run(redact_turn_stream(stream), "by_turn", tmp_path)
    seen = spark.table("by_turn").where("conv_id >= 0 or conv_id is null").collect()
    assert "content" not in seen[0]
    expected = {(r.conv_id, r.turn): (r.status, r.redacted) for r in redact_turns(whole).collect()}
    missing = {(r.conv_id, r.turn) for r in seen if r.status == "context_missing"}
    assert missing == {(12, 3), (13, 3), (14, 7)}
    # Nothing comes out in clear without its context; all else is as in the batch.
    assert all(r.redacted is None and r.spans is None for r in seen if r.status != "ok")
    assert all((r.status, r.redacted) == expected[r.conv_id, r.turn] for r in seen if (r.conv_id, r.turn) not in missing)
    assert {(r.conv_id, r.turn) for r in seen} == set(expected) - {(12, 2)}
    assert {r.status for r in seen if r.conv_id is None or r.turn is None} == {"no_conversation"}
