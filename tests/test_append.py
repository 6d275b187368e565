import datetime
import re

import pytest
from pyspark.sql import functions as F

from hushline.plans import catalogue
from hushline.plans.job import Job, run_job
from hushline.sources.calls import call_transcripts
from hushline.sources.sinks import not_loaded, write_rows

SCHEMA = "id long, day date, said string, load_dt timestamp"
DAY = datetime.date(2024, 5, 1)


def at(micros):
    return datetime.datetime(2024, 5, 2, 10, 0, 0, micros)


def kept(spark, rows, loaded, **options):
    got = not_loaded(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(loaded, SCHEMA), **options)
    return sorted((r.id, r.day, r.said) for r in got.collect())


def test_only_what_is_not_there_stays(spark):
    loaded = [(1, DAY, "a", at(0)), (2, None, None, at(0)), (3, DAY, "c", at(0))]
    rows = [(1, DAY, "a", at(9)), (2, None, None, at(9)), (3, DAY, "changed", at(9)), (5, DAY, "x", at(9)), (5, DAY, "x", at(9))]
    for options in ({}, {"partition_by": ("day",)}):
        assert kept(spark, rows, loaded, **options) == [(3, DAY, "changed"), (5, DAY, "x"), (5, DAY, "x")]
        assert kept(spark, [], loaded, **options) == [] and len(kept(spark, rows, [], **options)) == 5
    # Without columns to ignore, a microsecond is a difference.
    assert kept(spark, [(1, DAY, "a", at(1))], loaded, ignore=()) == [(1, DAY, "a")]
    assert kept(spark, [(1, DAY, "a", at(0))], loaded, ignore=()) == []


def test_nulls_and_texts_do_not_pass_for_each_other(spark):
    loaded = [(1, DAY, "null", at(0)), (2, DAY, None, at(0)), (3, DAY, '","x":"', at(0))]
    rows = [(1, DAY, None, at(0)), (2, DAY, "null", at(0)), (2, DAY, "", at(0)), (3, DAY, '","x":"', at(0))]
    assert kept(spark, rows, loaded) == [(1, DAY, None), (2, DAY, ""), (2, DAY, "null")]


def test_clashing_names_and_long_texts(spark):
    rows = spark.createDataFrame([(1, "x" * 1_000_000, 7), (2, "y", 7)], "id long, _digest string, _digest_ int")
    got = not_loaded(rows, rows.where("id = 1"))
    assert got.columns == rows.columns and [r.id for r in got.collect()] == [2]


def test_a_repeated_append_adds_nothing(spark, tmp_path):
    rows = spark.range(20).select("id", (F.col("id") % 3).alias("part"), F.current_timestamp().alias("load_dt"))
    target = str(tmp_path / "out")
    put = lambda df, **more: write_rows(df, target, mode="append", partition_by=("part",), skip_loaded=True, **more)
    assert [put(rows.where("id < 8")), put(rows), put(rows)] == [8, 12, 0]
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == list(range(20))
    with pytest.raises(ValueError):
        write_rows(rows, target, skip_loaded=True)


def test_other_partitions_of_the_target_are_not_read(spark, tmp_path):
    target = str(tmp_path / "out")
    spark.range(50).select("id", (F.col("id") % 5).cast("int").alias("part")).write.partitionBy("part").parquet(target)
    rows = spark.createDataFrame([(1, 1), (100, 1)], "id long, part int")
    got = not_loaded(rows, spark.read.parquet(target), partition_by=("part",))
    assert [r.id for r in got.collect()] == [100]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\n]*subquery", plan, re.I), plan


def test_a_job_run_twice(spark, sf_dir):
    call_transcripts(spark, sf_dir).write.mode("overwrite").saveAsTable("append_in")
    spark.sql("DROP TABLE IF EXISTS append_out")
    job = Job("append_in", "append_out", mode="append", skip_loaded=True)
    part = Job("append_in", "append_out", mode="append", skip_loaded=True, condition="transaction_id < '5'")
    first = run_job(spark, part)
    assert 0 < first < 1500
    assert run_job(spark, job) == 1500 - first and run_job(spark, job) == 0
    out = spark.table("append_out")
    assert out.count() == out.select("transaction_id").distinct().count() == 1500


def test_overlapping_loads_are_redacted_once(spark, sf_dir, monkeypatch):
    plans = []

    def put(rows, target, **more):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return write_rows(rows, target, **more)

    monkeypatch.setattr(catalogue, "write_rows", put)
    assert catalogue.append_rerun(spark, sf_dir).count() == 1500
    assert [re.search("from_json|JsonToStructs", plan) is not None for plan in plans] == [False, False, False]
