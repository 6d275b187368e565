"""Summaries of scored calls: one row per call, setting and run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

FLAGS = ("competitor", "product", "cancel", "tech_issue", "compliance", "piracy", "deferred")


def setting_quality(scores: DataFrame) -> DataFrame:
    """Mean and sample standard deviation of model score and sentiment (G1)."""
    return scores.groupBy("setting").agg(
        F.avg("model_score").alias("avg_model_score"),
        F.stddev_samp("model_score").alias("std_model_score"),
        F.avg("sentiment").alias("avg_sentiment"),
        F.stddev_samp("sentiment").alias("std_sentiment"),
    )


def setting_flag_rates(scores: DataFrame) -> DataFrame:
    """Records, agreement on the reason, and the rate of each flag."""
    rates = [F.avg(F.col(f).cast("int")).alias(f"{f}_flag_rate") for f in FLAGS]
    return scores.groupBy("setting").agg(
        F.count("*").alias("records"),
        F.avg(F.col("reason_agrees").cast("int")).alias("reason_agreement_rate"),
        *rates,
    )


def setting_winners(scores: DataFrame) -> DataFrame:
    """Per setting: calls won, mean winning score, mean margin over the second.

    A call with many runs is first reduced to its best run per setting, so the
    window sees at most one row per setting. Ties go to the lower setting; a call
    with one setting has no margin.
    """
    best = scores.groupBy("call_id", "setting").agg(F.max("model_score").alias("score"))
    order = Window.partitionBy("call_id").orderBy(F.desc("score"), "setting")
    ranked = best.select(
        "setting", "score",
        F.row_number().over(order).alias("place"),
        (F.col("score") - F.lead("score").over(order)).alias("margin"),
    )
    return ranked.where("place = 1").groupBy("setting").agg(
        F.count("*").alias("calls_won"),
        F.avg("score").alias("avg_winning_score"),
        F.avg("margin").alias("avg_margin"),
    )


def setting_repeatability(scores: DataFrame) -> DataFrame:
    """Mean over calls of the variance between repeated runs of a setting."""
    runs = scores.groupBy("setting", "call_id").agg(
        F.var_samp("model_score").alias("variance"), F.count("*").alias("runs")
    )
    return runs.groupBy("setting").agg(
        F.count("*").alias("calls"),
        F.sum("runs").alias("runs"),
        F.avg("variance").alias("avg_variance"),
    )
