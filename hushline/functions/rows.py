"""From arrays in a row to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def explode_items(df: DataFrame, items: Column, *keep: Column | str, position: str | None = None) -> DataFrame:
    """One row per item, as ``_item``, with its position if asked; none for an empty array.

    A plain explode makes the optimizer test the array before it, and so evaluate the
    whole expression which made it a second time. The outer form does not, and the rows
    it adds for empty arrays are dropped after it.
    """
    if position is None:
        made = F.explode_outer(items).alias("_item")
    else:
        made = F.posexplode_outer(items).alias(position, "_item")
    rows = df.select(*keep, made).where(F.col("_item").isNotNull())
    return rows if position is None else rows.withColumn(position, F.col(position).cast("long"))
