"""The first rows in an order, without sorting the rows or sending them to one task (A3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Borders tried in one pass over the keys, and keys the driver may look at itself.
BORDERS, FEW = 64, 10_000


def first_rows(rows: DataFrame, limit: int, order_by: tuple[str, ...]) -> DataFrame:
    """The first ``limit`` rows in the order of the columns, nulls first; all rows if there are no more.

    The key of the last row wanted is looked for in passes over the keys alone: each
    counts the keys between borders taken from a sample and goes on inside the one gap
    that holds it. The rows then need one filter. Rows with that very key are told apart
    by a hash of all columns, and only those alike in that as well by chance.
    """
    if rows.count() <= limit:
        return rows
    if limit <= 0:
        return rows.where(F.lit(False))
    key = F.struct(*order_by)
    value, before, same = _nth(rows.select(key.alias("k")), limit)
    at = _literal(value, rows.select(key.alias("k")))
    if before + same <= limit:
        return rows.where(key <= at)
    tied = rows.where(key == at).withColumn("_tie", F.struct(F.xxhash64(*rows.columns)))
    value, above, _ = _nth(tied.select(F.col("_tie").alias("k")), limit - before)
    edge = _literal(value, tied.select("_tie"))
    sure = tied.where(F.col("_tie") < edge)
    alike = tied.where(F.col("_tie") == edge).limit(limit - before - above)
    return rows.where(key < at).unionByName(sure.drop("_tie")).unionByName(alike.drop("_tie"))


def _literal(value, frame: DataFrame) -> Column:
    """A row of one struct column as a literal of the same type."""
    kind = frame.schema[0].dataType
    parts = [F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(value, kind.fields)]
    return F.struct(*parts).cast(kind)


def _nth(keys: DataFrame, n: int) -> tuple[tuple, int, int]:
    """The n-th smallest key, how many are smaller, how many are equal."""
    inside, before, turn = keys, 0, 0
    while True:
        total, low, high = inside.agg(F.count(F.lit(1)), F.min("k"), F.max("k")).first()
        if low == high:
            return tuple(low), before, total
        if total <= FEW:
            counts = inside.groupBy("k").count().orderBy("k").collect()
            for k, count in counts:
                if before + count >= n:
                    return tuple(k), before, count
                before += count
        turn += 1
        sampled = inside.sample(min(1.0, 8.0 * BORDERS / total), seed=turn).distinct().orderBy("k").limit(64 * BORDERS).collect()
        values = [tuple(r["k"]) for r in sampled] or [tuple(low)]
        values = values[:: max(1, len(values) // BORDERS)]
        borders = F.array(*(_literal(v, keys) for v in values))
        # Even numbers are gaps between borders, odd ones the borders themselves.
        place = F.size(F.filter(borders, lambda b: b < F.col("k"))) + F.size(F.filter(borders, lambda b: b <= F.col("k")))
        counts = {r["place"]: r["count"] for r in inside.groupBy(place.alias("place")).count().collect()}
        for p in sorted(counts):
            if before + counts[p] >= n:
                break
            before += counts[p]
        if p % 2:
            return values[p // 2], before, counts[p]
        if p // 2 > 0:
            inside = inside.where(F.col("k") > _literal(values[p // 2 - 1], keys))
        if p // 2 < len(values):
            inside = inside.where(F.col("k") < _literal(values[p // 2], keys))
