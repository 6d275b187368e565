"""Packing into length buckets whose bounds are optimal for the whole corpus.

The histogram of lengths of all documents, in cells of relative width 1/256 (exact below
512), has at most some 14,000 rows whatever the corpus, and comes to the driver. Dynamic
programming over it finds the bucket bounds with the least padding in total; as the cost of
a bucket is its bound times its count, each layer is a minimum over lines, found in one
sweep. Then batches of a token budget form inside each bucket.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame, Window, functions as F

from hushline.llm.storage import free_name

BUCKETS = 16
#: Tokens of a batch, padding included.
BUDGET = 65_536
#: Batches of a numbering group; the last batch of each group may be short.
GROUP_BATCHES, GROUP_ROWS = 64, 4096


def length_cell(length: Column) -> Column:
    """The length rounded up to nine leading binary digits; at least 1."""
    n = F.greatest(length.cast("long"), F.lit(1).cast("long"))
    unit = F.pow(F.lit(2.0), F.greatest(F.length(F.bin(n)) - 9, F.lit(0))).cast("long")
    return n + F.pmod(-n, unit)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\t-\\r]+")), F.lit(0)).cast("long")


def best_bounds(histogram: list[tuple[int, int]], buckets: int) -> list[int]:
    """Upper bounds of at most `buckets` buckets with the least sum of bound times count.

    histogram: (length, count), lengths distinct. Exact, by whole numbers.
    """
    cells = sorted(histogram)
    if not cells:
        return []
    sums = [0]
    for _, count in cells:
        sums.append(sums[-1] + count)
    n = len(cells)
    cost = [None] * (n + 1)
    cost[0] = 0
    chosen: list[list[int]] = []
    for _ in range(min(buckets, n)):
        following, origin = [None] * (n + 1), [0] * (n + 1)
        following[0] = 0
        lines: deque[tuple[int, int, int]] = deque()  # slope -sums[i], intercept cost[i], i
        for j in range(1, n + 1):
            if cost[j - 1] is not None:
                line = (-sums[j - 1], cost[j - 1], j - 1)
                while len(lines) > 1 and _needless(lines[-2], lines[-1], line):
                    lines.pop()
                lines.append(line)
            x = cells[j - 1][0]
            while len(lines) > 1 and lines[1][0] * x + lines[1][1] <= lines[0][0] * x + lines[0][1]:
                lines.popleft()
            slope, intercept, i = lines[0]
            following[j], origin[j] = slope * x + intercept + x * sums[j], i
        chosen.append(origin)
        cost = following
    bounds, j = [], n
    for origin in reversed(chosen):
        if j == 0:
            break
        bounds.append(cells[j - 1][0])
        j = origin[j]
    return bounds[::-1]


def _needless(a: tuple[int, int, int], b: tuple[int, int, int], c: tuple[int, int, int]) -> bool:
    """Whether line b is nowhere the least, between a (steeper before) and c."""
    return (c[1] - a[1]) * (a[0] - b[0]) <= (b[1] - a[1]) * (a[0] - c[0])


def histogram(lengths: DataFrame, column: str) -> DataFrame:
    """(cell, count, longest length) of all rows; null lengths count as 0."""
    length = F.coalesce(F.col(column), F.lit(0))
    return lengths.groupBy(length_cell(length).alias("cell")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.greatest(length, F.lit(1))).alias("longest")
    )


def packed(docs: DataFrame, length: str, buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """The rows with bucket, width, batch_group, batch and slot.

    Rows of one (bucket, batch_group, batch) are a batch: at most budget // width rows, each
    padded to `width` tokens; a document longer than the budget is a batch of its own. Null
    and zero lengths go to the first bucket. Repeated rows and null keys are rows like others;
    an empty table gives no rows. Clashing column names are lengthened by underscores.

    A numbering group has a bounded number of rows, dealt by the row's number in its scan, so
    no bucket, however full, is one task.
    """
    cells = [(r["longest"], r["n"]) for r in histogram(docs.select(length), length).collect()]
    bounds = best_bounds(cells, buckets)
    counts = [0] * len(bounds)
    for longest, n in cells:
        counts[next(k for k, b in enumerate(bounds) if longest <= b)] += n
    groups = [max(1, -(-n // max(GROUP_ROWS, GROUP_BATCHES * (budget // b)))) for b, n in zip(bounds, counts)]
    names = {}
    for name in ("bucket", "width", "batch_group", "batch", "slot", "row"):
        names[name] = free_name(docs, name)
    one = F.greatest(F.coalesce(F.col(length), F.lit(0)), F.lit(1))
    bucket = sum(((one > b).cast("int") for b in bounds[:-1]), F.lit(0))
    pick = lambda values: F.element_at(
        F.array(*(F.lit(v).cast("long") for v in values or [1])), F.col(names["bucket"]) + 1
    )
    rows = docs.withColumn(names["row"], F.monotonically_increasing_id()).withColumn(names["bucket"], bucket)
    rows = rows.withColumn(names["width"], pick(bounds)).withColumn(
        names["batch_group"], F.col(names["row"]) % pick(groups)
    )
    place = F.row_number().over(Window.partitionBy(names["bucket"], names["batch_group"]).orderBy(names["row"])) - 1
    room = F.greatest(F.floor(F.lit(budget) / F.col(names["width"])), F.lit(1))
    return (
        rows.withColumn(names["slot"], place.cast("long"))
        .withColumn(names["batch"], F.floor(F.col(names["slot"]) / room).cast("long"))
        .withColumn(names["slot"], F.col(names["slot"]) % room)
        .select(*docs.columns, *(names[k] for k in ("bucket", "width", "batch_group", "batch", "slot")))
    )
