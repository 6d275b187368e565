"""Nearest neighbours by multiprobe p-stable hashing.

A table hashes a unit vector to K numbers floor((a.x + b) / WIDTH), a normal and b uniform,
so near vectors tend to share a cell. A query visits the cells of its table in the order of
their estimated success: the distances from the query to the borders that a cell lies
behind, squared and summed, least first. Candidates from all tables are ranked again by
exact cosines.

K, the numbers a hash, and the number of visited cells are fitted on the true neighbours, in the whole
table, of a bounded number of queries: of all K up to one whose cells would hold CELL_ROWS vectors, with as
many cells as the recall aimed at needs, the pair of least work. Fewer numbers make wider cells, so vectors
without structure are found as well, only that a query then looks at much of the table. A query that finds fewer than k is compared with all vectors, in blocks;
so are all queries where no K reaches the recall aimed at. Cells are dealt to groups of about GROUP_ROWS
vectors; a fuller cell is split over several groups and its queries visit all parts, so no cap applies.
Each group answers a query with its best vectors only: no pair of candidates is shuffled.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from hushline.llm.storage import written

U64 = np.uint64
TABLES, WIDTH = 2, 2.0
#: Vectors aimed at in a cell (at the entropy of a hash, in bits) and in a group.
CELL_ROWS, HASH_BITS, GROUP_ROWS = 64, 1.6, 4096
#: Vectors by which the fullness of cells is judged, queries on which probes are fitted, and the recall they must show.
SAMPLE, SAMPLE_QUERIES, AIM = 6000, 100, 0.97
#: Vectors that can be compared in the time of one visit to a cell, and most cells that the fit tries a table.
PROBE_ROWS, MOST_PROBES = 30, 2048
#: Most hashes a table whose neighbouring cells are listed as a whole and sorted; beyond, they come off a heap.
LISTED = 8
#: Pairs whose products are held at a time.
BLOCK = 32_768
#: Least number of blocks of vectors, numbers in a block of vectors or queries, and more than the rounding of a cosine.
BLOCKS, BLOCK_NUMBERS, ROUNDING = 32, 1 << 22, 1e-9


class Tables:
    """Random directions and offsets, the same in every task."""

    def __init__(self, dims: int, hashes: int, seed: int = 11):
        draw = np.random.Generator(np.random.PCG64(seed))
        self.hashes = hashes
        self.directions = draw.standard_normal((TABLES, hashes, dims))
        self.offsets = draw.uniform(0, WIDTH, (TABLES, hashes))
        self.odd = draw.integers(0, 1 << 63, (TABLES, hashes), np.uint64) << U64(1) | U64(1)

    def places(self, unit: np.ndarray, table: int) -> np.ndarray:
        return (unit @ self.directions[table].T + self.offsets[table]) / WIDTH

    def cells(self, numbers: np.ndarray, table: int) -> np.ndarray:
        """One 64-bit number a cell."""
        h = (numbers.astype(np.int64).view(U64) * self.odd[table]).sum(axis=-1, dtype=U64) + U64(table)
        h ^= h >> U64(31)
        return (h * U64(0x9E3779B97F4A7C15)).view(np.int64)

    def probes(self, unit: np.ndarray, table: int, n: int) -> np.ndarray:
        """A row a vector: the n cells nearest to it (fewer if there are no more neighbours), nearest first."""
        place = self.places(unit, table)
        home = np.floor(place)
        below = place - home
        if self.hashes > LISTED:
            return np.stack([self.cells(h + np.array(list(perturbations(b, n))), table) for h, b in zip(home, below)])
        steps = _steps(self.hashes)
        out = np.empty((len(unit), min(n, len(steps))), np.int64)
        for i in range(0, len(unit), 256):
            part = below[i:i + 256]
            cost = part ** 2 @ (steps < 0).T + (1 - part) ** 2 @ (steps > 0).T
            order = np.argsort(cost, axis=1, kind="stable")[:, :n]
            out[i:i + 256] = self.cells(home[i:i + 256, None] + steps[order], table)
        return out


@cache
def _steps(hashes: int) -> np.ndarray:
    """All steps of -1, 0 or 1 a hash, the one that stays at home first."""
    steps = np.stack(np.meshgrid(*[[0.0, -1.0, 1.0]] * hashes, indexing="ij"), axis=-1)
    return steps.reshape(-1, hashes)


def perturbations(below: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """Steps of -1, 0 or 1 a hash, by the sum of squared distances to the borders crossed, least first.

    below: distance to the lower border in widths; the upper one is at 1 - below.
    """
    k = len(below)
    cost = np.concatenate([below, 1 - below]) ** 2
    order = np.argsort(cost, kind="stable")
    sorted_cost = cost[order].tolist()
    yield np.zeros(k)
    made = 1
    heap = [(sorted_cost[0], (0,))] if k else []
    while heap and made < n:
        total, chosen = heapq.heappop(heap)
        last = chosen[-1]
        if last + 1 < 2 * k:  # next larger border instead of the last, or in addition
            heapq.heappush(heap, (total - sorted_cost[last] + sorted_cost[last + 1], (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (total + sorted_cost[last + 1], (*chosen, last + 1)))
        step, valid = np.zeros(k), True
        for c in chosen:
            axis, sign = order[c] % k, -1.0 if order[c] < k else 1.0
            valid &= step[axis] == 0
            step[axis] = sign
        if valid:
            made += 1
            yield step


def _matrix(column, dims: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), np.float64).reshape(-1, dims)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _cosines_of_pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All cosines of two sets of rows, each by the same sequence of operations wherever its rows stand."""
    out = np.empty((len(a), len(b)))
    na, nb = np.sqrt((a * a).sum(axis=1)), np.sqrt((b * b).sum(axis=1))
    step = max(1, BLOCK // max(len(b), 1))
    for i in range(0, len(a), step):
        out[i:i + step] = (a[i:i + step, None, :] * b[None]).sum(axis=-1) / (na[i:i + step, None] * nb[None])
    return out


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, vec) of the rows that take part: finite, not zero, of the most frequent dimension, with a key."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), v.alias("vec")).where(
        F.col(key).isNotNull() & v.isNotNull() & F.coalesce(finite, F.lit(False))
    )
    return rows.where(F.exists("vec", lambda x: x != 0))


def fitted_probes(tables: Tables, asked: np.ndarray, near: np.ndarray, sample: np.ndarray) -> tuple[int, float] | None:
    """The least number of probes a table, doubled from 1, which finds the share AIM of the neighbours, and the
    share of the table, judged by the sample, that a query then looks at. None if the probes tried do not suffice.

    asked and near: a row a pair of a query and one of its true neighbours, unit vectors both.
    """
    queries, who = np.unique(asked, axis=0, return_inverse=True)
    who = who.reshape(-1)
    cells = [tables.cells(np.floor(tables.places(near, t)), t) for t in range(TABLES)]
    held = [np.unique(tables.cells(np.floor(tables.places(sample, t)), t), return_counts=True) for t in range(TABLES)]
    limit = min(3 ** tables.hashes, MOST_PROBES)
    n, most = 1, min(256, limit)
    while True:
        orders = [tables.probes(queries, t, most) for t in range(TABLES)]
        ranks = np.full(len(near), most)
        for t in range(TABLES):
            same = cells[t][:, None] == orders[t][who]
            ranks = np.minimum(ranks, np.where(same.any(axis=1), same.argmax(axis=1), most))
        while True:
            n = min(n, most)
            if (ranks < n).mean() >= AIM:
                looked = sum(held[t][1][np.isin(held[t][0], order)].sum() for t in range(TABLES) for order in orders[t][:, :n])
                return n, looked / (len(queries) * len(sample))
            if n == most:
                break
            n *= 2
        if most == limit:
            return None
        n, most = 2 * most, min(4 * most, limit)


def fitted_tables(asked: np.ndarray, near: np.ndarray, sample: np.ndarray, n: int) -> tuple[Tables, int] | None:
    """The tables and probes of least work for n vectors that find the share AIM of the neighbours; None if none do."""
    best = None
    for hashes in range(2, max(2, round(np.log2(max(n, 2) / CELL_ROWS) / HASH_BITS)) + 1):
        tables = Tables(sample.shape[1], hashes)
        fitted = fitted_probes(tables, asked, near, sample)
        if fitted is not None:
            work = fitted[1] * n + TABLES * fitted[0] * PROBE_ROWS
            if best is None or work < best[0]:
                best = work, tables, fitted[0]
    return best and best[1:]


ANSWER = "query_id long, vec_id long, score double"
EMPTY = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})


def nearest(
    vectors: DataFrame, queries_where: str = "vec_id % 50 = 0", k: int = 5, key: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score, found_by): the k nearest found of each query by cosine, ties to the smaller vec_id.

    Queries are the usable rows that the condition on vec_id picks. A query's own row is no
    candidate; of rows with one vec_id the one of the least vector counts. Other columns are
    not read, whatever their names; vectors may be of any length. found_by is `probes`, or
    `blocks` for a query which found fewer than k and so was compared with all vectors (all
    queries, where no fit reaches AIM). No usable vectors give no rows.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, key, vector)
    sizes = rows.groupBy(F.size("vec").alias("dims")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dims").limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double, found_by string")
    dims = sizes[0]["dims"]
    rows = written(rows.where(F.size("vec") == dims).groupBy("vec_id").agg(F.min("vec").alias("vec")), "vectors")
    n = rows.count()
    picked = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(max(1, n // SAMPLE))) == 0).limit(SAMPLE).collect()
    sample = _unit(np.array([r["vec"] for r in picked], np.float64).reshape(-1, dims))
    asked = spark.createDataFrame([(r["vec_id"], r["vec"]) for r in picked[:SAMPLE_QUERIES]], rows.schema)
    near = _merged(_all_blocks(rows, asked, dims, n, k), k).join(rows, "vec_id").select("query_id", "vec").join(
        F.broadcast(asked.select(F.col("vec_id").alias("query_id"), F.col("vec").alias("query"))), "query_id"
    ).select("query", "vec").collect() if picked else []
    pairs = [_unit(np.array([r[c] for r in near], np.float64).reshape(-1, dims)) for c in ("query", "vec")]
    fitted = fitted_tables(*pairs, sample, n) if near else None
    queries = written(rows.where(queries_where), "queries")
    if fitted is None:
        return _finished(_merged(_all_blocks(rows, queries, dims, n, k), k), "blocks")
    found = written(_merged(_search(rows, queries, *fitted, dims, n, k), k), "nearest")
    enough = found.groupBy(F.col("query_id").alias("vec_id")).agg(F.count("*").alias("n")).where(F.col("n") >= k)
    short = written(queries.join(enough, "vec_id", "left_anti"), "short")
    rest = _merged(_all_blocks(rows, short, dims, n, k), k)
    done = found.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti")
    return _finished(done, "probes").unionByName(_finished(rest, "blocks"))


def _finished(ranked: DataFrame, found_by: str) -> DataFrame:
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score", F.lit(found_by).alias("found_by"))


def _merged(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.dropDuplicates(["query_id", "vec_id"]).withColumn("rank", place).where(F.col("rank") <= k)


def _candidates(query: np.ndarray, query_ids: np.ndarray, vecs: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(place of the query, place of the vector): all that could be among a query's k best but for rounding, by
    matrix products; the query's own row aside.
    """
    out = []
    columns, step, cut = _unit(vecs).T, max(1, BLOCK_NUMBERS // len(ids)), max(len(ids) - k, 0)
    for i in range(0, len(query), step):
        near = _unit(query[i:i + step]) @ columns
        near[query_ids[i:i + step, None] == ids[None]] = -np.inf
        edges = np.partition(near, cut, axis=1)[:, cut] - ROUNDING
        q, v = np.nonzero((near >= edges[:, None]) & (near > -np.inf))
        out.append((q + i, v))
    return tuple(np.concatenate(x) for x in zip(*out))


def _ranked(query: np.ndarray, query_ids: np.ndarray, vecs: np.ndarray, ids: np.ndarray, pairs: list, k: int) -> pa.Table:
    """The k best of each query's candidates by exact cosines, ties to the smaller id, each id once."""
    q, v = (np.concatenate(x) for x in zip(*pairs)) if pairs else (np.zeros(0, int),) * 2
    scores = np.empty(len(q))
    step = max(1, BLOCK_NUMBERS // vecs.shape[1])
    for i in range(0, len(q), step):
        scores[i:i + step] = _cosines_of_pairs(query[q[i:i + step]], vecs[v[i:i + step]])
    near = ids[v]
    order = np.lexsort((near, -scores, q))
    q, near, scores = q[order], near[order], scores[order]
    once = np.ones(len(q), bool)
    once[1:] = (q[1:] != q[:-1]) | (near[1:] != near[:-1])
    q, near, scores = q[once], near[once], scores[once]
    top = np.arange(len(q)) - np.searchsorted(q, q) < k
    return pa.table({"query_id": query_ids[q[top]], "vec_id": near[top], "score": scores[top]})


def _search(rows: DataFrame, queries: DataFrame, tables: Tables, probes: int, dims: int, n: int, k: int) -> DataFrame:
    groups = max(1, -(-n * TABLES // GROUP_ROWS))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = _unit(_matrix(batch.column(1), dims))
            for t in range(TABLES):
                cells = pa.array(tables.cells(np.floor(tables.places(unit, t)), t))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), cells], names=["vec_id", "vec", "cell"])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                unit = _unit(_matrix(part.column(1), dims))
                for t in range(TABLES):
                    cells = tables.probes(unit, t, probes)
                    ids = np.repeat(part.column(0).to_numpy(False), cells.shape[1])
                    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(cells.ravel())], names=["query_id", "cell"])

    points = written(rows.mapInArrow(index, "vec_id long, vec array<double>, cell long"), "points")
    sizes = points.groupBy("cell").agg(F.count("*").alias("held"))
    sizes = written(sizes.select("cell", F.ceil(F.col("held") / GROUP_ROWS).cast("int").alias("parts")), "cells")
    group = F.pmod(F.xxhash64("cell", "part"), F.lit(groups)).cast("int").alias("grp")
    full = sizes.where("parts > 1")
    points = points.join(full, "cell", "left").withColumn(
        "part", F.pmod(F.xxhash64("vec_id"), F.coalesce("parts", F.lit(1))).cast("int")
    ).select(group, "cell", "vec_id", "vec")
    # Cells without a vector are left out here, before anything is grouped.
    visits = queries.mapInArrow(visit, "query_id long, cell long").join(sizes, "cell").withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    )
    visits = written(visits.groupBy("query_id", group).agg(F.collect_set("cell").alias("cells")), "visits")
    # Many queries of one group go to several tasks, which all get its vectors.
    loads = visits.groupBy("grp").agg(F.count("*").alias("asked")).where(f"asked > {GROUP_ROWS}")
    loads = written(loads.select("grp", F.ceil(F.col("asked") / GROUP_ROWS).cast("int").alias("rounds")), "loads")
    rounds = F.coalesce("rounds", F.lit(1))
    visits = visits.join(loads, "grp", "left").withColumn("turn", F.pmod(F.xxhash64("query_id"), rounds).cast("int")).join(
        queries.select(F.col("vec_id").alias("query_id"), F.col("vec").alias("query")), "query_id"
    ).select("grp", "turn", "query_id", "cells", "query")
    points = points.join(loads, "grp", "left").withColumn("turn", F.explode(F.sequence(F.lit(0), rounds - 1))).drop("rounds")

    def answer(points: pa.Table, visits: pa.Table) -> pa.Table:
        if not (len(points) and len(visits)):
            return EMPTY
        cells, ids, vecs = points["cell"].to_numpy(), points["vec_id"].to_numpy(), _matrix(points["vec"], dims)
        order = np.argsort(cells, kind="stable")
        cells, ids, vecs = cells[order], ids[order], vecs[order]
        named, starts = np.unique(cells, return_index=True)
        ends = np.append(starts[1:], len(cells))
        wanted = visits["cells"].combine_chunks()
        who = np.repeat(np.arange(len(visits)), np.diff(wanted.offsets.to_numpy()))
        at = np.searchsorted(named, wanted.flatten().to_numpy(zero_copy_only=False))
        order = np.argsort(at, kind="stable")
        who, borders = who[order], np.searchsorted(at[order], np.arange(len(named) + 1))
        query_ids, query = visits["query_id"].to_numpy(), _matrix(visits["query"], dims)
        pairs = []
        for a in range(len(named)):
            asking = who[borders[a]:borders[a + 1]]
            if len(asking):
                own = slice(starts[a], ends[a])
                q, v = _candidates(query[asking], query_ids[asking], vecs[own], ids[own], k)
                pairs.append((asking[q], v + starts[a]))
        return _ranked(query, query_ids, vecs, ids, pairs, k)

    return points.groupBy("grp", "turn").cogroup(visits.groupBy("grp", "turn")).applyInArrow(answer, ANSWER)


def _all_blocks(rows: DataFrame, queries: DataFrame, dims: int, n: int, k: int) -> DataFrame:
    """The nearest of all vectors: queries and vectors in blocks, each pair of blocks one group."""
    row_blocks = max(BLOCKS, -(-n * dims // BLOCK_NUMBERS))
    query_blocks = max(1, -(-queries.count() * dims // BLOCK_NUMBERS))
    block = lambda c, b: F.pmod(F.xxhash64(c), F.lit(b)).cast("int")
    points = rows.withColumn("grp", block("vec_id", row_blocks)).withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    asks = queries.withColumnsRenamed({"vec_id": "query_id", "vec": "query"}).withColumn("turn", block("query_id", query_blocks)).withColumn(
        "grp", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1)))
    )

    def answer(points: pa.Table, asks: pa.Table) -> pa.Table:
        if not (len(points) and len(asks)):
            return EMPTY
        query, query_ids = _matrix(asks["query"], dims), asks["query_id"].to_numpy()
        vecs, ids = _matrix(points["vec"], dims), points["vec_id"].to_numpy()
        return _ranked(query, query_ids, vecs, ids, [_candidates(query, query_ids, vecs, ids, k)], k)

    return points.groupBy("grp", "turn").cogroup(asks.groupBy("grp", "turn")).applyInArrow(answer, ANSWER)
