"""Toxicity scores by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positive sample, text of any kind the unlabelled one. With
the class prior (the share of toxic documents) the risk of a classifier is the prior times
its loss on positives, plus its loss as negatives on unlabelled text less the prior's part of
positives in there; that last difference estimates a loss, so where a step makes it negative
the step goes back instead (the non-negative estimator). Linear classifiers over features of
words are trained in numpy, one a shard of the sample, and their weights averaged.

A feature is a whole word or the first letters of a longer one. Those are taken which
positives have more often than text at large, counted over all training rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from hushline.llm.arrowtext import U64, Chunk, Hasher, _pieces, chunks, mix
from hushline.llm.storage import written

#: A fourth of the keys is never learned from.
PARTS, HELD = 4, 2
#: Bounds of the samples that a classifier is fitted on: confirmed toxic rows, rows of any kind.
POSITIVES, UNLABELLED = 20_000, 40_000
#: Features: first letters (bytes), least positives with one, candidates and features at most.
PREFIXES, LEAST, CANDIDATES, FEATURES = (5, 6, 7, 8), 3, 1 << 17, 1 << 13
#: How much more often, in standard errors, positives have a feature than others.
EXCESS = 4.0
SHARDS, EPOCHS, BATCH, RATE, DECAY = 4, 60, 256, 0.05, 1e-3
THRESHOLD = 0.3

_WORDS = Hasher(13)
_LETTER = np.zeros(256, bool)
_LETTER[ord("a"):ord("z") + 1] = True
_LETTER[0x80:] = True


def held_out(key: Column) -> Column:
    """Whether a document is kept from training; a null key counts as an empty one."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % PARTS == HELD


def _folded(data: np.ndarray) -> np.ndarray:
    """Lower case of A-Z and of the capitals U+00C0 to U+00DE, in UTF-8 bytes."""
    out = data.copy()
    out[(data >= 0x41) & (data <= 0x5A)] += 32
    if len(data) > 1:
        accents = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[1:][accents] += 32
    return out


def features(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of each word and of the beginnings of longer words; repeats are left in."""
    data, offsets = _folded(chunk.data), chunk.offsets
    inside = _LETTER[data]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    filled = offsets[1:] > offsets[:-1]
    heads, tails = offsets[:-1][filled], offsets[1:][filled] - 1
    begin[heads], end[tails] = inside[heads], inside[tails]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    owner = np.repeat(np.arange(len(chunk)), np.diff(np.searchsorted(starts, offsets)))
    owners, hashes = [], []
    for low, high in _pieces(~inside, offsets):
        a, b = np.searchsorted(starts, [low, high])
        first, last, own = starts[a:b] - low, ends[a:b] - low, owner[a:b]
        up, down = _WORDS.powers(high - low)
        total = np.zeros(high - low + 1, U64)
        np.cumsum(_WORDS.values[data[low:high]] * up[:high - low], out=total[1:])
        for n in (0, *PREFIXES):
            some = last - first > n if n else slice(None)
            f, o = first[some], own[some]
            e = f + n if n else last[some]
            hashes.append(mix((total[e] - total[f]) * down[f] + U64(n)))
            owners.append(o)
    if not hashes:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    return np.concatenate(owners), np.concatenate(hashes)


def _distinct(owner: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((feature, owner))
    owner, feature = owner[order], feature[order]
    if len(owner):
        new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (feature[1:] != feature[:-1])])
        owner, feature = owner[new], feature[new]
    return owner, feature


def known(chunk: Chunk, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, place in the sorted table, occurrences) of the features which are in it."""
    owner, hashes = features(chunk)
    if not len(table):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.searchsorted(table, hashes)
    at[at == len(table)] = 0
    hit = table[at] == hashes
    both, times = np.unique(owner[hit] * len(table) + at[hit], return_counts=True)
    return both // len(table), both % len(table), times


def value(times: np.ndarray) -> np.ndarray:
    """A feature's weight in a document."""
    return 1.0 + np.log(times)


@dataclass
class Linear:
    weights: np.ndarray
    bias: float

    def margins(self, row: np.ndarray, column: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(row, self.weights[column] * x, n) + self.bias


def _pool(docs: list, bound: int, draw: np.random.Generator) -> np.ndarray:
    """Numbers of the documents, each as often as it has copies; drawn by copies where that is more than the bound."""
    copies = np.array([d[2] for d in docs], np.int64)
    if copies.sum() <= bound:
        return np.repeat(np.arange(len(docs)), copies)
    return draw.choice(len(docs), bound, p=copies / copies.sum())


def fit(positive: list, unlabelled: list, width: int, prior: float, seed: int) -> Linear:
    """A classifier from documents, each (columns, values, copies), by the non-negative risk with logistic loss."""
    draw = np.random.Generator(np.random.PCG64(seed))
    w, b = np.zeros(width), float(np.log(prior / (1 - prior)))
    m, v, t = np.zeros(width + 1), np.zeros(width + 1), 0
    positives, others = _pool(positive, POSITIVES // SHARDS * 2, draw), _pool(unlabelled, UNLABELLED // SHARDS * 2, draw)
    steps = max(1, -(-(len(positives) + len(others)) // BATCH))

    def gradient(some: list, sign: float) -> np.ndarray:
        """Of the mean of log(1 + exp(sign * margin)), and its value."""
        row = np.repeat(np.arange(len(some)), [len(d[0]) for d in some])
        column, x = np.concatenate([d[0] for d in some]), np.concatenate([d[1] for d in some])
        z = sign * (np.bincount(row, w[column] * x, len(some)) + b)
        pull = sign / (1 + np.exp(-np.clip(z, -30, 30))) / len(some)
        return np.append(np.bincount(column, pull[row] * x, width), pull.sum()), float(np.logaddexp(0, z).mean())

    for _ in range(EPOCHS):
        p, u = draw.permutation(positives), draw.permutation(others)
        for k in range(steps):
            one = [positive[i] for i in p[k::steps]]
            any_ = [unlabelled[i] for i in u[k::steps]]
            if not one or not any_:
                continue
            as_positive, _ = gradient(one, -1.0)
            of_positive, loss_positive = gradient(one, 1.0)
            of_all, loss_all = gradient(any_, 1.0)
            rest = of_all - prior * of_positive
            g = -rest if loss_all < prior * loss_positive else prior * as_positive + rest
            g[:-1] += DECAY * w
            t += 1
            m = 0.9 * m + 0.1 * g
            v = 0.999 * v + 0.001 * g * g
            step = RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
            w -= step[:-1]
            b -= step[-1]
    return Linear(w, b)


def _share(rows: DataFrame, bound: int, n: int, *columns: str) -> DataFrame:
    """About `bound` of the n rows at most, chosen by a hash of the columns; equal rows stay together."""
    return rows if n <= bound else rows.where(F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) < int((1 << 30) * bound / n))


def _candidates(positives: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Features (sorted) that at least LEAST positives have, the most frequent CANDIDATES, and in how many."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, "text"):
            f, n = np.unique(_distinct(*features(chunk))[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(f.view(np.int64)), pa.array(n)], names=["f", "n"])

    found = positives.select("text").mapInArrow(run, "f long, n long").groupBy("f").agg(F.sum("n").alias("n"))
    found = found.where(F.col("n") >= LEAST).orderBy(F.desc("n"), "f").limit(CANDIDATES).toArrow()
    f, n = found["f"].to_numpy().astype(np.int64).view(U64), found["n"].to_numpy().astype(np.int64)
    order = np.argsort(f)
    return f[order], n[order]


def _counted(rows: DataFrame, table) -> np.ndarray:
    """In how many of the rows each feature of the (broadcast) table is, and last how many rows there are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(table.value)
        n = np.zeros(width + 1, np.int64)
        for chunk in chunks(batches, "text"):
            n[:width] += np.bincount(known(chunk, table.value)[1], minlength=width)[:width]
            n[width] += len(chunk)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some])], names=["at", "n"])

    sums = rows.select("text").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(len(table.value) + 1, np.int64)
    out[sums["at"].to_numpy()] = sums["n"].to_numpy()
    return out


def chosen(table: np.ndarray, positive: np.ndarray, positives: int, every: np.ndarray) -> np.ndarray:
    """The FEATURES that positives have most in excess, sorted; every: counts among all rows, then their number."""
    n = max(int(every[-1]), 1)
    p, q = positive / max(positives, 1), every[:-1] / n
    z = (p - q) / np.sqrt((q + 1 / n) * (1 - q + 1 / n) / max(positives, 1))
    best = np.lexsort((table, -z))[:FEATURES]
    return np.sort(table[best[z[best] >= EXCESS]])


def trained(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "toxic") -> tuple[np.ndarray, Linear]:
    """Features and the averaged classifier; docs and labels are training rows (key, text) and (key, label)."""
    context = docs.sparkSession.sparkContext
    marks = written(labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.max(label).alias("mark")), "marks")
    whole, toxic = marks.agg(F.count(F.lit(1)), F.coalesce(F.sum((F.col("mark") == 1).cast("int")), F.lit(0))).first()
    prior = (toxic + 1) / (whole + 2)
    nothing = np.zeros(0, U64), Linear(np.zeros(0), float(np.log(prior / (1 - prior))))
    if not toxic:
        return nothing
    # At most some POSITIVES keys, so every task can have them.
    confirmed = _share(marks.where("mark = 1").select(key), POSITIVES, toxic, key)
    positives = written(docs.join(F.broadcast(confirmed), key).select(key, "text"), "positives")
    n = positives.count()
    if not n:
        return nothing
    table, counts = _candidates(positives)
    shared = context.broadcast(table)
    every = _counted(docs, shared)
    best = chosen(table, counts, n, every)
    if not len(best):
        return nothing
    width, shared = len(best), context.broadcast(best)
    unlabelled = _share(docs, UNLABELLED, int(every[-1]), key, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, "text"):
            row, column, times = known(chunk, shared.value)
            cuts = np.searchsorted(row, np.arange(len(chunk) + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(cuts), pa.array(x)) for x in (column.astype(np.int32), value(times))]
            shard, mark = (chunk.rows.column(chunk.rows.schema.get_field_index(c)) for c in ("shard", "mark"))
            yield pa.RecordBatch.from_arrays([shard, mark, *lists], names=["shard", "mark", "columns", "values"])

    shard = F.pmod(F.xxhash64(key, "text", F.lit(1)), F.lit(SHARDS)).cast("int").alias("shard")
    rows = positives.select("text", shard, F.lit(1).alias("mark")).unionByName(unlabelled.select("text", shard, F.lit(0).alias("mark")))
    rows = rows.mapInArrow(run, "shard int, mark int, columns array<int>, values array<double>")
    # Copies are one row with their number, so that many of them weigh on no task.
    rows = rows.groupBy("shard", "mark", "columns", "values").agg(F.count(F.lit(1)).alias("copies"))
    rows = written(rows, "sample")

    def learn(table: pa.Table) -> pa.Table:
        mark = table["mark"].to_numpy()
        docs = [
            (np.asarray(c, np.int64), np.asarray(x), n)
            for c, x, n in zip(table["columns"].to_pylist(), table["values"].to_pylist(), table["copies"].to_pylist())
        ]
        # In an order of their own, whatever came first.
        order = sorted(range(len(docs)), key=lambda i: (docs[i][0].tobytes(), docs[i][1].tobytes()))
        model = fit([docs[i] for i in order if mark[i]], [docs[i] for i in order if not mark[i]], width, prior, int(table["shard"][0].as_py()))
        found = np.append(model.weights, model.bias)
        return pa.table({"shard": table["shard"].slice(0, 1).cast(pa.int32()), "found": [found]})

    # A shard is a bounded part of the bounded samples.
    models = rows.groupBy("shard").applyInArrow(learn, "shard int, found array<double>").orderBy("shard").collect()
    mean = np.mean([r["found"] for r in models], axis=0)
    return best, Linear(mean[:-1], float(mean[-1]))


def scored(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", threshold: float = THRESHOLD,
) -> DataFrame:
    """(key, held_out, score, predicted) for each row of docs.

    The score, 0 to 1, estimates the probability that a text is toxic; predicted is 1 from
    `threshold` on. Labels are learned from keys that are not held out; a key with several
    labels is toxic if one says so, null labels and keys say nothing. Scores come from the
    text alone. Null and empty texts, and those without letters, get the score of a text
    without findings. Repeated rows get equal scores and count in training as often as they come;
    texts of any length are read whole. Without confirmed toxic rows all scores are the
    smoothed share of toxic ones. An empty table gives no rows. Other columns, whatever their
    names, are not looked at.
    """
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).withColumn("held_out", held_out(F.col("key")))
    train = source.where("not held_out").select("key", F.coalesce("text", F.lit("")).alias("text"))
    marks = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("mark")).where(~held_out(F.col("key")))
    table, model = trained(train, marks, "key", "mark")
    shared = docs.sparkSession.sparkContext.broadcast((table, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, model = shared.value
        for chunk in chunks(batches, "text"):
            row, column, times = known(chunk, table)
            margin = model.margins(row, column, value(times), len(chunk))
            score = 1 / (1 + np.exp(-np.clip(margin, -700, 700)))
            own = [chunk.rows.column(chunk.rows.schema.get_field_index(c)) for c in ("key", "held_out")]
            yield pa.RecordBatch.from_arrays([
                *own, pa.array(score), pa.array((score >= threshold).astype(np.int32)),
            ], names=[key, "held_out", "score", "predicted"])

    kind = source.schema["key"].dataType.simpleString()
    return source.mapInArrow(run, f"`{key}` {kind}, held_out boolean, score double, predicted int")
