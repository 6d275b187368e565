"""Scores of texts under a log-bilinear model trained by noise-contrastive estimation.

Every word of the training documents has a place in the model. Words seen at least LEAST
times are units of their own (the OWN most frequent at most, so that the parameters which
tasks get stay bounded); the others fall by their hash into shared units, whose number
grows with the number of different words; the end of a text is a unit too. Words of a
shared unit divide its probability by their smoothed counts, and one part of it is for
words never seen there, so the model is a distribution over all words.

The units before a token (CONTEXT of them) give the vector sum(E[u_i] C_i). Units stand in
classes by frequency, about as many as a class has members: the vector's product with the
classes' output vectors plus their biases, through a softmax, gives the class, the same with
the members' vectors gives the unit. So both normalisers are batched matrix products of
about the root of the vocabulary.

Training passes over all training documents. They are dealt to shards by a hash of the row,
as many as the number of training tokens asks for, and are in a fixed order there, so neither
the splits of the input nor the number of machines changes the model. Each shard runs mini-batches in
numpy from the same start; each unit's parameters are averaged by how often the shards
updated them. What comes to the driver is bounded: the parameters, a histogram of counts and
the counts of at most KNOWN frequent words. Rarer words meet their counts in a join.
"""

from __future__ import annotations

import ctypes
import glob
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from hushline.llm.arrowtext import Chunk, Hasher, chunks, mix, words
from hushline.llm.packing import length_cell
from hushline.llm.storage import written

#: Least count of a word that is a unit of its own, most such words, most shared units and words for each of these.
LEAST, OWN, BUCKETS, BUCKET_WORDS = 8, 65_536, 16_384, 64
#: Length of the vectors, units of a context, passes over the corpus.
DIMS, CONTEXT, PASSES = 24, 3, 1
#: Tokens of a shard, and most shards (each then takes a larger share).
SHARD_TOKENS, SHARDS = 4_000_000, 4096
#: Frequent words whose counts every task gets.
KNOWN = 300_000
#: Tokens shuffled together, tokens of a step, noise classes of a step, noise words of a class in a step.
PIECE, BATCH, NOISE, WITHIN, RATE = 1 << 17, 4096, 32, 6, 0.1
#: Tokens scored at a time, rows of a product that stay in a core's cache, rows of parameters summed together.
BLOCK, CACHED, BLOCK_ROWS = 1 << 16, 512, 1024
_WORDS = Hasher(10, fold=True)
#: The end of a text, as a word's hash.
END = np.uint64(0x0E0F_ED0C_E0F7_E117)


def one_thread() -> None:
    """Keeps the products of a task to its own core, where numpy brings a library that can be told so.

    Its threads would wait for one another while other tasks hold the cores; results are the same.
    """
    for path in glob.glob(os.path.join(os.path.dirname(os.path.dirname(np.__file__)), "numpy.libs", "*openblas*")):
        for name in ("scipy_openblas_set_num_threads64_", "scipy_openblas_set_num_threads", "openblas_set_num_threads"):
            tell = getattr(ctypes.CDLL(path), name, None)
            if tell is not None:
                tell(1)
                break


def held_out(key: Column) -> Column:
    """Whether a document is kept from training; a null key counts as an empty one."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 7 == 2


def _tokens(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, each text closed by END; where each text's tokens begin (and the end)."""
    found = words(chunk, _WORDS)
    first = found.first + np.arange(len(found.first))
    out = np.empty(len(found.hashes) + len(chunk), np.uint64)
    out[first[1:] - 1] = END
    mask = np.ones(len(out), bool)
    mask[first[1:] - 1] = False
    out[mask] = found.hashes
    return out, first


def bucket_of(tokens: np.ndarray, buckets: int) -> np.ndarray:
    return ((tokens >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)


@dataclass
class Counts:
    """Counts of frequent words (sorted by hash), and the units in order of falling mass.

    A mass is a sum of count + 1 over the words of a unit; a shared unit has 1 more for
    words never seen.
    """

    hashes: np.ndarray
    counts: np.ndarray
    #: Hashes of the words that are units, sorted, and their numbers; numbers of shared units and of the end.
    own: np.ndarray
    own_numbers: np.ndarray
    bucket_numbers: np.ndarray
    end: int
    masses: np.ndarray

    @classmethod
    def of(cls, hashes, counts, own, own_masses, bucket_masses, end_mass) -> "Counts":
        masses = np.concatenate([own_masses, bucket_masses, [end_mass]]).astype(np.float64)
        order = np.argsort(-masses, kind="stable")
        numbers = np.empty(len(order), np.int64)
        numbers[order] = np.arange(len(order))
        n = len(own)
        return cls(hashes, counts, own, numbers[:n], numbers[n:-1], int(numbers[-1]), masses[order])

    @property
    def begin(self) -> int:
        return len(self.masses)

    def find(self, tokens: np.ndarray) -> np.ndarray:
        """Counts of frequent words, -1 for others."""
        if not len(self.hashes):
            return np.full(len(tokens), -1, np.int64)
        at = np.searchsorted(self.hashes, tokens)
        at[at == len(self.hashes)] = 0
        return np.where(self.hashes[at] == tokens, self.counts[at], -1)

    def numbers(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Units of tokens, and whether these are shared ones."""
        out = self.bucket_numbers[bucket_of(tokens, len(self.bucket_numbers))]
        shared = np.ones(len(tokens), bool)
        if len(self.own):
            at = np.searchsorted(self.own, tokens)
            at[at == len(self.own)] = 0
            alone = self.own[at] == tokens
            out[alone], shared[alone] = self.own_numbers[at[alone]], False
        out[tokens == END], shared[tokens == END] = self.end, False
        return out, shared

    def contexts(self, units: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The CONTEXT units before each token, the last one first; before a text stands `begin`."""
        place = np.arange(len(units)) - np.repeat(first[:-1], np.diff(first))
        out = np.full((len(units), CONTEXT), self.begin, np.int64)
        for i in range(CONTEXT):
            at = np.flatnonzero(place > i)
            out[at, i] = units[at - i - 1]
        return out


def token_counts(docs: DataFrame) -> DataFrame:
    """(h, n): count of each token in the rows' texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, "text"):
            h, n = np.unique(_tokens(chunk)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["h", "n"])

    return docs.select("text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, types: int) -> Counts:
    """Counts of the words above the least count that at most KNOWN words reach, and the units.

    The bound is read from a histogram with at most some 14,000 rows, so nothing is sorted;
    the masses of the shared units (at most BUCKETS numbers) are sums over all words.
    """
    cells = counts.groupBy(length_cell(F.col("n")).alias("cell")).agg(F.count(F.lit(1)).alias("words")).collect()
    above, least = 0, None
    for cell, n in sorted(((r["cell"], r["words"]) for r in cells), reverse=True):
        if above + n > KNOWN:
            break
        above, least = above + n, cell
    end = int(END.view(np.int64))
    if least is None:
        h, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    else:
        table = counts.where(length_cell(F.col("n")) >= least).toArrow()
        h, n = table["h"].to_numpy().astype(np.int64).view(np.uint64), table["n"].to_numpy().astype(np.int64)
    ends = counts.where(F.col("h") == F.lit(end)).first()
    order = np.argsort(h)
    h, n = h[order], n[order]
    able = np.flatnonzero((h != END) & (n >= LEAST))
    top = np.sort(able[np.lexsort((h[able], -n[able]))[:OWN]])
    buckets = min(BUCKETS, max(1, types // BUCKET_WORDS))
    bucket = (F.shiftrightunsigned("h", 20) % buckets).cast("int").alias("bucket")
    masses = np.ones(buckets)
    for r in counts.where(F.col("h") != F.lit(end)).groupBy(bucket).agg(F.sum(F.col("n") + 1).alias("mass")).collect():
        masses[r["bucket"]] += r["mass"]
    np.subtract.at(masses, bucket_of(h[top], buckets), n[top] + 1)
    return Counts.of(h, n, h[top], n[top] + 1, masses, ends["n"] + 1 if ends else 1)


def _sums(at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different indices, sorted, and the sums of their rows."""
    at, place = np.unique(at, return_inverse=True)
    d = rows.shape[1]
    spots = (place[:, None] * d + np.arange(d)).ravel()
    return at, np.bincount(spots, rows.ravel(), len(at) * d).reshape(-1, d).astype(np.float32)


class Model:
    """Parameters: E of contexts, C of their places, Q of units and R of classes (the bias in the last column)."""

    def __init__(self, masses: np.ndarray):
        draw = np.random.Generator(np.random.PCG64(10))
        units = len(masses)
        self.size = int(np.ceil(np.sqrt(units)))
        starts = np.arange(0, units, self.size)
        of_class = np.add.reduceat(masses, starts)
        self.e = (draw.standard_normal((units + 1, DIMS)) * 0.3).astype(np.float32)
        self.c = np.concatenate([np.eye(DIMS) / (i + 1) for i in range(CONTEXT)]).astype(np.float32)
        # Output vectors of nothing: the start is the distribution of the smoothed counts.
        self.q, self.r = np.zeros((units, DIMS + 1), np.float32), np.zeros((len(starts), DIMS + 1), np.float32)
        self.q[:, DIMS] = np.log(masses / np.repeat(of_class, self.size)[:units])
        self.r[:, DIMS] = np.log(of_class / masses.sum())

    def parts(self) -> list[np.ndarray]:
        return [self.e, self.c, self.q, self.r]

    def load(self, parts: list[np.ndarray]) -> None:
        for mine, other in zip(self.parts(), parts):
            mine[...] = other

    def by_place(self) -> list[np.ndarray]:
        """E C_i for each place i of a context."""
        return [self.e @ self.c[i * DIMS:(i + 1) * DIMS] for i in range(CONTEXT)]

    def log_probabilities(self, places: list[np.ndarray], context: np.ndarray, unit: np.ndarray) -> np.ndarray:
        """Natural logarithms of the units' probabilities after their contexts."""
        order = np.argsort(unit, kind="stable")
        unit, context = unit[order], context[order]
        vector = np.ones((len(unit), DIMS + 1), np.float32)
        vector[:, :DIMS] = sum(table.take(context[:, i], axis=0) for i, table in enumerate(places))
        kind = unit // self.size
        made = _normalised(vector, self.r, kind)
        starts = np.flatnonzero(np.concatenate([[True], kind[1:] != kind[:-1]])) if len(kind) else np.zeros(0, int)
        for a, b in zip(starts, np.append(starts[1:], len(kind))):
            low = kind[a] * self.size
            made[a:b] += _normalised(vector[a:b], self.q[low:low + self.size], unit[a:b] - low)
        out = np.empty(len(unit))
        out[order] = made
        return out


def _normalised(vector: np.ndarray, table: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    # No score is further from 0 than this; below 60 exponentials neither overflow nor vanish.
    large = np.sqrt((vector * vector).sum(axis=1).max(initial=0) * (table * table).sum(axis=1).max()) > 60
    out, ones = np.empty(len(chosen)), np.ones(len(table), np.float32)
    for i in range(0, len(chosen), CACHED):
        scores = vector[i:i + CACHED] @ table.T
        if large:
            scores -= scores.max(axis=1, keepdims=True)
        own = scores[np.arange(len(scores)), chosen[i:i + CACHED]].astype(np.float64)
        np.exp(scores, out=scores)
        out[i:i + CACHED] = own - np.log((scores @ ones).astype(np.float64))
    return out


class Trainer:
    """Noise-contrastive estimation by mini-batches with steps scaled by past gradients."""

    def __init__(self, model: Model, masses: np.ndarray, seed: int):
        self.model, self.draw = model, np.random.Generator(np.random.PCG64(seed))
        self.sums = np.concatenate([[0.0], np.cumsum(masses)])
        self.edges = np.append(np.arange(0, len(masses), model.size), len(masses))
        self.of_class = np.diff(self.sums[self.edges])
        self.log_class = np.log(NOISE * self.of_class / self.sums[-1]).astype(np.float32)
        self.log_unit = np.log(WITHIN * masses / np.repeat(self.of_class, model.size)[:len(masses)]).astype(np.float32)
        self.past = [np.ones(p.shape, np.float32) for p in model.parts()]
        #: How often each row of the parameters was updated.
        self.times = [np.zeros(len(p), np.float32) for p in model.parts()]

    def learn(self, context: np.ndarray, unit: np.ndarray) -> None:
        order = self.draw.permutation(len(unit))
        for i in range(0, len(order), BATCH):
            at = order[i:i + BATCH]
            at = at[np.argsort(unit[at], kind="stable")]
            self._step(context[at], unit[at])

    def _draws(self, low: np.ndarray, high: np.ndarray, shape: tuple) -> np.ndarray:
        """Units by their masses, between two of the running sums."""
        spot = low + self.draw.random(shape) * (high - low)
        return np.minimum(np.searchsorted(self.sums, spot, side="right") - 1, len(self.sums) - 2)

    def _step(self, context: np.ndarray, unit: np.ndarray) -> None:
        m = self.model
        kind = unit // m.size
        one = m.e.take(context.ravel(), axis=0).reshape(len(unit), -1)
        vector = np.ones((len(unit), DIMS + 1), np.float32)
        vector[:, :DIMS] = one @ m.c
        # The class against classes drawn for the step, the unit against units drawn for its class.
        starts = np.flatnonzero(np.concatenate([[True], kind[1:] != kind[:-1]]))
        present = kind[starts]
        ends = np.append(starts[1:], len(kind))
        group = np.repeat(np.arange(len(starts)), ends - starts)
        false_kind = self._draws(0.0, self.sums[-1], (NOISE,)) // m.size
        low, high = self.sums[self.edges[present]], self.sums[self.edges[present + 1]]
        false = self._draws(low[:, None], high[:, None], (len(present), WITHIN))
        false = np.clip(false, self.edges[present][:, None], self.edges[present + 1][:, None] - 1)
        r_real, r_false, q_real, q_false = (t.take(at, axis=0) for t, at in ((m.r, kind), (m.r, false_kind), (m.q, unit), (m.q, false)))
        up_kind = _up(np.einsum("nd,nd->n", vector, r_real) - self.log_class[kind])
        down_kind = _down(vector @ r_false.T - self.log_class[false_kind])
        up = _up(np.einsum("nd,nd->n", vector, q_real) - self.log_unit[unit])
        q_drawn = q_false.take(group, axis=0)
        down = _down(np.einsum("nd,nkd->nk", vector, q_drawn) - self.log_unit[false][group])
        back = up_kind[:, None] * r_real + down_kind @ r_false + up[:, None] * q_real
        back = (back + np.einsum("nk,nkd->nd", down, q_drawn))[:, :DIMS]
        to_false = [down[a:b].T @ vector[a:b] for a, b in zip(starts, ends)]
        q_at, q_rows = _sums(np.concatenate([unit, false.ravel()]), np.concatenate([up[:, None] * vector, *to_false]))
        of_kind = np.add.reduceat(up_kind[:, None] * vector, starts, axis=0)
        r_at, r_rows = _sums(np.concatenate([present, false_kind]), np.concatenate([of_kind, down_kind.T @ vector]))
        e_at, e_rows = _sums(context.ravel(), (back @ m.c.T).reshape(-1, DIMS))
        c_rows = one.T @ back
        whole = [(e_at, e_rows), (np.arange(len(m.c)), c_rows), (q_at, q_rows), (r_at, r_rows)]
        for p, past, times, (at, rows) in zip(m.parts(), self.past, self.times, whole):
            now = past.take(at, axis=0)
            now += rows * rows
            past[at] = now
            np.sqrt(now, out=now)
            np.divide(rows, now, out=now)
            now *= np.float32(RATE)
            now += p.take(at, axis=0)
            p[at] = now
            times[at] += 1


def _up(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(np.clip(x, -30, 30)))


def _down(x: np.ndarray) -> np.ndarray:
    return -1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _pieces(known: Counts, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray | None, np.ndarray | None]]:
    """(shard, contexts, units) of PIECE tokens each, wherever the batches are cut; a shard's last piece is shorter."""
    shard, held, n = None, [], 0

    def cut(all_of_it: bool):
        nonlocal held, n
        context, unit = (np.concatenate(x) for x in zip(*held))
        stop = n if all_of_it else n - n % PIECE
        for i in range(0, stop, PIECE):
            yield shard, context[i:min(i + PIECE, stop)], unit[i:min(i + PIECE, stop)]
        held, n = ([(context[stop:], unit[stop:])], n - stop) if stop < n else ([], 0)

    for chunk in chunks(batches, "text"):
        tokens, first = _tokens(chunk)
        unit, _ = known.numbers(tokens)
        context = known.contexts(unit, first)
        shards = chunk.rows.column(chunk.rows.schema.get_field_index("shard")).to_numpy(False)
        new = np.flatnonzero(np.concatenate([[True], shards[1:] != shards[:-1]]))
        for a, b in zip(new, np.append(new[1:], len(shards))):
            if shards[a] != shard:
                if n:
                    yield from cut(True)
                shard = int(shards[a])
            held.append((context[first[a]:first[b]], unit[first[a]:first[b]]))
            n += int(first[b] - first[a])
            if n >= PIECE:
                yield from cut(False)
    if n:
        yield from cut(True)


def trained(docs: DataFrame, counts: Counts, tokens: int) -> Model:
    """The model after PASSES passes over all rows of (key, text)."""
    model = Model(counts.masses)
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(counts)
    shards = max(1, min(SHARDS, tokens // SHARD_TOKENS))
    row = F.xxhash64("key", "text")
    dealt = docs.select("text", row.alias("h"), F.pmod(row, F.lit(shards)).cast("int").alias("shard"))
    dealt = dealt.repartition(shards, "shard").sortWithinPartitions("shard", "h").select("text", "shard")
    for turn in range(PASSES):
        start = context.broadcast(model.parts())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            one_thread()
            known, now, trainer = shared.value, None, None
            for shard, before, unit in _pieces(known, batches):
                if shard != now:
                    if trainer is not None:
                        yield from _blocks(trainer)
                    now, own = shard, Model(known.masses)
                    own.load(start.value)
                    trainer = Trainer(own, known.masses, turn * SHARDS + shard)
                trainer.learn(before, unit)
            if trainer is not None:
                yield from _blocks(trainer)

        blocks = dealt.mapInArrow(run, "part int, block int, weights binary, v binary").groupBy("part", "block").applyInArrow(
            _average, "part int, block int, weights binary, v binary"
        ).toArrow()
        parts = model.parts()
        for part, block, weights, v in zip(*(blocks[c].to_pylist() for c in ("part", "block", "weights", "v"))):
            rows = parts[part][block * BLOCK_ROWS:(block + 1) * BLOCK_ROWS]
            some = np.frombuffer(weights, np.float64) > 0
            rows[some] = np.frombuffer(v, np.float64).reshape(rows.shape)[some]
    return model


def _blocks(trainer: Trainer) -> Iterator[pa.RecordBatch]:
    """A shard's parameters by blocks of rows, with the rows' weights; untouched blocks are left out."""
    for part, (p, times) in enumerate(zip(trainer.model.parts(), trainer.times)):
        for i in range(0, len(p), BLOCK_ROWS):
            weights, v = times[i:i + BLOCK_ROWS], p[i:i + BLOCK_ROWS]
            if weights.any():
                yield pa.RecordBatch.from_arrays([
                    pa.array([part], pa.int32()), pa.array([i // BLOCK_ROWS], pa.int32()),
                    pa.array([weights.tobytes()], pa.binary()), pa.array([v.tobytes()], pa.binary()),
                ], names=["part", "block", "weights", "v"])


def _average(table: pa.Table) -> pa.Table:
    """The weighted average of one block over the shards (at most SHARDS rows)."""
    whole = total = 0.0
    for weights, v in zip(table["weights"], table["v"]):
        weights = np.frombuffer(weights.as_py(), np.float32).astype(np.float64)
        whole = whole + weights
        total = total + np.frombuffer(v.as_py(), np.float32).reshape(len(weights), -1) * weights[:, None]
    made = total / np.maximum(whole, 1e-9)[:, None]
    return pa.table({
        "part": table["part"].slice(0, 1), "block": table["block"].slice(0, 1),
        "weights": pa.array([whole.tobytes()], pa.binary()), "v": pa.array([made.tobytes()], pa.binary()),
    })


def scored(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row.

    Scores are sums of log10 probabilities over the words of a text and its end. Null and
    empty texts have the end alone. A text of any length is scored whole, in blocks of tokens.
    Repeated rows are scored one by one (and count in training as often as they come; rows
    equal in key and text are of one shard). Null keys are in training. Equal counts are ordered
    by hash. Other columns, whatever their names, are left out. Without training documents
    all words are unknown. An empty table gives no rows.
    """
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).withColumn("held_out", held_out(F.col("key")))
    train = source.where("not held_out")
    counts = written(token_counts(train), "counts")
    tokens, types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    known = frequent(counts, types)
    model = trained(train, known, tokens)
    context = docs.sparkSession.sparkContext
    shared, parameters = context.broadcast(known), context.broadcast(model.parts())
    whole = tokens + types + 1.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one_thread()
        counts = shared.value
        model = Model(counts.masses)
        model.load(parameters.value)
        places = model.by_place()
        for chunk in chunks(batches, "text"):
            hashes, first = _tokens(chunk)
            unit, common = counts.numbers(hashes)
            before = counts.contexts(unit, first)
            score = np.empty(len(unit))
            for i in range(0, len(unit), BLOCK):
                score[i:i + BLOCK] = model.log_probabilities(places, before[i:i + BLOCK], unit[i:i + BLOCK])
            score /= np.log(10)
            count = counts.find(hashes)
            found = count >= 0
            base = np.where(found, np.log10((np.maximum(count, 0) + 1) / whole), 0.0)
            # A word's part of its shared unit; the count of a rarer word comes by the join.
            score -= np.where(common, np.log10(counts.masses[unit]), 0.0)
            score += np.where(common & found, np.log10(np.maximum(count, 0) + 1), 0.0)
            n = len(chunk)
            owner = np.repeat(np.arange(n), np.diff(first))
            total = lambda v: np.bincount(owner, v, n)
            row = chunk.rows.column(chunk.rows.schema.get_field_index("row")).to_numpy(False)
            # One line a text with what is known here; its own number spreads these over the join.
            yield _lines(row, chunk.rows.column(0), chunk.rows.column(chunk.rows.schema.get_field_index("held_out")),
                         mix(row.astype(np.uint64)).view(np.int64), np.diff(first), total(found), total(base), total(score))
            # And one line for each rarer word of a text.
            rare = np.flatnonzero(~found)
            if len(rare):
                order = rare[np.lexsort((hashes[rare], owner[rare]))]
                h, o = hashes[order], owner[order]
                new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (o[1:] != o[:-1])]))
                times = np.diff(np.append(new, len(h)))
                nothing = pa.nulls(len(new), chunk.rows.column(0).type)
                yield _lines(row[o[new]], nothing, pa.nulls(len(new), pa.bool_()), h[new].view(np.int64),
                             None, times, np.zeros(len(new)), np.zeros(len(new)))

    kind = source.schema["key"].dataType.simpleString()
    lines = source.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
        run, f"row long, key {kind}, held_out boolean, h long, n_tokens long, n long, base double, score double"
    )
    rare = F.col("n_tokens").isNull()
    end = F.col("h") == F.lit(int(END.view(np.int64)))
    c = F.coalesce("c", F.lit(0))
    joined = lines.join(counts.select("h", F.col("n").alias("c")), "h", "left")
    ln = F.col("n")
    joined = joined.select(
        "row", "key", "held_out", "n_tokens",
        F.when(rare, F.when(c > 0, ln).otherwise(0)).otherwise(ln).alias("n_known"),
        F.when(rare, ln * F.log10((c + 1) / F.lit(whole))).otherwise(F.col("base")).alias("base"),
        F.when(rare & ~end, ln * F.log10(c + 1)).otherwise(F.col("score")).alias("score"),
    )
    return joined.groupBy("row").agg(
        F.max("key").alias(key), F.max("held_out").alias("held_out"), F.max("n_tokens").alias("n_tokens"),
        F.sum("n_known").cast("long").alias("n_known"), F.sum("base").alias("base_score"), F.sum("score").alias("score"),
    ).select(key, "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")


def _lines(row, key, held, h, n_tokens, n, base, score) -> pa.RecordBatch:
    lengths = pa.nulls(len(row), pa.int64()) if n_tokens is None else pa.array(np.asarray(n_tokens, np.int64))
    return pa.RecordBatch.from_arrays([
        pa.array(row), key, held, pa.array(h), lengths, pa.array(np.asarray(n, np.int64)), pa.array(base), pa.array(score),
    ], names=["row", "key", "held_out", "h", "n_tokens", "n", "base", "score"])
