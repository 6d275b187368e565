"""Repeated passages by level-wise doubling.

A window is a run of `window` words of one text. It repeats if its word sequence starts
anywhere else too. Levels have lengths of about a quarter, half and all of the window. At a
level of length m every window that is still a candidate names one of its runs of m words by
content alone (the one of least hash, the first among equals), so equal windows name equal
runs. Runs named once are unique: their windows drop out. Windows whose runs repeat go on to
twice the length; at the last level the run is the window itself, and what repeats is removed.

At the first level about one run in 14 is named, so few rows are shuffled though all text is
covered. Counts are summed before the shuffle, so a passage that a third of all texts share is
one sum, and finding its places is a join that adaptive execution splits. Hashes of the last
level have 96 bits. Equal texts are one text with a weight. Between levels texts travel compressed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructType

from hushline.llm.arrowtext import Chunk, Hasher, WindowHasher, Words, appended, chunks, mix, words
from hushline.llm.storage import discard, free_name, written

#: Bytes of text handled at a time.
CHUNK_BYTES = 1 << 20
U64 = np.uint64
_WORDS, _MORE_WORDS = Hasher(7), Hasher(8)
_WINDOWS, _MORE_WINDOWS = WindowHasher(7), WindowHasher(8)


def levels(window: int) -> list[int]:
    """Run lengths, each at most twice the one before, the last being the window."""
    out = [window]
    while len(out) < 3 and out[0] > 1:
        out.insert(0, (out[0] + 1) // 2)
    return out


def _named(found: Words, at: np.ndarray, length: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For windows starting at `at` the start of the run each names; hashes of all runs of the length."""
    runs = _WINDOWS.windows(found.hashes, np.arange(max(len(found.hashes) - length + 1, 0)), length)
    if len(at):
        at = _least(runs, window - length + 1)[at]
    return at, runs


def _least(values: np.ndarray, span: int) -> np.ndarray:
    """For each run of `span` values the place of the least, the first among equals."""
    best, width = np.arange(len(values)), 1
    while width < span:
        step = min(width, span - width)
        one, other = best[:-step], best[step:]
        best = np.where(values[one] <= values[other], one, other)
        width += step
    return best


def _candidates(found: Words, window: int, lengths: list[int], alive: list[list[np.ndarray]]) -> np.ndarray:
    """Starts (in the chunk) of windows whose runs repeat at all levels done; alive: by level and text, starts in the text."""
    at = found.window_starts(window)
    for length, places in zip(lengths, alive):
        if not len(at):
            break
        named, _ = _named(found, at, length, window)
        live = np.zeros(len(found.hashes), bool)
        for i, starts in enumerate(places):
            live[found.first[i] + starts] = True
        at = at[live[named]]
    return at


def _fingerprints(chunk: Chunk, found: Words) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each text's word sequence."""
    first, counts = found.first[:-1], found.counts
    one = _WINDOWS.windows(found.hashes, first, counts) ^ mix(counts.astype(U64))
    other = _MORE_WINDOWS.windows(mix(found.hashes), first, counts)
    return one.view(np.int64), other.view(np.int64)


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))


def _digests(docs: DataFrame, window: int) -> DataFrame:
    """A row each: id, n_words, fingerprint, SHA-256 of the words, and the runs named at the first level."""
    length = levels(window)[0]
    out = docs.select("id").schema.add("n_words", "long").add("f1", "long").add("f2", "long")
    out = out.add("sha256", "string").add("runs", ArrayType(LongType())).add("places", ArrayType(IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, "text", CHUNK_BYTES):
            found = words(chunk, _WORDS)
            at, runs = _named(found, found.window_starts(window), length, window)
            at = np.unique(at)
            bounds = np.searchsorted(at, found.first)
            owner = np.repeat(np.arange(len(chunk)), np.diff(bounds))
            f1, f2 = _fingerprints(chunk, found)
            yield appended(chunk.rows.select(["id"]), {
                "n_words": found.counts.astype(np.int64), "f1": f1, "f2": f2,
                "sha256": pa.array([_sha(chunk.text(i).split()) for i in range(len(chunk))], pa.string()),
                "runs": _lists(runs[at].view(np.int64), bounds),
                "places": _lists((at - found.first[owner]).astype(np.int32), bounds),
            })

    return docs.mapInArrow(run, out)


def _sha(kept: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(kept)).hexdigest()


def _packed(docs: DataFrame) -> DataFrame:
    """Fingerprint and compressed text of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for chunk in chunks(batches, "text", CHUNK_BYTES):
            f1, f2 = _fingerprints(chunk, words(chunk, _WORDS))
            packed = pa.array([press.compress(chunk.text(i)) for i in range(len(chunk))], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(f1), pa.array(f2), packed], names=["f1", "f2", "packed"])

    return docs.select("text").mapInArrow(run, "f1 long, f2 long, packed binary")


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    """Chunks of the texts in column packed."""
    press = zstandard.ZstdDecompressor()
    for batch in batches:
        packed = batch.column(batch.schema.get_field_index("packed"))
        low, size, texts = 0, 0, []
        for i, value in enumerate(packed):
            texts.append(press.decompress(value.as_py()))
            size += len(texts[-1])
            if size >= CHUNK_BYTES or i == len(packed) - 1:
                offsets = np.cumsum([0, *map(len, texts)])
                data = np.frombuffer(b"".join(texts), np.uint8)
                yield Chunk(batch.slice(low, i + 1 - low), data, offsets)
                low, size, texts = i + 1, 0, []


def _places(rows: pa.RecordBatch, name: str) -> list[np.ndarray]:
    column = rows.column(rows.schema.get_field_index(name))
    return [np.array(x.as_py() or [], np.int64) for x in column]


def _level_rows(texts: DataFrame, window: int, level: int) -> DataFrame:
    """(h1, h2, weight, text, place) of the runs which candidates name at a level."""
    lengths = levels(window)
    columns = [f"alive{k}" for k in range(level)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _unpacked(batches):
            found = words(chunk, _WORDS)
            at = _candidates(found, window, lengths, [_places(chunk.rows, c) for c in columns])
            at, runs = _named(found, at, lengths[level], window)
            at = np.unique(at)
            owner = np.searchsorted(found.first, at, "right") - 1
            second = _MORE_WINDOWS.windows(mix(found.hashes), at, lengths[level])
            take = lambda name: chunk.rows.column(chunk.rows.schema.get_field_index(name)).to_numpy(False)[owner]
            yield pa.RecordBatch.from_arrays([
                pa.array(runs[at].view(np.int64)), pa.array((second >> U64(32)).astype(np.uint32).view(np.int32)),
                pa.array(take("weight")), pa.array(take("cid")), pa.array((at - found.first[owner]).astype(np.int32)),
            ], names=["h1", "h2", "weight", "cid", "place"])

    return texts.select("cid", "weight", "packed", *columns).mapInArrow(
        run, "h1 long, h2 int, weight long, cid long, place int"
    )


def _surviving(rows: DataFrame, by: list[str], key: str, name: str) -> tuple[DataFrame, DataFrame]:
    """Places of repeated runs by text, and the table of these runs."""
    again = rows.groupBy(*by).agg(F.sum("weight").alias("n")).where("n > 1").select(*by)
    again = written(again, "again")  # so that the places of a very frequent run can be split
    return rows.join(again, by, "left_semi").groupBy(key).agg(F.collect_set("place").alias(name)), again


def repeated(docs: DataFrame, key: str, text: str, window: int) -> tuple[DataFrame, DataFrame]:
    """Digests of all rows, and the distinct texts with repeated windows: f1, f2, packed, starts of these windows."""
    source = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    digests = written(_digests(source, window), "digests")
    rows = digests.select("f1", F.inline(F.arrays_zip("runs", "places")).alias("h1", "place")).withColumn("weight", F.lit(1))
    alive, again = _surviving(rows, ["h1"], "f1", "alive0")
    classes = digests.groupBy("f1", "f2").agg(F.count(F.lit(1)).alias("weight")).join(alive, "f1")
    texts = _packed(source).dropDuplicates(["f1", "f2"]).join(classes, ["f1", "f2"])
    texts = written(texts.withColumn("cid", F.monotonically_increasing_id()), "texts")
    discard(again)
    final = len(levels(window)) - 1
    for level in range(1, final + 1):
        rows = _level_rows(texts, window, level)
        by = ["h1", "h2"] if level == final else ["h1"]
        alive, again = _surviving(rows, by, "cid", f"alive{level}")
        joined = texts.join(alive, "cid")
        if level == final:
            return digests, joined.select("f1", "f2", "packed", F.col(f"alive{level}").alias("starts"))
        before, texts = texts, written(joined, "texts")
        discard(before, again)
    # A window of one word has no level above the first.
    return digests, texts.select("f1", "f2", "packed", F.col("alive0").alias("starts"))


def _covered(n: int, starts: np.ndarray, window: int) -> np.ndarray:
    edges = np.zeros(n + 1, np.int64)
    edges[starts] += 1
    edges[starts + window] -= 1
    return np.cumsum(edges[:-1]) > 0


def spans(found: DataFrame, window: int) -> DataFrame:
    """For each distinct text with repeats: f1, f2, words removed, SHA-256 of the rest, and the rest as text.

    The rest keeps the text as it is but for removed words and the white space before each
    (after it, at the beginning).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _unpacked(batches):
            cut = words(chunk, _WORDS)
            removed, shas, rests = [], [], []
            for i, starts in enumerate(_places(chunk.rows, "starts")):
                a, b = cut.first[i], cut.first[i + 1]
                gone = _covered(b - a, starts, window)
                text, base = chunk.text(i), int(chunk.offsets[i])
                begin, end = cut.starts[a:b] - base, cut.ends[a:b] - base
                edge = np.flatnonzero(np.diff(np.concatenate([[False], ~gone, [False]]).astype(np.int8)))
                runs = [(int(begin[x]), int(end[y - 1])) for x, y in edge.reshape(-1, 2)]
                rest = b"".join(
                    (text[int(end[x - 1]):lo] if x and k else b"") + text[lo:hi]
                    for k, ((lo, hi), x) in enumerate(zip(runs, edge[::2]))
                )
                removed.append(int(gone.sum()))
                shas.append(_sha(b" ".join(text[lo:hi] for lo, hi in runs).split()))
                rests.append(rest.decode("utf-8", "replace"))
            yield appended(chunk.rows.select(["f1", "f2"]), {
                "n_removed": np.array(removed, np.int64), "rest_sha256": pa.array(shas, pa.string()),
                "rest": pa.array(rests, pa.string()),
            })

    return found.select("f1", "f2", "packed", "starts").mapInArrow(
        run, "f1 long, f2 long, n_removed long, rest_sha256 string, rest string"
    )


def removal_digests(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 35) -> DataFrame:
    """(key, n_words, n_removed, kept_sha256) for each row.

    Null and empty texts, and texts shorter than the window, lose nothing. Repeated rows are
    copies of each other: with a window's length or more all their words go. Null keys are
    kept as they are; an empty table gives no rows.
    """
    digests, found = repeated(docs, key, text, window)
    changed = spans(found, window).select("f1", "f2", "n_removed", "rest_sha256")
    rows = digests.select("id", "n_words", "f1", "f2", "sha256").join(changed, ["f1", "f2"], "left")
    return rows.select(
        F.col("id").alias(key), "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("rest_sha256", "sha256").alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame, text: str = "text", window: int = 50) -> DataFrame:
    """The documents with repeated passages cut out of the text, all other columns unchanged.

    A document all of whose words go stays with an empty text. Null texts stay null.
    """
    one, two, rest = (free_name(docs, name) for name in ("f1", "f2", "rest"))
    digests, found = repeated(docs.select(text).withColumn("_row_key", F.lit(None).cast("long")), "_row_key", text, window)
    discard(digests)
    changed = spans(found, window).select(F.col("f1").alias(one), F.col("f2").alias(two), F.col("rest").alias(rest))
    out = StructType([*docs.schema.fields]).add(one, "long").add(two, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, text, CHUNK_BYTES):
            f1, f2 = _fingerprints(chunk, words(chunk, _WORDS))
            yield appended(chunk.rows, {one: f1, two: f2})

    marked = docs.mapInArrow(run, out).join(changed, [one, two], "left")
    return marked.select(*(F.coalesce(rest, text).alias(c) if c == text else F.col(c) for c in docs.columns))
