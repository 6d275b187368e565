"""Near copies by fast similarity sketching, banding and exact verification.

A document's set holds the hashes of its shingles. The sketch has SIZE coordinates: in round
i each shingle is hashed to a value and a random coordinate, and an empty coordinate keeps
the least value that falls into it; rounds SIZE and later put every shingle into coordinate
i - SIZE, so all coordinates fill, whatever the size of the set. Two sets agree in a
coordinate with the probability of their similarity. Coordinates are banded; documents which
share a band are candidates, and a link holds only if the whole sets confirm it.

Equal sets are one class from the start. Within a band's bucket no list of all pairs is made:
a few leaders are compared with the members that are not yet known to be connected with them;
then they leave the bucket, and the number of leaders grows until each bucket is connected.
The first to lead are those that share most, as an original does with its altered copies; one
round then connects most of a large group. A pair is screened inside the join by a longer
sketch of two bits a coordinate, and only what may reach the threshold is compared as whole sets. So each
candidate pair is screened, compared or already connected.

A pair right at the threshold is missed by the bands with a chance of one in 8 million and by
the screen with one in 300,000; both fall fast above it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from hushline.llm.arrowtext import Chunk, Hasher, WindowHasher, appended, chunks, mix, words
from hushline.llm.components import components
from hushline.llm.storage import discard, free_name, written

#: A pair at the threshold of 0.8 shares no band with probability (1 - 0.8 ** 5) ** 40, about one in 8 million.
BANDS, ROWS = 40, 5
SIZE = BANDS * ROWS
#: Coordinates of the sketch that candidates are screened by, and the standard errors which a pair at the threshold may lack.
BITS, ERRORS = 1024, 4.5
#: Leaders of a bucket grow by this factor from round to round.
MORE_LEADERS = 32
U64 = np.uint64
_WORDS, _WINDOWS = Hasher(5, fold=True), WindowHasher(5)


def shingles(chunk: Chunk, n: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of n words; fewer words are one run."""
    found = words(chunk, _WORDS)
    counts, first = found.counts, found.first
    at = found.window_starts(n)
    runs = _WINDOWS.windows(found.hashes, at, n)
    bounds = np.searchsorted(at, first)
    short = np.flatnonzero((counts > 0) & (counts < n))
    whole = dict(zip(short.tolist(), _WINDOWS.windows(found.hashes, first[short], counts[short])))
    return [
        np.array([whole[i]], U64) if i in whole else np.unique(runs[bounds[i]:bounds[i + 1]]) for i in range(len(chunk))
    ]


def sketches(sets: list[np.ndarray], size: int = SIZE) -> np.ndarray:
    """A row of coordinates for each nonempty set; empty sets have a row of the largest value."""
    n = len(sets)
    most = U64(0xFFFFFFFFFFFFFFFF)
    out = np.full((n, size), most)
    sizes = np.array([len(s) for s in sets])
    active = np.flatnonzero(sizes)
    if not len(active):
        return out
    items = np.concatenate([sets[i] for i in active])
    owner = np.repeat(active, sizes[active])
    for turn in range(2 * size):
        value = mix(items + U64((turn + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        if turn < size:
            place = ((value >> U64(32)) * U64(size)) >> U64(32)
        else:
            place = np.full(len(items), turn - size, U64)
        value = (value << U64(32)) | (value >> U64(32))
        fresh = np.full((n, size), most)
        np.minimum.at(fresh.reshape(-1), owner * size + place.astype(np.int64), value)
        np.copyto(out, fresh, where=out == most)
        open_ = (out[active] == most).any(axis=1)
        if not open_.all():
            active = active[open_]
            if not len(active):
                break
            left = np.zeros(n, bool)
            left[active] = True
            stay = left[owner]
            items, owner = items[stay], owner[stay]
    return out


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """A key for each band of each sketch."""
    parts = sketch.reshape(len(sketch), BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=U64) * U64(0xD6E8FEB86659FD93)
    key = np.broadcast_to(key, parts.shape[:2]).copy()
    for k in range(ROWS):
        key = mix(key ^ parts[:, :, k])
    return key


def bit_sketches(sets: list[np.ndarray]) -> np.ndarray:
    """The lowest two bits of each coordinate of a longer sketch, as two rows of bits, 64 to a number."""
    found = sketches(sets, BITS)
    rows = [np.packbits(((found >> U64(k)) & U64(1)).astype(np.uint8), axis=1).view(np.int64) for k in range(2)]
    return np.concatenate(rows, axis=1)


def _list_array(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    flat = np.concatenate(rows).view(np.int64) if rows else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


#: Rows sketched together and bytes of text whose sets are made together; they bound the arrays.
SKETCHED, SET_BYTES = 1024, 1 << 20


def sketched_batches(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """Sizes, fingerprints and band keys for batches of (id, text); a worker keeps its largest arrays, so texts go in small pieces."""
    for chunk in chunks(batches, "text", SET_BYTES):
        sets = shingles(chunk, n)
        keys = [band_keys(sketches(sets[i:i + SKETCHED])) for i in range(0, len(sets), SKETCHED)]
        keys = np.concatenate(keys).view(np.int64)
        sizes = np.array([len(s) for s in sets], np.int64)
        flat = pa.FixedSizeListArray.from_arrays(pa.array(keys.reshape(-1)), BANDS).cast(pa.list_(pa.int64()))
        bands = pa.ListArray.from_arrays(
            flat.offsets, flat.values, mask=pa.array(sizes == 0)
        )
        yield appended(chunk.rows.select(["id"]), {
            "n_shingles": sizes,
            "f1": np.array([mix(s).sum(dtype=U64) for s in sets], U64).view(np.int64),
            "f2": np.array([mix(s ^ U64(0xA0761D6478BD642F)).sum(dtype=U64) for s in sets], U64).view(np.int64),
            "bands": bands,
        })


def _sketched(docs: DataFrame, n: int) -> DataFrame:
    """(id, n_shingles, f1, f2, bands) for each row of (id, text); bands null for empty sets."""
    out = "id long, n_shingles long, f1 long, f2 long, bands array<long>"
    return docs.mapInArrow(lambda batches: sketched_batches(batches, n), out)


def _sets(docs: DataFrame, n: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, "text", SET_BYTES):
            sets = shingles(chunk, n)
            bits = np.concatenate([bit_sketches(sets[i:i + SKETCHED // 4]) for i in range(0, len(sets), SKETCHED // 4)])
            yield appended(chunk.rows.select(["id"]), {"shingles": _list_array(sets), "bits": _list_array(list(bits))})

    return docs.mapInArrow(run, "id long, shingles array<long>, bits array<long>")


def _close(a: Column, b: Column, percent: int) -> Column:
    """Sizes that can reach the threshold at all."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _alike(a: str, b: str, percent: int) -> Column:
    """Whether longer sketches agree often enough for the threshold.

    Two sets agree in both bits of a coordinate with the probability of their similarity, and
    by chance in a quarter of the others.
    """
    share = (1 + 3 * percent / 100) / 4
    least = BITS * share - ERRORS * (BITS * share * (1 - share)) ** 0.5
    n = BITS // 64
    differ = [F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i))) for i in range(2 * n)]
    unlike = sum(F.bit_count(differ[i].bitwiseOR(differ[n + i])) for i in range(n))
    return unlike <= BITS - int(least)


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs (member, leader) those whose whole sets reach the threshold.

    The member's set is joined first: a leader with very many members is then the key of the
    second join alone, which adaptive execution splits.
    """
    one = sets.select(F.col("id").alias("member"), F.col("shingles").alias("mine"))
    other = sets.select(F.col("id").alias("leader"), F.col("shingles").alias("theirs"))
    common = F.size(F.array_intersect("mine", "theirs"))
    return (
        pairs.join(one, "member").join(other, "leader")
        .withColumn("common", common)
        .where(100 * F.col("common") >= percent * (F.size("mine") + F.size("theirs") - F.col("common")))
        .select("member", "leader")
    )


def near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 4, percent: int = 80) -> DataFrame:
    """(key, n_shingles, component_id, kept) for each row.

    Texts without words have an empty set and are linked with nothing. Rows of one key are
    one document: links of any of them count. Rows with a null key take no part: their
    component is null and they are kept. Whole texts count; an empty table gives no rows.
    """
    source = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    table = written(_sketched(source, n), "sketches")
    filled = table.where("n_shingles > 0 and id is not null")
    classes = written(
        filled.groupBy("f1", "f2").agg(F.min("id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")),
        "classes",
    )
    members = filled.select("id", "f1", "f2").join(classes.select("f1", "f2", "rep"), ["f1", "f2"]).select("id", "rep")
    # Equal sets need no graph: their representative stands for them. Keys with several texts do.
    several = members.groupBy("id").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low != high")
    several = written(several.select("id", "low"), "several")
    edges = members.join(several, "id").where("rep != low").select(F.col("rep").alias("a"), F.col("low").alias("b"))
    found_links = _bucket_links(docs, key, text, classes, n, percent)
    label = components(reduce(DataFrame.unionByName, found_links, edges), "copies")
    labelled = written(
        classes.select("f1", "f2", "rep").join(label.withColumnRenamed("node", "rep"), "rep", "left").select(
            "f1", "f2", F.coalesce("component", "rep").alias("component")
        ), "labelled",
    )
    discard(classes, several, label, *found_links)
    rows = table.withColumn("alone", F.col("id").isNull() | (F.col("n_shingles") == 0))
    found = rows.where("not alone").join(labelled, ["f1", "f2"]).select("id", "n_shingles", "component").unionByName(
        rows.where("alone").select("id", "n_shingles", F.col("id").alias("component"))
    )
    component = F.col("component")
    return found.select(
        F.col("id").alias(key), "n_shingles", component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )


def _bucket_links(
    docs: DataFrame, key: str, text: str, classes: DataFrame, n: int, percent: int
) -> list[DataFrame]:
    """Tables of links (a, b) between representatives of classes, enough to connect all that are linked."""
    rows = classes.select("rep", "n", F.posexplode("bands").alias("band", "bucket"))
    shared = rows.groupBy("bucket").agg(
        F.min("rep").alias("low"), F.max("rep").alias("high"), F.count(F.lit(1)).alias("size")
    ).where("low != high").select("bucket", "size")
    shared = written(shared, "shared")  # so that the rows of a very full bucket can be split
    buckets = written(rows.join(shared, "bucket").select("bucket", "band", "rep", "n", "size"), "buckets")
    weights = written(buckets.groupBy("rep").agg(F.sum("size").alias("weight")), "weights")
    source = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    sets = written(_sets(source.join(weights.select(F.col("rep").alias("id")), "id", "left_semi"), n), "sets")
    halves = F.transform("bands", lambda b: F.shiftright(b, 32).cast("int"))
    about = sets.select(F.col("id").alias("rep"), "bits").join(weights, "rep").join(
        classes.select("rep", halves.alias("bands")), "rep"
    )

    links: list[DataFrame] = []
    label = written(weights.select("rep", F.col("rep").alias("comp"), F.lit(0).alias("degree")), "labels")
    leaders = 1
    live = written(buckets.select("bucket", "band", "rep", "n").join(about, "rep"), "live")
    discard(buckets, shared)
    while True:
        rows = live.join(label, "rep")
        # Buckets whose members are all known to be connected are done.
        open_ = rows.groupBy("bucket").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low != high")
        open_ = written(open_.select("bucket"), "open_buckets")
        rows = written(rows.join(open_, "bucket"), "open")
        discard(open_, live, label)
        if rows.isEmpty():
            discard(rows, sets, weights)
            return links
        # First those with most links so far, then those that share most with others.
        order = [F.desc("degree"), F.desc("weight"), "rep"]
        place = F.row_number().over(Window.partitionBy("bucket").orderBy(*order))
        heads = written(
            rows.withColumn("place", place).where(F.col("place") <= leaders).select(
                "bucket", F.col("rep").alias("leader"), F.col("n").alias("leader_n"), F.col("comp").alias("leader_comp"),
                F.col("bits").alias("leader_bits"), F.col("bands").alias("leader_bands"),
            ), "heads",
        )
        wanted = (rows["comp"] != heads["leader_comp"]) & _close(rows["n"], heads["leader_n"], percent)
        # A pair that shares many buckets is looked at in the first of them alone. Both stay in that
        # bucket until one of them leads it, so the pair's turn comes.
        shares = F.zip_with("bands", "leader_bands", lambda a, b: a == b)
        earlier = F.exists(F.slice(shares, F.lit(1), F.col("band")), lambda x: x)
        on = (rows["bucket"] == heads["bucket"]) & wanted & _alike("bits", "leader_bits", percent) & ~earlier
        pairs = rows.join(heads, on).select(F.col("rep").alias("member"), "leader").distinct()
        linked = _linked(pairs, sets, percent).select(F.col("member").alias("a"), F.col("leader").alias("b"))
        links.append(written(linked, "links"))
        label = _labels(weights, reduce(DataFrame.unionByName, links))
        gone = heads.select("bucket", F.col("leader").alias("rep"))
        rest = rows.join(gone, ["bucket", "rep"], "left_anti")
        live = written(rest.select("bucket", "band", "rep", "n", "bits", "bands", "weight"), "live")
        discard(rows, heads)
        leaders *= MORE_LEADERS


def _labels(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(rep, comp, degree): comp is the neighbour with most links, or the node itself if that has more.

    Nodes of one comp are connected by way of it. Those of one component may have several; they
    are then compared once more than needed, and joined in the end all the same.
    """
    ends = links.select(F.col("a").alias("rep"), F.col("b").alias("other"))
    ends = ends.unionByName(links.select(F.col("b").alias("rep"), F.col("a").alias("other")))
    degrees = written(ends.groupBy("rep").agg(F.count(F.lit(1)).alias("degree")), "degrees")
    near = ends.join(degrees.withColumnRenamed("rep", "other"), "other").groupBy("rep").agg(
        F.max(F.struct("degree", F.col("other").alias("rep"))).alias("best")
    )
    own = F.struct(F.coalesce("degree", F.lit(0)).alias("degree"), F.col("rep"))
    rows = nodes.select("rep").join(degrees, "rep", "left").join(near, "rep", "left")
    label = written(rows.select(
        "rep", F.greatest(own, F.coalesce("best", own))["rep"].alias("comp"), own["degree"].alias("degree")
    ), "labels")
    discard(degrees)
    return label


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """The rows without all but the first (by key, null last) of each group of near copies, columns unchanged.

    Rows are compared, whatever their keys: each gets a number of its own, written once. So two
    different texts under one key are two documents, and copies without a key are copies all
    the same. Null texts and texts without words are copies of nothing and stay. Texts of any length
    are compared whole. Columns may have any names; an empty table gives no rows.
    """
    own = free_name(docs, "row_number")
    numbered = written(docs.withColumn(own, F.monotonically_increasing_id()), "numbered")
    groups = near_copies(numbered.select(own, text), own, text, n, percent).select(own, "component_id")
    keys = numbered.select(F.col(own), F.col(key).alias("key"))
    first = F.min(F.struct(F.col("key").isNull(), F.col("key"), F.col(own).alias("row"))).alias("first")
    kept = keys.join(groups, own).groupBy("component_id").agg(first).select(F.col("first.row").alias(own))
    return numbered.join(kept, own, "left_semi").drop(own)
