"""Merkle manifest of a dataset, with versions that share what a tampered leaf does not touch.

Leaves of a source, in order, are the lowest nodes of its tree; 16 consecutive nodes have one
parent, up to the source's root (subroot); the subroots are the lowest nodes of the tree
above them. Trees are built in aligned blocks of 256 nodes (two levels), one row of a table
for each block's root, which are the nodes of the next table. Paths come back down the same
way: each block gets the siblings of its root, level by level.

Inside a block the tree is persistent. A tampered leaf makes a version: its ancestors are
copied up to the root of all, everything else is shared with the tree as it was. For this a
block is set into the tree above it: the ancestors of its root with all their children, those
off the way as digests alone. So versions are made where their leaf is, and no node ever
meets all versions below it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from hushline.llm.storage import discard, written

#: Children of a node, levels of a block, and so nodes of a block.
FAN, HEIGHT = 16, 2
BLOCK = FAN ** HEIGHT
#: Signs of a digest.
DIGITS = 64
#: A row is tampered with where this divides the checksum of its key.
TAMPERED = 5
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: A node: its digest (64 hex signs) and its children; nothing is ever changed in it.
Node = tuple[str, tuple]


def digest_of(joined: str) -> str:
    return hashlib.sha256(joined.encode()).hexdigest()


def levels_of(n: int) -> int:
    """Levels above n nodes until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def tree(digests: list[str], levels: int) -> Node:
    """The root `levels` above the nodes; a last run may be short, even of one."""
    nodes = [(d, ()) for d in digests]
    for _ in range(levels):
        runs = [tuple(nodes[i:i + FAN]) for i in range(0, len(nodes), FAN)]
        nodes = [(digest_of("".join(c[0] for c in run)), run) for run in runs]
    (root,) = nodes
    return root


def changed(node: Node, levels: int, at: int, digest: str) -> Node:
    """The version with another digest at place `at`: ancestors copied, all other nodes shared."""
    if not levels:
        return digest, ()
    k, rest = divmod(at, FAN ** (levels - 1))
    children = node[1]
    children = (*children[:k], changed(children[k], levels - 1, rest, digest), *children[k + 1:])
    return digest_of("".join(c[0] for c in children)), children


def siblings(node: Node, levels: int, at: int) -> list[str]:
    """For each level from below: the digests left of the way to place `at`, and those right of it."""
    found = []
    for level in range(levels, 0, -1):
        k, at = divmod(at, FAN ** (level - 1))
        digests = [c[0] for c in node[1]]
        found.append(("".join(digests[:k]), "".join(digests[k + 1:])))
        node = node[1][k]
    return [side for pair in reversed(found) for side in pair]


def ancestry(node: Node, path: list[str]) -> tuple[Node, int]:
    """The root of all with a block's root set in at its place, and the number of that place among the nodes so deep.

    Nodes off the way are digests alone: no version of a leaf in the block changes what is below them.
    """
    at = 0
    for level, (left, right) in enumerate(zip(path[::2], path[1::2])):
        before, after = ([(side[i:i + DIGITS], ()) for i in range(0, len(side), DIGITS)] for side in (left, right))
        at += len(before) * FAN ** level
        children = (*before, node, *after)
        node = digest_of("".join(c[0] for c in children)), children
    return node, at


def upwards(digest: str, path: list[str]) -> str:
    """The root over a node as one who holds only the siblings on its way works it out; that of its version equals it."""
    for left, right in zip(path[::2], path[1::2]):
        digest = digest_of(left + digest + right)
    return digest


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*fields: Column) -> Column:
    """Digest of the fields, each with its length in bytes, or `-` for null."""
    return F.sha2(F.concat(*map(_field, fields)).cast("binary"), 256)


def numbered(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """Adds idx (from 0) in the order given, and total, by group; the rows are written in between.

    Rows are dealt by ranges of (group, order), so a group of any size is spread, equal rows
    too. Each task numbers what it has; a small table of counts by task gives what is before.
    """
    spark = rows.sparkSession
    keys = [F.col(group), *(F.col(c).asc_nulls_first() for c in order), F.col("tie")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.withColumn("tie", F.xxhash64(F.monotonically_increasing_id()))
    ranged = ranged.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.column(batch.schema.get_field_index(group))
            codes = names.dictionary_encode().indices.to_numpy(False)
            begins = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
            place = np.arange(len(codes)) - np.repeat(begins, np.diff(np.append(begins, len(codes))))
            if names[0].as_py() == last:
                place[:begins[1] if len(begins) > 1 else None] += seen
            last, seen = names[len(names) - 1].as_py(), int(place[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(codes), part, np.int32)), pa.array(place.astype(np.int64))],
                names=[*batch.schema.names, "part", "place"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema)
    placed = written(ranged.mapInArrow(run, f"{fields}, part int, place long"), "placed")
    counts = placed.groupBy("part", group).agg(F.count(F.lit(1)).alias("here"))
    # As many rows of a group as there are tasks.
    before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(counts.select(
        "part", group, F.coalesce(F.sum("here").over(before), F.lit(0)).alias("offset"),
        F.sum("here").over(Window.partitionBy(group)).alias("total"),
    ), "offsets")
    return placed.join(offsets, ["part", group]).withColumn("idx", F.col("offset") + F.col("place")).drop("part", "place", "offset")


def _in_blocks(nodes: DataFrame) -> DataFrame:
    block = F.floor(F.col("idx") / BLOCK).cast("long")
    ordered = nodes if "block" in nodes.columns else nodes.withColumn("block", block)
    return ordered.repartition("tree", "block").sortWithinPartitions("tree", "block", "idx")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[dict]]]:
    """Rows of one block after the other."""
    rows = (row for batch in batches for row in batch.to_pylist())
    for key, found in groupby(rows, lambda r: (r["tree"], r["block"])):
        yield key, list(found)


def _out(columns: dict[str, tuple[pa.DataType, list]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for t, v in columns.values()], names=list(columns))


def block_roots(nodes: DataFrame) -> DataFrame:
    """(tree, idx, total, digest): the roots of the nodes' blocks, which are the nodes of the next table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (name, block), rows in _blocks(batches):
            total = rows[0]["total"]
            root = tree([r["digest"] for r in rows], min(HEIGHT, levels_of(total)))
            yield _out({
                "tree": (pa.string(), [name]), "idx": (pa.int64(), [block]),
                "total": (pa.int64(), [-(-total // BLOCK)]), "digest": (pa.string(), [root[0]]),
            })

    chosen = nodes.select("tree", "idx", "total", "digest")
    return _in_blocks(chosen).mapInArrow(run, "tree string, idx long, total long, digest string")


def built(nodes: DataFrame) -> list[DataFrame]:
    """Tables of nodes from the lowest up to that of the trees' roots (one node a tree)."""
    tables = [nodes]
    while (tables[-1].agg(F.max("total")).first()[0] or 0) > 1:
        tables.append(written(block_roots(tables[-1]), "nodes"))
    return tables


_PATH = "tree string, block long, idx long, total long, digest string, above string, path array<string>"


def _with_paths(nodes: DataFrame, paths: DataFrame, *extra: str) -> DataFrame:
    """Nodes in blocks, each block headed by the row with the path of its root."""
    kinds = dict(nodes.dtypes)
    heads = paths.select(
        "tree", F.col("idx").alias("block"), F.lit(-1).cast("long").alias("idx"), F.lit(None).cast("long").alias("total"),
        F.lit(None).cast("string").alias("digest"), "above", "path", *(F.lit(None).cast(kinds[c]).alias(c) for c in extra),
    )
    rows = nodes.select(
        "tree", F.floor(F.col("idx") / BLOCK).cast("long").alias("block"), "idx", "total", "digest",
        F.lit(None).cast("string").alias("above"), F.lit(None).cast("array<string>").alias("path"), *extra,
    )
    return _in_blocks(heads.unionByName(rows))


def paths_down(tables: list[DataFrame], tops: DataFrame) -> DataFrame:
    """(tree, idx, above, path) for the lowest nodes of `tables`, from those of the trees' roots.

    path: the siblings left and right on each level up to the root of all; above: as in `tops`.
    """
    paths = tops
    for nodes in reversed(tables):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for (name, _), (head, *rows) in _blocks(batches):
                levels = min(HEIGHT, levels_of(rows[0]["total"]))
                root = tree([r["digest"] for r in rows], levels)
                yield _out({
                    "tree": (pa.string(), [name] * len(rows)), "idx": (pa.int64(), [r["idx"] for r in rows]),
                    "above": (pa.string(), [head["above"]] * len(rows)),
                    "path": (pa.list_(pa.string()), [siblings(root, levels, i) + head["path"] for i in range(len(rows))]),
                })

        found = _with_paths(nodes, paths).mapInArrow(run, "tree string, idx long, above string, path array<string>")
        paths = written(found, "paths")
    return paths


def manifest(
    docs: DataFrame, key: str = "doc_id", source: str = "source", lang: str = "lang", n_chars: str = "n_chars", text: str = "text",
) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified) for each row.

    leaf is the digest of the five columns; rows of a source are ordered by key (null first;
    rows with one key by their leaves), sources by name (null first). proof_sha256 is the
    digest of the siblings on the way from the leaf to the root. folded_root is the root of
    the version in which this row alone is tampered with: where TAMPERED divides the
    checksum of its key, the text's A-Z are lower-cased; other rows (and null keys) make no
    version, their root is the one shared by all. verified: folded_root equals root.

    Nulls in any column count as nulls in the leaf; a null text cannot be tampered with. Empty
    texts differ from null ones. Repeated rows are leaves of their own, side by side. Texts of
    any length are hashed whole. An empty table gives no rows. Columns not named are not
    looked at, so their names cannot clash.
    """
    columns = [F.col(c) for c in (key, source, lang, n_chars, text)]
    lowered = F.translate(columns[-1], _UPPER, _UPPER.lower())
    hit = F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % TAMPERED == 0, F.lit(False)) & columns[-1].isNotNull()
    # The name of a source's tree: empty for null, so that nulls come first and equal each other.
    name = F.when(F.col(source).isNull(), "").otherwise(F.concat(F.lit("="), F.col(source).cast("string")))
    leaves = docs.select(
        name.alias("tree"), F.col(key).alias("key"), leaf_digest(*columns).alias("digest"),
        F.when(hit, leaf_digest(*columns[:-1], lowered)).alias("tampered"),
    )
    leaves = numbered(leaves, "tree", "key", "digest")
    tables = built(leaves)
    subroots = tables[-1].select(F.lit("").alias("all"), F.col("tree").alias("name"), "digest")
    sources = numbered(subroots, "all", "name").withColumnRenamed("all", "tree")
    sources = written(sources, "sources")
    above = built(sources)
    top = above[-1].first()
    root = top["digest"] if top else ""

    start = above[-1].select("tree", "idx", "digest", F.array().cast("array<string>").alias("path"))
    start = start.select("tree", "idx", F.col("digest").alias("above"), "path")
    by_idx = paths_down(above, start) if len(above) > 1 else start
    # A source's tree, its subroot and the path from there: the head of its highest block.
    tops = by_idx.join(sources.select("idx", "name", "digest"), "idx").select(
        F.col("name").alias("tree"), F.lit(0).cast("long").alias("idx"), F.col("digest").alias("above"), "path"
    )
    heads = written(tops, "paths")
    if len(tables) > 1:
        heads = paths_down(tables[1:], heads)
    kind = leaves.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (head, *rows) in _blocks(batches):
            levels = min(HEIGHT, levels_of(rows[0]["total"]))
            base = tree([r["digest"] for r in rows], levels)
            beyond = "".join(head["path"])
            whole, block_at = ancestry(base, head["path"])
            depth = levels + len(head["path"]) // 2
            proofs, folded = [], []
            for i, row in enumerate(rows):
                proofs.append(digest_of("".join(siblings(base, levels, i)) + beyond))
                if row["tampered"] is None:
                    folded.append(root)
                else:
                    folded.append(changed(whole, depth, block_at * FAN ** levels + i, row["tampered"])[0])
            n = len(rows)
            yield _out({
                "key": (key_type, [r["key"] for r in rows]), "leaf": (pa.string(), [r["digest"] for r in rows]),
                "subroot": (pa.string(), [head["above"]] * n), "root": (pa.string(), [root] * n),
                "proof_sha256": (pa.string(), proofs), "folded_root": (pa.string(), folded),
                "verified": (pa.bool_(), [f == root for f in folded]),
            })

    from pyspark.sql.pandas.types import to_arrow_type

    key_type = to_arrow_type(leaves.schema["key"].dataType)
    found = _with_paths(leaves, heads, "key", "tampered").mapInArrow(
        run, f"key {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    )
    return found.withColumnRenamed("key", key)
