import hashlib
import random
import zlib

import pytest

from hushline.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def H(x):
    return hashlib.sha256(x.encode()).hexdigest()


def leaf(row, lower=False):
    key, text, lang, source, n = row
    if lower and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    fields = [key, source, lang, n, text]
    return H("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def climb(nodes):
    """Root, and for each node the (left, right) siblings on the way."""
    ways = [[] for _ in nodes]
    places = list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i:i + 16] for i in range(0, len(nodes), 16)]
        for k, p in enumerate(places):
            run = runs[p // 16]
            ways[k].append(("".join(run[:p % 16]), "".join(run[p % 16 + 1:])))
        nodes, places = [H("".join(r)) for r in runs], [p // 16 for p in places]
    return nodes[0], ways


def plain(rows):
    sources = {}
    for r in rows:
        sources.setdefault(r[3], []).append(r)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        mine = sorted(sources[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = mine, *climb([leaf(r) for r in mine])
    root, tops = climb([trees[s][1] for s in order])
    out = []
    for s, top in zip(order, tops):
        mine, subroot, ways = trees[s]
        for r, way in zip(mine, ways):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            folded = leaf(r, hit)
            for left, right in way + top:
                folded = H(left + folded + right)
            proof = H("".join(a + b for a, b in way + top))
            out.append((r[0], leaf(r), subroot, root, proof, folded, folded == root))
    return sorted(out, key=str)


def ours(docs):
    return sorted((tuple(r) for r in merkle.manifest(docs).collect()), key=str)


@pytest.mark.parametrize("sizes", [[1], [16], [17], [256], [257], [1, 300, 5], [4097, 2, 1, 40], [1] * 40])
def test_equals_plain_trees(spark, sizes):
    draw = random.Random(len(sizes))
    rows = [
        (draw.randrange(10**6), f"Text {draw.random()}", draw.choice(["en", None]), None if s == 2 else f"s{s}é", draw.choice([None, 7]))
        for s, n in enumerate(sizes) for _ in range(n)
    ]
    draw.shuffle(rows)
    assert ours(spark.createDataFrame(rows, SCHEMA).repartition(5)) == plain(rows)


def test_nulls_repeats_empty_and_long_texts_and_clashing_columns(spark):
    rows = [(None, None, None, None, None), (None, "A", "", "", 0), (1, "", "en", "", 0), (1, None, "en", "", 0), (1, "", "en", None, 0)]
    rows += [(5, "Same Row", "en", "hot", 8)] * 600 + [(7, "B" * 5_000_000, "en", "hot", 5_000_000)]
    docs = spark.createDataFrame([(*r, i, "x", "y") for i, r in enumerate(rows)], f"{SCHEMA}, tree int, idx string, digest string")
    assert ours(docs) == plain(rows)
    assert ours(docs.limit(0)) == []


def test_versions_share_what_a_leaf_does_not_touch():
    base = merkle.tree([H(str(i)) for i in range(256)], 2)
    version = merkle.changed(base, 2, 37, H("other"))
    assert version[0] != base[0]
    assert [a is b for a, b in zip(base[1], version[1])] == [k != 2 for k in range(16)]
    assert [a is b for a, b in zip(base[1][2][1], version[1][2][1])] == [k != 5 for k in range(16)]
    assert merkle.upwards(H("other"), merkle.siblings(base, 2, 37)) == version[0]


def test_versions_copy_ancestors_above_their_block_and_share_the_rest():
    leaves = [H(str(i)) for i in range(16 * 256 * 3 - 5)]
    root, ways = climb(leaves)
    blocks = [merkle.tree(leaves[i:i + 256], 2) for i in range(0, len(leaves), 256)]
    _, paths = climb([b[0] for b in blocks])
    at = 20 * 256 + 37
    whole, block_at = merkle.ancestry(blocks[20], [side for pair in paths[20] for side in pair])
    assert whole[0] == root and block_at == 20
    version = merkle.changed(whole, 4, at, H("other"))
    assert version[0] == merkle.upwards(H("other"), [side for pair in ways[at] for side in pair]) != root
    old, new = whole, version
    for k in (1, 4, 2, 5):
        assert [a is b for a, b in zip(old[1], new[1], strict=True)] == [i != k for i in range(len(old[1]))]
        old, new = old[1][k], new[1][k]
    assert whole[0] == root and old[0] == leaves[at] and new[0] == H("other")
