import random
import tracemalloc

import numpy as np
import pyarrow as pa

import brute
from hushline.llm import minhash
from hushline.llm.components import components


def altered(text, seed, share):
    draw = random.Random(seed)
    w = text.split()
    for _ in range(int(len(w) * share)):
        w[draw.randrange(len(w))] = f"n{draw.randrange(10**9)}"
    return " ".join(w)


def rows(prose):
    out = [(i, prose(i, 5 + 7 * i)) for i in range(40)]
    base = prose(99, 300)
    out += [(100 + i, altered(base, i, 0.002 * i)) for i in range(40)]  # from nearly equal to unlike
    out += [(200 + i, base.upper()) for i in range(30)] + [(300 + i, altered(base, 7, 0.03)) for i in range(5)]
    out += [(400, None), (401, ""), (402, " \n"), (403, "a b"), (404, "A  B"), (405, "a"), (406, "long " * 3000)]
    return out


def test_equals_all_pairs(spark, prose):
    docs = rows(prose)
    got = minhash.near_copies(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)).collect()
    want = brute.near_copies(docs)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want and len(got) == len(docs)
    assert all(r["kept"] == (r["component_id"] == r["doc_id"]) for r in got)


def test_hub_with_altered_copies_unlike_each_other(spark, prose):
    base = prose(5, 400)
    docs = [(0, base)] + [(i, altered(base, i, 0.018)) for i in range(1, 60)]
    docs = [(1000 - k, t) for k, t in docs]
    got = minhash.near_copies(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute.near_copies(docs)


def test_nulls_repeated_rows_and_one_of_each(spark, prose):
    a, b = prose(1, 50), prose(2, 50)
    docs = spark.createDataFrame(
        [(1, a, "x"), (1, a, "x"), (2, a, "y"), (3, b, None), (None, a, "n"), (None, None, "n"), (4, None, "z"), (2, b, "y")],
        "doc_id long, text string, kept_key string",
    )
    got = sorted(map(tuple, minhash.near_copies(docs).collect()), key=str)
    n = len(set(zip(*(a.split()[k:] for k in range(4)))))
    # 2 has both texts, so 1, 2 and 3 are connected.
    assert got == sorted([(1, n, 1, True)] * 2 + [(2, n, 1, False)] * 2 + [(3, 47, 1, False), (None, n, None, True), (None, 0, None, True), (4, 0, 4, True)], key=str)
    kept = minhash.one_of_each(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    # One row of each text, whatever their ids, and all without words.
    assert sorted((r["text"] for r in rows), key=str) == sorted([a, b, None, None], key=str)
    assert {r["doc_id"] for r in rows if r["text"] == b} <= {2, 3} and {r["doc_id"] for r in rows if not r["text"]} == {None, 4}
    assert minhash.near_copies(docs.limit(0)).collect() == [] and minhash.one_of_each(docs.limit(0)).collect() == []


def test_sketches_fill_and_estimate():
    draw = np.random.default_rng(3)
    pool = draw.integers(0, 1 << 63, 4000, dtype=np.uint64)
    sets = [pool[:1], pool[:2], pool[:3000], pool[300:3300], np.zeros(0, np.uint64)]
    found = minhash.sketches(sets)
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    assert (found[:4] != full).all() and (found[4] == full).all()
    assert abs((found[2] == found[3]).mean() - 2700 / 3300) < 0.12
    assert (minhash.sketches([pool[:3000]])[0] == found[2]).all()  # the same beside any others


def test_components_against_union_find(spark):
    draw = random.Random(4)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1100)] + [(5, 5), (None, 3)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges[:-1]:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {n: root(n) for n in parent if root(n) != n}


def test_sketching_holds_arrays_of_a_small_piece_of_text():
    draw, some = random.Random(5), [f"w{i}" for i in range(5000)]
    texts = [" ".join(draw.choices(some, k=400)) for _ in range(4000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(4000), pa.int64()), pa.array(texts)], names=["id", "text"])
    tracemalloc.start()
    try:
        made = sum(found.num_rows for found in minhash.sketched_batches(iter([batch]), 4))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert made == 4000 and most < 60 << 20
