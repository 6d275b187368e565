import numpy as np

from hushline.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every=50, k=5):
    use = {}
    for i, v, *_ in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            use.setdefault(i, np.array(v, np.float32).astype(float))
    ids = np.array(sorted(use))
    x = np.array([use[i] for i in ids])
    out = {}
    for i in ids[ids % every == 0]:
        score = ann.cosines(use[i][None], x)[0]
        score[ids == i] = -2
        out[int(i)] = [(int(ids[j]), score[j]) for j in np.lexsort((ids, -score))[:min(k, len(ids) - 1)]]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_recall_on_a_table(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").unionByName(
        spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").selectExpr("vec_id + 100000 AS vec_id", "embedding", "label")
    )
    want = brute([tuple(r) for r in vectors.collect()])
    got = answers(ann.nearest(vectors))
    assert got.keys() == want.keys() and all(len(v) == 5 for v in got.values())
    hit = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hit >= 0.9 * 5 * len(want)
    for q, near in got.items():
        true = dict(want[q])
        assert all(abs(true[i] - s) < 1e-12 for i, s in near if i in true)


def test_clusters_hot_vectors_and_ties(spark, monkeypatch):
    monkeypatch.setattr(ann, "GROUP_ROWS", 64)
    draw = np.random.default_rng(1)
    centres = draw.standard_normal((20, 16))
    rows = [(i, (centres[i % 20] + 0.02 * draw.standard_normal(16)).astype(np.float32).tolist(), 0) for i in range(900)]
    rows += [(1000 + i, rows[0][1], 1) for i in range(300)]  # a third are one vector
    want, got = brute(rows), answers(ann.nearest(spark.createDataFrame(rows, SCHEMA).repartition(4)))
    assert got[1000] == want[1000] and got[0] == want[0]
    hit = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hit >= 0.9 * 5 * len(want)


def recall(got, want):
    return sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) / sum(map(len, want.values()))


def test_random_vectors_are_found_by_probes(spark):
    draw = np.random.default_rng(3)
    rows = [(i, draw.standard_normal(64).astype(np.float32).tolist(), 0) for i in range(6000)]
    found = ann.nearest(spark.createDataFrame(rows, SCHEMA)).cache()
    assert {r["found_by"] for r in found.collect()} == {"probes"}
    assert recall(answers(found), brute(rows)) >= 0.9


def pairs(x, k=5):
    near = x[:100] @ x.T
    near[np.arange(100), np.arange(100)] = -2
    return np.repeat(x[:100], k, axis=0), x[np.argsort(-near, axis=1)[:, :k].ravel()]


def test_the_fit_narrows_cells_where_vectors_have_structure():
    draw = np.random.default_rng(4)
    centres = draw.standard_normal((500, 16))
    tight = ann._unit(centres[draw.integers(0, 500, 6000)] + 0.02 * draw.standard_normal((6000, 16)))
    loose = ann._unit(draw.standard_normal((6000, 64)))
    tables, probes = ann.fitted_tables(*pairs(tight), tight, 10_000_000)
    assert tables.hashes >= 8 and ann.fitted_probes(tables, *pairs(tight), tight)[1] < 0.05
    tables, probes = ann.fitted_tables(*pairs(loose), loose, 200_000)
    assert ann.fitted_probes(tables, *pairs(loose), loose)[0] == probes


def test_queries_short_of_k_are_compared_with_all_vectors(spark):
    draw = np.random.default_rng(5)
    centre = draw.standard_normal(16)
    rows = [(i, (centre + 0.01 * draw.standard_normal(16)).astype(np.float32).tolist(), 0) for i in range(1, 4000) if i % 50]
    rows.append((50, (-centre).astype(np.float32).tolist(), 0))  # its neighbours are all at the other side
    found = ann.nearest(spark.createDataFrame(rows, SCHEMA))
    assert answers(found) == brute(rows)


def test_where_no_fit_reaches_the_aim_all_vectors_are_compared(spark, monkeypatch):
    monkeypatch.setattr(ann, "AIM", 1.1)
    draw = np.random.default_rng(6)
    rows = [(i, draw.standard_normal(8).astype(np.float32).tolist(), 0) for i in range(600)]
    found = ann.nearest(spark.createDataFrame(rows, SCHEMA))
    assert {r["found_by"] for r in found.collect()} == {"blocks"} and answers(found) == brute(rows)


def test_long_vectors_clashing_names_and_rows_of_one_id(spark):
    draw = np.random.default_rng(7)
    rows = [(i, draw.standard_normal(3000).astype(np.float32).tolist(), 0) for i in range(120)]
    plain = spark.createDataFrame(rows, SCHEMA)
    want = answers(ann.nearest(plain))
    more = plain.selectExpr("*", "1 AS vec", "2 AS cell", "3 AS grp", "4 AS turn", "5 AS query_id", "6 AS part", "7 AS rounds")
    assert answers(ann.nearest(more.union(more))) == want == brute(rows)
    two = spark.createDataFrame([(0, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (1, [1.0, 0.0], 0)], SCHEMA)
    assert answers(ann.nearest(two)) == {0: [(1, 0.0)]}  # the least vector of id 1


def test_vectors_that_take_no_part_and_few_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (1, [2.0, 0.1], 1), (2, None, 1), (3, [0.0, 0.0], 1), (4, [nan, 1.0], 1), (5, [inf, 1.0], 1), (6, [None, 1.0], 1)]
    rows += [(7, [-1.0, 0.0], None), (None, [1.0, 0.0], 1), (50, [], 1), (100, [0.0, 3.0], 1), (0, [1.0, 0.0], 1), (1, [2.0, 0.1], 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {q: [i for i, _ in v] for q, v in answers(ann.nearest(df)).items()} == {0: [1, 100, 7], 100: [1, 0, 7]}
    assert ann.nearest(df.limit(0)).collect() == [] and ann.nearest(df.where("vec_id = 0")).collect() == []


def test_probes_come_by_estimated_success():
    below = np.array([0.1, 0.6, 0.5])
    steps = list(ann.perturbations(below, 1000))
    assert len(steps) == 27 and len({tuple(s) for s in steps}) == 27
    costs = [sum((b if s < 0 else 1 - b) ** 2 for b, s in zip(below, step) if s) for step in steps]
    assert costs == sorted(costs)


def test_listed_cells_come_in_the_order_of_the_heap():
    draw = np.random.default_rng(8)
    tables, x = ann.Tables(12, 5), ann._unit(draw.standard_normal((20, 12)))
    place = tables.places(x, 0)
    home = np.floor(place)
    got = tables.probes(x, 0, 100)
    for i in range(20):
        steps = np.array(list(ann.perturbations(place[i] - home[i], 100)))
        assert got[i].tolist() == tables.cells(home[i] + steps, 0).tolist()
