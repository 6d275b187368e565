import itertools
import random

from pyspark.sql import functions as F

from hushline.llm import entries, packing


def test_bounds_are_optimal():
    draw = random.Random(1)
    for _ in range(300):
        cells = sorted({draw.randint(1, 60): draw.randint(1, 9) for _ in range(draw.randint(1, 9))}.items())
        k = draw.randint(1, 5)
        bounds = packing.best_bounds(cells, k)
        cost = lambda bs: sum(c * next(b for b in bs if b >= n) for n, c in cells)
        lengths = [n for n, _ in cells]
        best = min(
            cost(bs) for r in range(1, k + 1) for bs in itertools.combinations(lengths, min(r, len(lengths))) if bs[-1] == lengths[-1]
        )
        assert len(bounds) <= k and cost(bounds) == best


def test_cells_round_up_within_a_256th(spark):
    lengths = [0, 1, 511, 512, 513, 1000, 1025, 100_001, 1 << 40, (1 << 40) + 1]
    df = spark.createDataFrame([(n,) for n in lengths], "n long")
    for n, cell in df.select("n", packing.length_cell(F.col("n"))).collect():
        assert max(n, 1) <= cell <= max(n, 1) * (1 + 1 / 256)


def test_batches_hold_their_budget_and_all_rows(spark):
    draw = random.Random(2)
    rows = [(i, draw.choice([None, 0, 3, 50, draw.randint(1, 900), 5000]), "b") for i in range(3000)] + [(7, 3, "b"), (None, 3, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, n long, bucket string").repartition(7)
    got = packing.packed(docs, "n", buckets=6, budget=2000)
    assert got.columns == ["doc_id", "n", "bucket", "bucket_", "width", "batch_group", "batch", "slot"]
    found = got.collect()
    assert sorted(str((r["doc_id"], r["n"])) for r in found) == sorted(str((a, b)) for a, b, _ in rows)
    batches = {}
    for r in found:
        assert max(r["n"] or 0, 1) <= r["width"]
        batches.setdefault((r["bucket_"], r["batch_group"], r["batch"]), []).append(r)
    assert len({r["width"] for r in found}) <= 6
    for batch in batches.values():
        width = batch[0]["width"]
        assert {r["width"] for r in batch} == {width}
        assert sorted(r["slot"] for r in batch) == list(range(len(batch)))
        assert len(batch) * width <= 2000 or len(batch) == 1
    partly = sum(len(b) < max(1, 2000 // b[0]["width"]) for b in batches.values())
    assert partly <= len({(b[0]["bucket_"], b[0]["batch_group"]) for b in batches.values()})


def test_empty_table_and_word_counts(spark):
    assert packing.packed(spark.createDataFrame([], "n long"), "n").collect() == []
    texts = ["", None, " a\tb\n\nc ", "é\xa0é x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(packing.word_count(F.col("t"))).collect()] == [0, 0, 3, 2]


def test_the_query_packs_by_tokens(spark, tmp_path):
    # One word each for white space, thousands of tokens.
    texts = ["\u6f22\u5b57" * 4000, "a1b2c3" * 3000, "short text", None]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    counted = {r["doc_id"]: r["n_tokens"] for r in entries.op9_token_counts(spark, str(tmp_path)).collect()}
    got = {r["doc_id"]: r for r in entries.op2_length_buckets(spark, str(tmp_path)).collect()}
    assert {k: r["n_tokens"] for k, r in got.items()} == counted and min(counted[0], counted[1]) > 1000
    assert all(r["width"] >= max(counted[k], 1) for k, r in got.items())
