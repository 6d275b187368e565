import pytest

import corpus_pipeline
from compare import difference, oracle_connection
from hushline.llm import entries


@pytest.mark.parametrize("name", sorted(entries.oracle_sql()))
def test_query_equals_sql(spark, sf_dir, name):
    assert difference(entries.queries()[name](spark, sf_dir), oracle_connection(sf_dir), entries.oracle_sql()[name]) is None


def test_a_query_for_each_operator():
    assert sorted(int(n.split("_")[0][2:]) for n in entries.queries()) == list(range(1, 14))


def test_pipeline_catches_planted_cases(spark, prose, tmp_path):
    passage = prose(900, 60)
    clean = [(i, prose(i, 80, 5000)) for i in range(30)]
    planted = [(100, clean[0][1]), (101, clean[1][1].replace(" ", "  ")), (102, " ".join(clean[2][1].split()[:-2] + ["new", "end"]))]
    shared = [(200 + i, f"{prose(950 + i, 60, 5000)} {passage}") for i in range(4)]
    junk = [(300, "### $$$ *** " * 30), (301, "too short"), (302, None), (303, "same five words come again " * 20)]
    rows = [(k, t, "en", None if k % 2 else "src", k) for k, t in clean + planted + shared + junk]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    texts = {}
    current = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, current, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        current = spark.read.parquet(f"{tmp_path}/{k}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert current.columns == docs.columns
            texts[name] = {r["doc_id"]: r["text"] for r in current.collect()}
    assert texts["quality_rules"].keys() == {k for k, _ in clean + planted + shared}
    assert texts["near_copies"].keys() == {k for k, _ in clean + shared}
    passed = texts["repeated_passages"]
    assert all(passed[k] == t for k, t in clean)
    assert all(passed[k] == t.removesuffix(f" {passage}") for k, t in shared)
    final = current.collect()
    assert {r["doc_id"] for r in final} == {k for k, _ in clean + shared} and len(final) == 34
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 34


def test_stages_take_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "").collect() == []
