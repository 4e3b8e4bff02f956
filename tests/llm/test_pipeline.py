"""The stages of the pipeline, each on what the one before kept, and the queries of the subpackage against their SQL."""

import corpus_pipeline
import pytest
from compare import compare, database, entry_module
from fixtures import documents, shingle_set, texts

from tagloom.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.SQL))
def test_query_equals_sql(spark, name):
    assert compare(spark, database(SF), name, SF) is None


def test_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry_module.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_stages(spark, tmp_path):
    docs, sizes = documents(spark), []
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, "")
        out.write.parquet(f"{tmp_path}/{k}")
        out = spark.read.parquet(f"{tmp_path}/{k}")
        if name != "packing":
            assert out.columns == columns
            sizes.append(out.count())
        if name == "language_id":
            ids = {r["doc_id"] for r in out.collect()}
            assert not ids & {100, 101, 102, 103} and set(range(60)) <= ids
        if name == "ngram_jaccard":
            sets = [(r["doc_id"], shingle_set(r["text"])) for r in out.collect()]
            for i, (a, x) in enumerate(sets):
                for b, y in sets[:i]:
                    assert not x or 100 * len(x & y) < 75 * len(x | y), (a, b)
        if name == "mixing":
            before, after = docs.collect(), out.collect()
            assert sorted(map(str, before)) == sorted(map(str, after))
        if name == "packing":
            assert {r["doc_id"] for r in out.collect()} == {r["doc_id"] for r in docs.collect()}
        docs = out
    assert sizes[0] >= sizes[1] >= sizes[2] == sizes[3] and sizes[0] < len(texts())


def test_stages_on_nothing(spark):
    docs = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "").count() == 0
