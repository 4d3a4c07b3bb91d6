"""The pipeline and the registered queries on small tables."""

import corpus_pipeline
from tablewright.llm import queries
from tests.compare import compare, connect


def test_stages_keep_the_columns_of_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    names, left = docs.columns, docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, small).cache()
        assert docs.columns == names and 0 < docs.count() <= left
        left = docs.count()
    done = corpus_pipeline.run(spark, small)
    assert {r["doc_id"] for r in done.collect()} == {r["doc_id"] for r in docs.collect()}


def test_stages_on_awkward_rows(spark, small):
    data = [(1, None), (2, ""), (3, "Hello big wide world of words"), (4, "hello BIG wide world of words"), (None, "Other text altogether here")]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in data], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    known = spark.read.parquet(f"{small}/documents.parquet").select(docs.columns)
    docs = docs.union(known.filter("doc_id >= 100"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, small).cache()
    ids = {r["doc_id"] for r in docs.collect()}
    assert {None, 3} <= ids and not ids & {1, 2, 4}


def test_every_query_has_rows(spark, small):
    con = connect(small)
    for name, make in queries.QUERIES.items():
        assert compare(spark, con, small, name, make, queries.ORACLES.get(name)) == "", name
