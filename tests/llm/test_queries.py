"""Every registered query on the smallest tables; SQL twins; the pipeline against a plain version of its filters."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from orderlake.llm import queries as Q
from orderlake.llm.common import table

SF = "/root/testdata/sf0.001"
TABLES = "documents pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_sql_twin(spark, con, name):
    want = con.sql(Q.ORACLE[name])
    got = Q.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    cols = want.columns
    assert sorted(map(str, (tuple(r) for r in got.select(*cols).collect()))) == sorted(map(str, want.fetchall()))


def test_one_row_per_document(spark):
    n = table(spark, SF, "documents").count()
    for name in ("op4_vector_shards", "op7_jaccard_join", "op10_toxic_segments"):
        assert Q.QUERIES[name](spark, SF).count() == n


def test_pipeline_stages(spark):
    from orderlake.llm import decontaminate, exact_dedup, jaccard_join, toxicity

    docs = table(spark, SF, "documents").cache()
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        out = spark.createDataFrame(out.collect(), docs.schema)
        kept.append({r[0] for r in out.select("doc_id").collect()})
        if len(kept) == 1:
            model = toxicity.train(docs, table(spark, SF, "labels"))
            assert kept[0] == {r[0] for r in toxicity.score(docs, model).where("predicted = 0").select("doc_id").collect()}
        elif len(kept) == 2:
            assert kept[1] == {r[0] for r in exact_dedup.content_sort(docs).where("kept").select("doc_id").collect()}
        elif len(kept) == 3:
            assert kept[2] == {r[0] for r in jaccard_join.jaccard_components(docs).where("doc_id = component_id").select("doc_id").collect()}
        else:
            assert kept[2] - kept[3] == {r[0] for r in decontaminate.contaminated(docs, table(spark, SF, "benchmark")).select("doc_id").collect()}
        docs = out
    assert kept[0] >= kept[1] >= kept[2] >= kept[3]
    pieces = corpus_pipeline.run(spark, SF)
    assert {r[0] for r in pieces.select("doc_id").distinct().collect()} == kept[3]
    assert pieces.agg(F.sum("length")).first()[0] == pieces.select("doc_id", "doc_tokens").distinct().agg(F.sum("doc_tokens")).first()[0]
