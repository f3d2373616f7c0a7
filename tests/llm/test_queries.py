"""The named queries against their twins, and the pipeline's stages."""

import pytest
from compare import difference, duck

import corpus_pipeline
from sensorflow.llm import queries, twins


@pytest.mark.parametrize("name", sorted(twins.oracle_sql()))
def test_same_rows(name, spark, sf_dir):
    ours = queries.queries()[name](spark, sf_dir).toPandas()
    assert difference(ours, duck(sf_dir).execute(twins.oracle_sql()[name]).df()) == ""


def test_pipeline_keeps_the_columns_and_the_clean_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, sf_dir)
        assert after.schema.names == docs.schema.names
        assert {r.doc_id for r in after.select("doc_id").collect()} <= {r.doc_id for r in before.select("doc_id").collect()}
        before = after.cache()
    assert corpus_pipeline.run(spark, sf_dir).count() == before.count()


@pytest.mark.parametrize("name", ["op5_quality_rules", "op9_line_dedup"])
def test_native_queries_have_no_python(name, spark, sf_dir):
    text = queries.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in text for word in ("Python", "Pandas", "MapInArrow"))
