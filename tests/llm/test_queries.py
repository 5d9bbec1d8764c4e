"""Registered corpus queries against their SQL, and the pipeline stage by stage."""

import pytest
from compare import connect, difference

import __spark_entry__ as driver
import corpus_pipeline
from rowgate.llm.queries import corpus_queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(set(corpus_queries()) & set(driver.oracle_sql())))
def test_query_gives_the_rows_of_its_sql(spark, name):
    df = driver.queries()[name](spark, SF)
    assert difference(connect(SF), driver.oracle_sql()[name], df.collect(), df.columns) is None


def test_every_operator_is_registered():
    names = {name.split("_")[0] for name in driver.queries()}
    assert {"pipeline", *(f"op{n}" for n in range(1, 14))} <= names


def test_pipeline_is_its_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[1] == counts[2] and counts[-1] > counts[0] // 2
    packed = corpus_pipeline.run(spark, SF)
    assert packed.select("doc_id").distinct().count() == counts[-1]
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
