"""The pipeline's stages, and run() against a plain version of each step."""

import os

import pytest

import __spark_entry__ as entry
import compare
import corpus_pipeline
from adlake.llm import pii, queries
from llm.test_pairs import brute_components

SF = os.environ.get("ADLAKE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_stages_keep_the_columns(spark, odd, empty):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, SF).columns == odd.columns, name
        assert stage(spark, empty, SF).count() == 0, name
    kept = corpus_pipeline.one_of_each_group(spark, odd, SF)
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 6, 7, 8]


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    kept = corpus_pipeline.one_of_each_group(spark, docs, SF)
    assert {r["doc_id"] for r in kept.collect()} == {root for _, _, root in brute_components(rows)}
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    free = {r["doc_id"] for r in corpus_pipeline.no_benchmark(spark, docs, SF).collect()}
    assert free == {i for i, t in rows if not any(x in (t or "") for x in items)}
    masked = corpus_pipeline.no_personal_data(spark, docs, SF).collect()
    assert not any(pii.pattern_spans(r["text"] or "") for r in masked)


def test_the_last_stage_packs_what_is_left(spark):
    got = corpus_pipeline.run(spark, SF)
    assert 0 < got.select("doc_id").distinct().count() < spark.read.parquet(f"{SF}/documents.parquet").count()


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query(spark, name):
    assert compare.difference(entry.queries()[name](spark, SF), compare.duck(SF), entry.oracle_sql()[name]) == ""
