"""All problems of a run at once, in one pass and before its target changes; sidings of a stream."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from adlake import specs
from adlake.functions import values, variants
from adlake.operators import reports, tables
from adlake.operators.checks import BadRows, Problems
from adlake.operators.tables import Target
from adlake.plans import pulls
from adlake.streaming.revisions import LANDED_SCHEMA, Sidings, divert_batch, stream_revisions
from test_plans import RUN, TS, Api, source

SPEC = specs.AD_FACT
GOOD = {"AD_ID": "a", "DATE": "2024-01-10", "SPEND_IN_DOLLAR": 1.5, "LEADS": 2}
BAD = [{**GOOD, "AD_ID": None}, {**GOOD, "AD_ID": "b", "LEADS": "many"}, {**GOOD, "AD_ID": "c", "LEADS": "few", "DATE": "soon"},
       {**GOOD, "AD_ID": "d", "SPEND_IN_DOLLAR": "NaN"}, {**GOOD, "AD_ID": "e", "SPEND_IN_DOLLAR": "Infinity"}]
FOUND = [("unreadable response", 2, "<html>"), ("ad_id missing", 1, None), ("stat_date unreadable", 1, "soon"),
         ("spend unreadable", 2, "Infinity"), ("leads unreadable", 2, "few")]


def landed(spark, *bodies):
    return spark.createDataFrame([("acct", "2024-01-06", n, b) for n, b in enumerate(bodies)], LANDED_SCHEMA)


def test_a_refused_run_tells_everything(spark, tmp_path):
    target = Target(path=str(tmp_path / "t"))
    good = landed(spark, json.dumps([GOOD]))
    problems = Problems(SPEC)
    assert tables.upsert(pulls.watched_fact_rows(good, SPEC, TS, problems), target, SPEC, accept=problems.refuse).rows == 1
    assert problems.found() == []
    problems = Problems(SPEC)
    rows = pulls.watched_fact_rows(landed(spark, json.dumps([GOOD, *BAD]), "<html>", "{}x"), SPEC, TS, problems)
    with pytest.raises(BadRows) as refused:
        tables.upsert(rows.withColumn("spend", F.lit(9.0)), target, SPEC, accept=problems.refuse)
    assert sorted(refused.value.problems) == sorted(FOUND) and "leads unreadable: 2 (e.g. 'few')" in str(refused.value)
    assert [r["spend"] for r in target.read(spark, SPEC).collect()] == [1.5]


def test_a_refused_replace_leaves_nothing(spark, tmp_path):
    target = Target(path=str(tmp_path / "t"))
    pages = spark.createDataFrame([("1", '{"items":[{"id":"a","created_time":"later"},{"name":"x"}]}')], "ad_account_id string, body string")
    problems = Problems(specs.CAMPAIGN_DIM)
    rows = pulls.watched_dimension_rows(pages, specs.CAMPAIGN_DIM, TS, problems)
    with pytest.raises(BadRows, match="campaign_id missing: 1; created_time unreadable: 1"):
        tables.replace_all([(rows, target, specs.CAMPAIGN_DIM)], accept=problems.refuse)
    assert list(tmp_path.iterdir()) == []


def test_one_read_of_the_responses(spark, tmp_path):
    """The account is kept in the pass that stages the rows."""
    landed(spark, json.dumps([GOOD])).write.parquet(str(tmp_path / "landed"))
    responses = spark.read.parquet(str(tmp_path / "landed"))
    plan = pulls.watched_fact_rows(responses, SPEC, TS, Problems(SPEC))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("CollectMetrics") == 2 and "Exchange" not in plan


def test_a_pull_reports_all(spark, tmp_path):
    class Broken(Api):
        def __call__(self, request):
            status, headers, body = super().__call__(request)
            return status, headers, body.replace('"SPEND_IN_DOLLAR": 1', '"SPEND_IN_DOLLAR": "?"')

    target = Target(path=str(tmp_path / "t"))
    broken = pulls.Source(Broken(ads=3), policy=source().policy)
    with pytest.raises(BadRows, match="spend unreadable: 4"):
        pulls.pull_fact(spark, SPEC, broken, target, run_date=RUN, run_ts=TS)
    assert target.read(spark, SPEC).count() == 0


def test_money_that_is_none_fails(spark):
    texts = spark.createDataFrame([("NaN",), ("Infinity",), ("-Infinity",), ("1e3",), (None,)], "t string")
    assert [r[0] for r in texts.select(values.to_double(F.col("t"))).collect()] == [None, None, None, 1000.0, None]
    rows = spark.createDataFrame([("a", 1.0), ("a", float("nan"))], "k string, spend double")
    with pytest.raises(PySparkException, match="not an amount: NaN"):
        reports.totals(rows, ["k"], ["spend"]).collect()
    assert reports.totals(rows.where("not isnan(spend)"), ["k"], ["spend"]).first()["spend"] == 1.0


# --- sidings -------------------------------------------------------------------------


def run(spark, folder, target, sidings):
    stream_revisions(spark, folder, target, SPEC, checkpoint=f"{folder}-check", run_date=RUN, run_ts=TS, sidings=sidings,
                     max_files=1).awaitTermination()


def test_bad_values_do_not_stop_the_stream(spark, tmp_path):
    folder, target, sidings = str(tmp_path / "landing"), Target(path=str(tmp_path / "t")), Sidings(str(tmp_path / "side"))
    assert sidings.ledger(spark).count() == 0
    late = {**GOOD, "DATE": "2023-12-01"}
    landed(spark, json.dumps([GOOD, *BAD, late]), "<html>").coalesce(1).write.mode("append").parquet(folder)
    run(spark, folder, target, sidings)
    landed(spark, json.dumps([{**GOOD, "AD_ID": "z"}])).coalesce(1).write.mode("append").parquet(folder)
    run(spark, folder, target, sidings)
    assert sorted(r["ad_id"] for r in target.read(spark, SPEC).collect()) == ["a", "z"]
    assert sorted(map(tuple, sidings.ledger(spark).select("batch_id", "rows", "late", "bad", "unreadable").collect())) \
        == [(0, 1, 1, 5, 1), (1, 1, 0, 0, 0)]
    bad = sidings.bad_rows(spark, SPEC).select("ad_id", "problems", "raw.LEADS", "batch_id").collect()
    assert ("c", "stat_date unreadable, leads unreadable", "few", 0) in [tuple(r) for r in bad] and len(bad) == 5
    assert [r["body"] for r in sidings.unreadable(spark).collect()] == ["<html>"]


def test_a_replayed_batch_counts_once(spark, tmp_path):
    target, sidings = Target(path=str(tmp_path / "t")), Sidings(str(tmp_path / "side"))
    batch = landed(spark, json.dumps([GOOD, *BAD]), "no")
    for _ in range(2):
        divert_batch(batch, 4, target, SPEC, sidings, first_day="2024-01-01", run_ts=TS)
    (entry,) = sidings.ledger(spark).collect()
    assert (entry["batch_id"], entry["rows"], entry["bad"], entry["unreadable"]) == (4, 1, 5, 1)
    assert sidings.bad_rows(spark, SPEC).count() == 5 and sidings.unreadable(spark).count() == 1


# --- variants ------------------------------------------------------------------------


def test_elements_and_shapes(spark):
    rows = [("1", '[{"b":1,"a":"x"},{"b":"no"}]', '{"z":1}'), ("2", "[]", '{"y":[1,2]}'), ("3", None, "not json"), ("4", '{"b":2}', '{"z":2.5}')]
    table = spark.createDataFrame(rows, "id string, l string, o string")
    got = variants.element_rows(table, "l", ["id"], {"b": ("$.b", "bigint"), "a": ("$.a", "string")}).collect()
    assert sorted(map(tuple, got), key=str) == [("1", 0, 1, "x"), ("1", 1, None, None)]
    shapes = {r["column"]: (r["shape"], r["n"]) for r in variants.shapes(table.where("id < 3"), ["l", "o"]).collect()}
    assert shapes["o"] == ("OBJECT<y: ARRAY<BIGINT>, z: BIGINT>", 2)
    changed = variants.changed_shapes(table.where("id < 3"), table.where("id != 2"), ["l", "o"]).collect()
    assert {r["column"] for r in changed} == {"l", "o"}
    assert variants.changed_shapes(table, table, ["l", "o"]).count() == 0
    assert sorted(map(tuple, variants.object_keys(table, "o").collect())) == [("y", 1), ("z", 2)]
    assert [tuple(r) for r in variants.shapes(table.limit(0), ["l"]).collect()] == [("l", None, 0)]
