import datetime as dt

import pytest

from adlake.operators import checks, reports

D = dt.date(2024, 1, 1)
FACT = "ad_account_id string, ad_id string, stat_date date, spend double, impressions long, clicks long, leads long"


@pytest.fixture()
def fact(spark):
    return spark.createDataFrame(
        [("x", "a", D, 10.1, 100, 4, 0), ("x", "b", D, 0.2, 0, 0, 2), ("x", "c", D, None, None, None, None)], FACT)


def test_slices_are_not_added_up(fact):
    stacked = reports.stack_breakdowns({
        "GENDER": (fact.withColumnRenamed("ad_id", "gender"), "gender"),
        "AGE_BUCKET": (fact.withColumnRenamed("ad_id", "age"), "age")})
    with pytest.raises(reports.DoubleCounting):
        reports.totals(stacked, ["ad_account_id"], ["spend"])
    rows = reports.totals(stacked, ["breakdown_type"], ["spend", "clicks"]).collect()
    assert {tuple(r) for r in rows} == {("GENDER", 10.3, 4), ("AGE_BUCKET", 10.3, 4)}


def test_ratios_are_not_summed(fact):
    with pytest.raises(ValueError, match="ctr is a ratio"):
        reports.totals(fact, ["ad_id"], ["ctr"])


def test_rollup_recomputes_ratios(fact):
    (row,) = reports.rollup(fact, ["ad_account_id"]).collect()
    assert (row["spend"], row["impressions"], row["clicks"], row["leads"]) == (10.3, 100, 4, 2)
    assert (row["ecpc"], row["cpm"], row["ctr"], row["cost_per_lead"]) == (
        10.3 / 4, 10.3 / 100 * 1000, 0.04, 5.15)
    by_ad = {r["ad_id"]: r for r in reports.rollup(fact, ["ad_id"]).collect()}
    assert by_ad["a"]["cost_per_lead"] is None and by_ad["b"]["cpm"] is None


def test_reconcile(spark, fact):
    parts = spark.createDataFrame([("x", "a", D, 4.0, 60, 1, 0), ("x", "a", D, 6.0, 30, 1, 0)], FACT)
    rows = reports.reconcile(fact, parts, ["ad_account_id", "ad_id", "stat_date"], ["spend", "impressions"])
    got = {r["ad_id"]: (r["spend_rest"], r["impressions_rest"], r["side"]) for r in rows.collect()}
    whole = {r["ad_id"]: (r["spend"] or 0.0, r["impressions"] or 0, "whole") for r in fact.collect()}
    assert got == {"a": (0.1, 10, "both"), "b": whole["b"], "c": whole["c"]}


def test_reconcile_keeps_both_sides(spark):
    whole = spark.createDataFrame([("a", 10), ("b", 5), (None, 2)], "k string, clicks int")
    parts = spark.createDataFrame([("a", 4), ("c", 7), (None, 2)], "k string, clicks int")
    rows = reports.reconcile(whole, parts, ["k"], ["clicks"]).collect()
    assert {(r["k"], r["clicks"], r["clicks_parts"], r["clicks_rest"], r["side"]) for r in rows} == {
        ("a", 10, 4, 6, "both"), ("b", 5, 0, 5, "whole"), ("c", 0, 7, -7, "parts"), (None, 2, 2, 0, "both")}


def test_money_of_any_size(spark):
    rows = spark.createDataFrame([("a", 1e-7)] * 10 + [("b", 2e12)], "k string, spend double")
    assert {tuple(r) for r in reports.totals(rows, ["k"], ["spend"]).collect()} == {("a", 1e-6), ("b", 2e12)}


def test_run_counts_without_expand(spark, fact):
    rows = reports.run_counts(fact, "ad_id")
    assert "Expand" not in rows._jdf.queryExecution().executedPlan().toString()
    assert sum(r["n_rows"] for r in rows.collect()) == fact.count()


def test_names(spark):
    fact = spark.createDataFrame([("500", 1), ("999", 2)], "dma_code string, n int")
    reference = spark.createDataFrame([("500", "Portland")], "dma_code string, dma_name string")
    rows = reports.with_market_names(fact, reference).collect()
    assert {(r["dma_code"], r["dma_name"]) for r in rows} == {("500", "Portland"), ("999", None)}


def test_crosswalk(spark):
    left = spark.createDataFrame([("1", 5), ("2", 7), ("9", 1)], "dma_code string, clicks int")
    right = spark.createDataFrame([("A", 3), ("B", 4)], "other_code string, clicks int")
    walk = spark.createDataFrame([("1", "A", "m"), ("2", "B", "n"), ("2", "C", "n")],
                                 "dma_code string, other_code string, market string")
    problems = reports.crosswalk_problems(left, walk, "dma_code").collect()
    assert {tuple(r) for r in problems} == {("9", "unmapped"), ("2", "ambiguous")}
    rows = reports.by_common_market(left, right, walk, ["clicks"]).collect()
    assert {tuple(r) for r in rows} == {("m", 5, 3), ("n", 7, 4), ("unmapped", 1, None)}
    twice = walk.unionByName(spark.createDataFrame([("1", "A", "other")], walk.schema))
    with pytest.raises(Exception, match="two markets"):
        reports.by_common_market(left, right, twice, ["clicks"]).collect()


def test_duplicates_and_latest(spark):
    rows = spark.createDataFrame([("a", 1, 5), ("a", 3, 6), ("a", 3, 7), ("b", 1, 1), (None, 1, 1), (None, 1, 1)],
                                 "k string, pull int, v int")
    assert [tuple(r) for r in checks.duplicate_keys(rows, ["k"]).collect()] == [("a", 3)]
    latest = checks.latest_per_key(rows, ["k"], "pull").collect()
    assert {tuple(r) for r in latest} == {("a", 3, 7), ("b", 1, 1), (None, 1, 1)}
