"""What reports, reconciliations and first loads must not deal out again."""

import datetime as dt

from pyspark.sql import functions as F

from adlake import specs
from adlake.operators import reports, tables
from adlake.operators.tables import Target
from adlake.plans import pulls
from test_large_input import many_days  # noqa: F401
from test_physical import executed
from workload import responses as R


def _exchanges(df):
    return [line for line in executed(df).splitlines() if "Exchange hashpartitioning" in line]


def test_a_report_moves_line_items_once_for_sums_and_bodies(spark, many_days):  # noqa: F811
    # the joins may need exchanges of their own, but sums and bodies share one
    for frame in (R.ad_report(spark, many_days), R.campaign_report(spark, many_days), R.ad_group_report(spark, many_days),
                  R.ad_breakdown(spark, many_days, "gender", "GENDER"), R.ad_breakdown(spark, many_days, "dma_code", "LOCATION")):
        plan = executed(frame)
        assert "stat_date" not in "".join(_exchanges(frame)) and plan.count("REPARTITION_BY_COL") == 1
        assert "collect_list" not in plan.split("REPARTITION_BY_COL")[1]


def test_reconciled_sums_move_once(spark):
    day = F.when(F.col("id") > 2, F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("id").cast("int")))
    name = F.when(F.col("id") > 1, F.col("id").cast("string"))
    whole = spark.range(20).select(name.alias("k"), day.alias("d"), F.col("id").alias("clicks"))
    parts = spark.range(30).select(name.alias("k"), day.alias("d"), F.col("id").alias("clicks"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert len(_exchanges(reports.reconcile(whole, parts, ["k", "d"], ["clicks"]))) == 2  # each side once
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_reconcile_of_null_and_repeated_keys(spark):
    schema = "k string, n bigint, day date, clicks bigint"
    one, zero = dt.date(2024, 1, 1), dt.date(1970, 1, 1)
    whole = spark.createDataFrame([(None, 1, one, 5), ("", 1, one, 6), ("", 1, one, 7), ("x", None, None, 8), ("w", 0, zero, 9)], schema)
    parts = spark.createDataFrame([(None, 1, one, 1), (None, 1, one, 2), ("", 1, one, 4), ("x", None, None, 8), ("x", 0, zero, 3)], schema)
    got = reports.reconcile(whole, parts, ["k", "n", "day"], ["clicks"])
    assert got.columns == ["k", "n", "day", "clicks", "clicks_parts", "side", "clicks_rest"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted([
        (None, 1, one, 5, 3, "both", 2), ("", 1, one, 6, 4, "both", 2), ("", 1, one, 7, 4, "both", 3), ("x", None, None, 8, 8, "both", 0),
        ("w", 0, zero, 9, 0, "whole", 9), ("x", 0, zero, 0, 3, "parts", -3)], key=str)
    other = parts.withColumn("n", F.col("n").cast("double"))  # types that differ are compared as before
    assert reports.reconcile(whole, other, ["k", "n", "day"], ["clicks"]).where("side = 'both'").count() == 4


def test_a_first_load_is_not_compared_with_an_empty_table(spark, tmp_path):
    row = {f.name: F.lit(None).cast(f.data_type) for f in specs.AD_FACT.fields}
    row |= {"ad_account_id": F.lit("a"), "ad_id": F.col("id").cast("string"), "stat_date": F.lit(dt.date(2024, 1, 1))}
    rows = spark.range(10).select(*(c.alias(n) for n, c in row.items()))
    target, days = Target(path=str(tmp_path / "t")), [dt.date(2024, 1, 1)]
    assert "Join" not in executed(tables.merged_days(target.read(spark, specs.AD_FACT), rows, specs.AD_FACT, days, 10, "ingested_at"))
    tables.upsert(rows, target, specs.AD_FACT)
    assert "Join" in executed(tables.merged_days(target.read(spark, specs.AD_FACT), rows, specs.AD_FACT, days, 10, "ingested_at"))


def test_wide_rows_are_cast_outside_the_stage_s_one_method(spark, tmp_path):
    body = '[{"AD_ID": "a", "DATE": "2024-01-01", "SPEND_IN_DOLLAR": 1}]'
    landed = spark.createDataFrame([("acct", None, body)], "ad_account_id string, start_date string, body string")
    landed.write.parquet(str(tmp_path / "landed"))
    rows = pulls.fact_rows(spark.read.parquet(str(tmp_path / "landed")), specs.AD_FACT, dt.datetime(2024, 1, 2, tzinfo=dt.timezone.utc))
    casts = [line for line in executed(rows).splitlines() if "ad_performance.leads unreadable" in line]
    assert casts and not any("*(" in line for line in casts)  # *(n) marks what whole-stage code holds
    assert rows.select("ad_account_id", "ad_id", "spend").collect() == [("acct", "a", 1.0)]


def test_a_spec_of_few_columns():
    few = specs.AD_MARKET_FACT.only("ad_id", "spend")
    assert few.columns == ["ad_id", "stat_date", "spend"] and few.targeting_type == "LOCATION"
    assert few.payload_schema.names == ["AD_ID", "DATE", "SPEND_IN_DOLLAR"]
