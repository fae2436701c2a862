"""What the physical plans must and must not contain."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from adlake import specs
from adlake.functions.dates import in_window
from adlake.operators import batching, checks, reports, tables
from adlake.operators.tables import Target
from adlake.plans import pulls
from adlake.session import shared_dir
from test_landed import responses

TS = dt.datetime(2024, 1, 2, tzinfo=dt.timezone.utc)


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def landed_report(spark, tmp_path):
    body = json.dumps([{"AD_ID": f"a{i}", "DATE": f"2024-01-{d:02}", "SPEND_IN_DOLLAR": 1}
                       for i in range(3) for d in range(1, 10)])
    responses(spark, body).write.parquet(str(tmp_path / "landed"))
    return spark.read.parquet(str(tmp_path / "landed"))


def test_flatten_parses_once_without_python_or_shuffle(landed_report):
    plan = executed(pulls.fact_rows(landed_report, specs.AD_FACT, TS))
    for word in ("Exchange", "Python", "Arrow"):
        assert word not in plan
    # one parse of the body; the second one stands behind the check for null dates
    assert plan.count("from_json(ArrayType(ArrayType(StructType") == 1
    assert plan.count("from_json(ArrayType(MapType") == 1


def test_unused_metrics_are_not_cast(landed_report):
    plan = executed(pulls.fact_rows(landed_report, specs.AD_FACT, TS).select("ad_id", "spend"))
    assert "ad_performance.spend unreadable" in plan and "ad_performance.leads unreadable" not in plan


def test_window_prunes_partitions(spark, landed_report, tmp_path):
    target = Target(path=str(tmp_path / "t"))
    tables.upsert(pulls.fact_rows(landed_report, specs.AD_FACT, TS), target, specs.AD_FACT)
    rows = target.read(spark, specs.AD_FACT)
    window = rows.filter(in_window(F.col("stat_date"), "2024-01-03", "2024-01-04")).select("ad_id", "spend")
    scan = next(line for line in executed(window).splitlines() if "FileScan" in line)
    assert "stat_date" in scan.split("PartitionFilters: [")[1].split("]")[0]
    assert "ReadSchema: struct<ad_id:string,spend:double>" in scan
    assert window.count() == 6

    staged = pulls.fact_rows(landed_report, specs.AD_FACT, TS).filter("ad_id = 'a1'")
    days = [dt.date(2024, 1, 3)]
    for many in (days, [None, *days], [dt.date(2010, 1, 1) + dt.timedelta(n) for n in range(5000)] + days):
        merged = tables.merged_days(rows, staged, specs.AD_FACT, many, 1)
        filters = executed(merged).split("PartitionFilters: [")[1]
        assert "stat_date" in filters.split("]")[0]


def test_latest_is_ranked_before_the_shuffle(spark):
    rows = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("pull"), F.lit(1).alias("v"))
    plan = executed(checks.latest_per_key(rows, ["k"], "pull"))
    assert plan.count("WindowGroupLimit") == 2


def test_no_cross_joins_and_no_hinted_broadcasts(spark, landed_report):
    rows = pulls.fact_rows(landed_report, specs.AD_FACT, TS)
    keys = ["ad_account_id", "ad_id", "stat_date"]
    plan = executed(reports.reconcile(rows, rows, keys, ["clicks"]))
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_batching_windows_stay_small(spark):
    """No window ranges over all ids of an account."""
    ids = spark.range(500).select(
        F.lit("hot").alias("ad_account_id"), F.floor(F.col("id") / 5).alias("page_no"),
        (F.col("id") % 5).cast("int").alias("item_pos"), F.col("id").cast("string").alias("id"))
    frame = batching.request_batches(ids, "id", 100, block_pages=10)
    windows = [line for line in executed(frame).splitlines() if "Window [" in line]
    assert len(windows) == 2 and all("_block" in line for line in windows)
    assert [r["n_ids"] for r in frame.collect()] == [100] * 5


def test_writes_go_to_the_folder_the_cluster_names(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
