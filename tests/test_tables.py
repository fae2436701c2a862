import datetime as dt
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from adlake import specs
from adlake.operators import tables
from adlake.operators.checks import latest_per_key
from adlake.operators.tables import DuplicateKeys, Target
from adlake.session import discard, run_dir, shared_dir

SPEC = specs.AD_FACT
DIM = specs.CAMPAIGN_DIM
TS = dt.datetime(2024, 1, 2, tzinfo=dt.timezone.utc)


def facts(spark, rows):
    """(ad, day, spend, leads) as a full fact frame."""
    frame = spark.createDataFrame(rows, "ad_id string, day string, spend double, leads long")
    filled = frame.withColumn("stat_date", F.col("day").try_cast("date"))
    filled = filled.withColumn("ad_account_id", F.lit("acct")).withColumn("ingested_at", F.lit(TS))
    for field in SPEC.fields:
        if field.name not in filled.columns:
            filled = filled.withColumn(field.name, F.lit(None).cast(field.data_type))
    return filled.select(*SPEC.columns)


def content(target, spark):
    rows = target.read(spark, SPEC).select("ad_id", F.col("stat_date").cast("string"), "spend", "leads")
    return sorted((tuple(r) for r in rows.collect()), key=str)


@pytest.fixture(params=["path", "catalog"])
def target(request, tmp_path, spark):
    if request.param == "path":
        return Target(path=str(tmp_path / "t"))
    return Target(f"t_{os.urandom(6).hex()}", str(tmp_path / "t"))


OLD = [("a", "2024-01-01", 1.0, 1), ("b", "2024-01-01", 2.0, 2), ("a", "2024-01-02", 3.0, 3),
       ("a", "2024-01-09", 4.0, 4)]
NEW = [("a", "2024-01-01", 10.0, None), ("c", "2024-01-02", 30.0, 30)]
MERGED = [("a", "2024-01-01", 10.0, None), ("a", "2024-01-02", 3.0, 3), ("a", "2024-01-09", 4.0, 4),
          ("b", "2024-01-01", 2.0, 2), ("c", "2024-01-02", 30.0, 30)]


@pytest.mark.parametrize("durable", [True, False])
def test_upsert(spark, target, durable):
    tables.upsert(facts(spark, OLD), target, SPEC, durable=durable)
    before = {f for f in map(str, os.listdir(target.path)) if "2024-01-09" in f}
    report = tables.upsert(facts(spark, NEW), target, SPEC, durable=durable)
    assert (report.rows, report.days) == (2, 2)
    assert content(target, spark) == MERGED  # nulls overwrite, unmatched rows and days stay
    tables.upsert(facts(spark, NEW), target, SPEC, durable=durable)
    assert content(target, spark) == MERGED  # twice is once
    assert {f for f in map(str, os.listdir(target.path)) if "2024-01-09" in f} == before


def test_disjoint_windows_commute(spark, tmp_path):
    one, two = Target(path=str(tmp_path / "1")), Target(path=str(tmp_path / "2"))
    early, late = facts(spark, OLD[:2]), facts(spark, OLD[2:])
    for target, order in ((one, (early, late)), (two, (late, early))):
        for frame in order:
            tables.upsert(frame, target, SPEC)
    assert content(one, spark) == content(two, spark) == sorted(OLD, key=str)


def test_empty_source_leaves_the_table(spark, target):
    tables.upsert(facts(spark, OLD), target, SPEC)
    assert tables.upsert(facts(spark, OLD).filter("spend < 0"), target, SPEC).rows == 0
    assert content(target, spark) == sorted(OLD, key=str)


def test_null_keys_never_match(spark, target):
    rows = [(None, "2024-01-01", 1.0, 1), ("a", None, 2.0, 2), ("b", "2024-01-01", 3.0, 3)]
    tables.upsert(facts(spark, rows), target, SPEC)
    tables.upsert(facts(spark, rows), target, SPEC)
    assert len(content(target, spark)) == 5


def test_duplicate_source_keys(spark, target):
    tables.upsert(facts(spark, OLD), target, SPEC)
    twice = facts(spark, [("z", "2024-01-01", 1.0, 1), ("z", "2024-01-01", 2.0, 2)])
    with pytest.raises(DuplicateKeys, match="'ad_id': 'z'"):
        tables.upsert(twice, target, SPEC)
    assert content(target, spark) == sorted(OLD, key=str)
    tables.upsert(latest_per_key(twice, SPEC.key, "spend"), target, SPEC, check_duplicates=False)
    assert ("z", "2024-01-01", 2.0, 2) in content(target, spark)


def test_failing_source_leaves_the_table(spark, target):
    tables.upsert(facts(spark, OLD), target, SPEC)
    bad = facts(spark, NEW).withColumn("spend", F.when(F.col("ad_id") == "c", F.raise_error(F.lit("bad row")))
                                       .otherwise(F.col("spend")))
    with pytest.raises(PySparkException, match="bad row"):
        tables.upsert(bad, target, SPEC)
    assert content(target, spark) == sorted(OLD, key=str)


def test_a_cut_off_publish_can_be_finished(spark, target):
    tables.upsert(facts(spark, OLD), target, SPEC)
    staging = run_dir(spark, "staging")
    tables.upsert(facts(spark, NEW), target, SPEC, staging=staging)
    lost = facts(spark, [("a", "2024-01-01", 0.0, 0)])  # as if one day had lost its rows
    tables.publish(spark, lost, target, SPEC)
    assert content(target, spark) != MERGED
    tables.publish_staged(spark, staging, target, SPEC)
    assert content(target, spark) == MERGED


def test_incomplete_staging_is_not_published(spark, target):
    tables.upsert(facts(spark, OLD), target, SPEC)
    staging = run_dir(spark, "staging")
    facts(spark, NEW).write.partitionBy("stat_date").parquet(f"{staging}/merged")
    os.remove(f"{staging}/merged/_SUCCESS")
    with pytest.raises(ValueError, match="cut off"):
        tables.publish_staged(spark, staging, target, SPEC)
    assert content(target, spark) == sorted(OLD, key=str)


def test_staging_is_removed_after_success(spark, target):
    tables.upsert(facts(spark, OLD), target, SPEC)
    left = os.listdir(f"{shared_dir(spark)}/adlake")
    tables.upsert(facts(spark, NEW), target, SPEC)
    assert sorted(os.listdir(f"{shared_dir(spark)}/adlake")) == sorted(left)
    with pytest.raises(ValueError, match="not a run folder"):
        discard(spark, "/tmp/elsewhere")


def test_overwrite_mode_is_restored(spark):
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    target = Target(f"t_{os.urandom(6).hex()}")
    tables.upsert(facts(spark, OLD), target, SPEC)
    assert spark.conf.get(key) == before


def test_hot_day_is_split(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "ROWS_PER_TASK", 100)
    rows = [(f"ad{i}", "2024-01-01", float(i), i) for i in range(1000)] + OLD[2:]
    target = Target(path=str(tmp_path / "t"))
    tables.upsert(facts(spark, rows), target, SPEC, durable=False)
    files = [f for f in os.listdir(tmp_path / "t" / "stat_date=2024-01-01") if f.endswith(".parquet")]
    assert len(files) >= 10 and len(content(target, spark)) == 1002


# --- replace -------------------------------------------------------------------------


def campaigns(spark, rows):
    frame = spark.createDataFrame(rows, "ad_account_id string, campaign_id string, name string")
    return frame.withColumn("ingested_at", F.lit(TS)).select(
        *(F.col(f.name) if f.name in {*frame.columns, "ingested_at"}
          else F.lit(None).cast(f.data_type).alias(f.name) for f in DIM.fields))


def names(target, spark):
    rows = target.read(spark, DIM).select("ad_account_id", "campaign_id", "name").collect()
    return sorted(map(tuple, rows))


@pytest.fixture(params=["path", "catalog"])
def dim(request, tmp_path):
    return Target(path=str(tmp_path / "d")) if request.param == "path" else Target(f"d_{os.urandom(6).hex()}")


C1 = [("1", "a", "A"), ("1", "b", "B"), ("2", "c", "C")]
C2 = [("1", "a", "A2")]


def test_replace(spark, dim):
    tables.replace(campaigns(spark, C1), dim, DIM)
    assert names(dim, spark) == C1
    assert tables.replace(campaigns(spark, C2), dim, DIM).rows == 1
    assert names(dim, spark) == C2
    assert tables.replace(campaigns(spark, C2).filter("false"), dim, DIM).rows == 0
    assert names(dim, spark) == C2
    tables.replace(campaigns(spark, C1), dim, DIM)
    assert names(dim, spark) == C1


def test_scoped_replace(spark, dim):
    tables.replace(campaigns(spark, C1), dim, DIM)
    scope = spark.createDataFrame([("1",)], "ad_account_id string")
    tables.replace(campaigns(spark, C2), dim, DIM, scope)
    assert names(dim, spark) == [("1", "a", "A2"), ("2", "c", "C")]


def test_replace_may_read_its_own_table(spark, dim):
    tables.replace(campaigns(spark, C1), dim, DIM)
    tables.replace(dim.read(spark, DIM).filter("ad_account_id = '1'"), dim, DIM)
    assert names(dim, spark) == C1[:2]


def test_no_table_changes_before_all_are_staged(spark, tmp_path):
    one, two = Target(path=str(tmp_path / "1")), Target(f"d_{os.urandom(6).hex()}")
    for target in (one, two):
        tables.replace(campaigns(spark, C1), target, DIM)
    bad = campaigns(spark, C2).withColumn("name", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(PySparkException, match="broken"):
        tables.replace_all([(campaigns(spark, C2), one, DIM), (bad, two, DIM)])
    assert names(one, spark) == names(two, spark) == C1
    written = tables.replace_all([(campaigns(spark, C2), one, DIM), (campaigns(spark, C2), two, DIM)])
    assert [w.rows for w in written] == [1, 1] and names(one, spark) == names(two, spark) == C2


def test_names_and_confs():
    assert tables.table_name("lake", "ads", "ad_dim") == "lake.ads.ad_dim"
    confs = tables.catalog_confs("lake", "some.Catalog", "s3://w", catalog_impl="x", io_impl="y")
    assert confs == {
        "spark.sql.catalog.lake": "some.Catalog", "spark.sql.catalog.lake.warehouse": "s3://w",
        "spark.sql.catalog.lake.catalog-impl": "x", "spark.sql.catalog.lake.io-impl": "y"}


def test_back_end_choice(spark, target):
    assert not target.is_native(spark)
    tables.create_if_missing(spark, target, SPEC)
    assert not target.is_native(spark)
    assert Target("lake.ads.t").is_native(spark)
