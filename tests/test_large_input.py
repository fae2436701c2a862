"""Input larger than the test tables: long keys, long bodies."""

import datetime as dt
import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from adlake import specs
from adlake.plans import pulls
from adlake.streaming.revisions import stream_revisions
from workload import queries, responses

TS = dt.datetime(2024, 1, 20, tzinfo=dt.timezone.utc)


@pytest.fixture()
def many_suppliers(spark, tmp_path):
    keys = [3, 1023, 1024, 60_000, 360_000]
    spark.createDataFrame([(k, f"S{k}", k % 25, float(k % 3 - 1)) for k in keys],
                          "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double") \
        .write.parquet(str(tmp_path / "supplier.parquet"))
    return str(tmp_path)


def test_supplier_keys_of_larger_tables(spark, many_suppliers):
    rows = pulls.dimension_rows(responses.campaign_pages(spark, many_suppliers), specs.CAMPAIGN_DIM, TS)
    caps = {r["campaign_id"]: r["lifetime_spend_cap"] for r in rows.collect()}
    big = 9007199254740993
    assert caps == {"3": 3 * big, "1023": 1023 * big, "1024": None, "60000": None, "360000": None}
    assert queries.entity_files(spark, many_suppliers).count() == 5
    assert queries.snapshot_replace(spark, many_suppliers).count() == 1  # the others are paused


@pytest.fixture()
def far_suppliers(spark, tmp_path):
    """Copies with keys shifted far: times beyond the year 9999, caps beyond a bigint."""
    keys = [1, 2_932_896, 2_932_897, 6_000_000, 10**13, 2 * 10**14, 2**63 - 1]
    spark.createDataFrame([(k, f"S{k}", 2 if k % 2 else 3, 1.0) for k in keys],
                          "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double") \
        .write.parquet(str(tmp_path / "supplier.parquet"))
    spark.createDataFrame([(k, p, dt.datetime(2000, 1, 1 + p)) for k in keys for p in (1, 2)],
                          "l_suppkey bigint, l_partkey bigint, l_shipdate timestamp_ntz") \
        .write.parquet(str(tmp_path / "lineitem.parquet"))
    return str(tmp_path), [str(k) for k in keys]


def test_supplier_keys_shifted_far(spark, far_suppliers):
    folder, keys = far_suppliers
    rows = queries.campaign_dimension(spark, folder).collect()
    assert {r["campaign_id"]: (r["daily_spend_cap"], r["created_time"]) for r in rows} == {
        k: (int(k) * 10**6 if int(k) < 10**13 else None, int(k) * 86400 if int(k) <= 2_932_896 else None) for k in keys}
    assert sorted(r["campaign_id"] for r in queries.entity_files(spark, folder).collect()) == sorted(keys)
    for query in (queries.snapshot_replace, queries.snapshot_replace_catalog, queries.scoped_replace):
        assert sorted(r["campaign_id"] for r in query(spark, folder).collect()) == sorted(keys)
    names = queries.replace_finished(spark, folder).where("table_name = 'campaign_dim'").collect()
    assert {(r["entity_id"], r["rows_written"]) for r in names} == {(k, len(keys)) for k in keys}


@pytest.fixture()
def many_days(spark, tmp_path):
    """Line items of 400 campaigns on 200 days each: a response of some 100 KB per campaign."""
    days = spark.range(400 * 200).select((F.col("id") % 400).alias("s"), (F.col("id") / 400).cast("int").alias("d"), F.col("id").alias("o"))
    days.select(F.col("o").alias("l_orderkey"), F.col("o").alias("l_partkey"), F.col("s").alias("l_suppkey"),
                F.lit(1).alias("l_linenumber"), F.lit(2.0).alias("l_quantity"), (F.col("o") + 0.5).alias("l_extendedprice"),
                F.lit("R").alias("l_returnflag"), F.lit("F").alias("l_linestatus"),
                F.expr("timestamp'2000-01-01' + make_dt_interval(d)").cast("timestamp_ntz").alias("l_shipdate")) \
        .write.parquet(str(tmp_path / "lineitem.parquet"))
    days.select(F.col("o").alias("o_orderkey"), F.lit(1).cast("bigint").alias("o_custkey")).write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(1, 2)], "c_custkey bigint, c_nationkey int").write.parquet(str(tmp_path / "customer.parquet"))
    spark.range(400).select(F.col("id").alias("s_suppkey"), F.lit("S").alias("s_name"), F.lit(3).alias("s_nationkey"),
                            F.lit(1.0).alias("s_acctbal")).write.parquet(str(tmp_path / "supplier.parquet"))
    return str(tmp_path)


def test_landed_bodies_are_read_in_small_groups(spark, many_days, tmp_path, monkeypatch):
    """A reader holds a row group's bodies at once, up to 4,096 of them."""
    landings = []

    def watched(session, landing, *args, **kwargs):
        landings.append(landing)
        return stream_revisions(session, landing, *args, **kwargs)

    monkeypatch.setattr(queries, "stream_revisions", watched)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 1)
    try:
        assert queries.stream_upsert(spark, many_days).count() == 400 * 200
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    files = [pq.ParquetFile(f).metadata for f in glob.glob(f"{landings[0].removeprefix('file:')}/*.parquet")]
    groups = [f.row_group(i) for f in files for i in range(f.num_row_groups)]
    assert sum(g.total_byte_size for g in groups) > 32 << 20
    assert max(g.total_byte_size for g in groups) < 16 << 20
