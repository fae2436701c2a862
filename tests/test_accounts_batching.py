import random

import pytest
from pyspark.sql import functions as F

from adlake import specs
from adlake.operators import batching
from adlake.operators.accounts import resolve_accounts


def discovered(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "ad_account_id string")


def test_allowlist_keeps_order_and_repeats(spark):
    accounts, missing = resolve_accounts(discovered(spark, "7", "3", "5", "3"), " 3, ,7,999,3")
    assert [r["ad_account_id"] for r in accounts.orderBy("request_pos").collect()] == ["3", "7", "3"]
    assert [r["ad_account_id"] for r in missing.collect()] == ["999"]


@pytest.mark.parametrize("blank", [None, ""])
def test_no_allowlist_takes_all(spark, blank):
    accounts, missing = resolve_accounts(discovered(spark, "7", "3"), blank)
    assert accounts.count() == 2 and missing.count() == 0


def test_blank_items_select_nothing(spark):
    accounts, missing = resolve_accounts(discovered(spark, "7"), " , ")
    assert accounts.count() == 0 and missing.count() == 0


def listing(spark, sizes):
    """Accounts with pages of given sizes; page numbers need not be consecutive."""
    rows, order = [], {}
    for account, pages in sizes.items():
        for page, size in pages:
            for pos in range(size):
                ident = f"{account}/{page}/{pos}"
                rows.append((account, page, pos, ident))
                order.setdefault(account, []).append(ident)
    random.Random(1).shuffle(rows)
    frame = spark.createDataFrame(rows, "ad_account_id string, page_no long, item_pos int, id string")
    return frame.repartition(5), order


@pytest.mark.parametrize("size", [1, 7, 100])
@pytest.mark.parametrize("block_pages", [1, 2, 1000])
def test_batches_cut_the_listing(spark, size, block_pages):
    frame, order = listing(spark, {
        "hot": [(p, 9) for p in range(0, 40)], "gaps": [(3, 2), (8, 5), (2001, 4)], "one": [(0, 1)]})
    got = batching.request_batches(frame, "id", size, block_pages)
    batches = {}
    for row in got.orderBy("batch_no").collect():
        assert row["n_ids"] == len(row["ids"].split(",")) <= size
        batches.setdefault(row["ad_account_id"], []).append(row)
    for account, ids in order.items():
        assert [i for b in batches[account] for i in b["ids"].split(",")] == ids
        assert [b["batch_no"] for b in batches[account]] == list(range(-(-len(ids) // size)))


def test_repeated_ids_stay(spark):
    frame, _ = listing(spark, {"a": [(0, 3)]})
    twice = frame.withColumn("id", F.lit("same"))
    (row,) = batching.request_batches(twice, "id", 100).collect()
    assert row["ids"] == "same,same,same"


def test_request_parameters(spark):
    frame, _ = listing(spark, {"a": [(0, 2)]})
    batches = batching.request_batches(frame, "id", 100)
    (row,) = batching.report_requests(batches, specs.AD_GENDER_FACT, "2024-01-01", "2024-01-14").collect()
    assert row["path"] == "ads/targeting_analytics" and row["id_param"] == "ad_ids"
    assert row["targeting_types"] == "GENDER" and row["granularity"] == "DAY"
    assert row["columns"].split(",")[:4] == ["AD_ID", "AD_GROUP_ID", "CAMPAIGN_ID", "AD_ACCOUNT_ID"]
    (row,) = batching.report_requests(batches, specs.CAMPAIGN_FACT, "a", "b").collect()
    assert row["path"] == "campaigns/analytics" and row["targeting_types"] is None
