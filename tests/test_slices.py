"""Listings numbered by pages, and long windows requested in slices."""

import datetime as dt
import json
import random

import pytest
from pyspark.errors import PySparkException

from adlake import specs
from adlake.operators import batching
from adlake.sources import landed
from test_physical import executed


def pages(spark, sizes):
    """Listing pages of given sizes; page numbers need not be consecutive."""
    rows, order = [], {}
    for account, listed in sizes.items():
        for page, size in listed:
            ids = [f"{account}/{page}/{n}" for n in range(size)]
            order.setdefault(account, []).extend(ids)
            rows.append((account, page, json.dumps({"items": [{"id": i} for i in ids], "bookmark": "x"})))
    random.Random(2).shuffle(rows)
    return spark.createDataFrame(rows, "ad_account_id string, page_no long, body string").repartition(5), order


SIZES = {"hot": [(p, 9) for p in range(40)], "gaps": [(3, 2), (8, 0), (9, 5), (2001, 4)], "one": [(0, 1)], "none": [(0, 0)]}


@pytest.mark.parametrize("block_pages", [1, 7, 1000])
def test_pages_are_numbered(spark, block_pages):
    frame, order = pages(spark, SIZES)
    listed = landed.listed_pages(frame)
    placed = batching.page_positions(listed, "id", block_pages)
    want = sorted((a, i, n) for a, ids in order.items() for n, i in enumerate(ids))
    assert sorted(map(tuple, placed.collect())) == want
    got = batching.page_batches(listed, 7, block_pages).collect()
    same = batching.request_batches(landed.listed_ids(frame), "id", 7, block_pages).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, same))


def test_a_listing_is_parsed_and_dealt_once(spark, tmp_path):
    frame, _ = pages(spark, SIZES)
    frame.write.parquet(str(tmp_path / "landed"))
    batches = batching.page_batches(landed.listed_pages(spark.read.parquet(str(tmp_path / "landed"))), 100)
    batches.collect()
    final = executed(batches).split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and final.count("from_json(") == 1 and final.count("ReusedExchange") == 1
    below = final.split("Generate posexplode", 1)[1]
    assert "Generate" not in below  # pages are joined with the sums, ids with nothing


def test_an_object_without_id_fails(spark):
    frame = spark.createDataFrame([("a", 0, '{"items":[{"name":"x"}]}')], "ad_account_id string, page_no long, body string")
    with pytest.raises(PySparkException, match="without id"):
        landed.listed_pages(frame).collect()


@pytest.mark.parametrize("most", [1, 60, 1000, 10**9])
def test_slices_cover_the_window(spark, most):
    batches = spark.createDataFrame([("a", 0, 10, "x"), ("a", 1, 3, "y")], "ad_account_id string, batch_no long, n_ids long, ids string")
    first, last = dt.date(2023, 12, 20), dt.date(2024, 3, 3)
    rows = batching.report_requests(batches, specs.AD_MARKET_FACT, str(first), str(last), max_records=most, values=2).collect()
    for batch, n_ids in ((0, 10), (1, 3)):
        spans = sorted((dt.date.fromisoformat(r["start_date"]), dt.date.fromisoformat(r["end_date"])) for r in rows if r["batch_no"] == batch)
        assert spans[0][0] == first and spans[-1][1] == last
        assert all(b[0] == a[1] + dt.timedelta(1) for a, b in zip(spans, spans[1:]))
        days = [(b - a).days + 1 for a, b in spans]
        assert all(d == 1 or d * n_ids * 2 <= most for d in days) and len(set(days[:-1])) <= 1
    whole = batching.report_requests(batches, specs.AD_MARKET_FACT, str(first), str(last)).drop("start_date", "end_date")
    cut = spark.createDataFrame(rows, batching.report_requests(batches, specs.AD_MARKET_FACT, "", "").schema)
    assert sorted(map(str, cut.drop("start_date", "end_date").distinct().collect())) == sorted(map(str, whole.collect()))


def test_an_empty_window_asks_nothing(spark):
    batches = spark.createDataFrame([("a", 0, 10, "x")], "ad_account_id string, batch_no long, n_ids long, ids string")
    assert batching.report_requests(batches, specs.AD_FACT, "2024-01-02", "2024-01-01", max_records=5).count() == 0
