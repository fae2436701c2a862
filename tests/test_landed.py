import json

import pytest
from pyspark.errors import PySparkException

from adlake import specs
from adlake.sources import landed

GOOD_ARRAY = '[{"AD_ID":"a"}]'
BAD_ARRAYS = ['[{"AD_ID":"a"},{"AD', "<html>", "", "null", "5", '{"code":3}', "[1]", GOOD_ARRAY + " x"]
GOOD_LISTINGS = ['{"items":[{"id":1}]}', '{"items":[]}', '{"bookmark":null}', ' {"items":[{"id":1}]}\n']
BAD_LISTINGS = ['{"items":[{"id":1}', "<html>", "[1]", '{"items":null}', '{"items":{"id":1}}',
                '{"items":[{"id":1}]} x', ""]


def responses(spark, *bodies, start="2024-01-01"):
    return spark.createDataFrame(
        [("acct", start, n, b) for n, b in enumerate(bodies)],
        "ad_account_id string, start_date string, page_no long, body string")


@pytest.mark.parametrize("body", BAD_ARRAYS)
def test_unreadable_report_aborts(spark, body):
    with pytest.raises(PySparkException, match="unreadable response"):
        landed.report_records(responses(spark, body), specs.AD_FACT).collect()


def test_split_unreadable(spark):
    frame = responses(spark, GOOD_ARRAY, "[]", " \n[]\t", *BAD_ARRAYS)
    good, bad = landed.split_unreadable(frame, "report")
    assert [good.count(), bad.count()] == [3, len(BAD_ARRAYS)]
    frame = responses(spark, *GOOD_LISTINGS, *BAD_LISTINGS)
    good, bad = landed.split_unreadable(frame, "listing")
    assert [good.count(), bad.count()] == [len(GOOD_LISTINGS), len(BAD_LISTINGS)]


@pytest.mark.parametrize("body", BAD_LISTINGS)
def test_unreadable_listing_aborts(spark, body):
    with pytest.raises(PySparkException, match="unreadable response"):
        landed.listed_accounts(responses(spark, body)).collect()


def test_listing_keeps_items_whole(spark):
    item = {"id": "1", "spec": {"z": [1, {"b": None}], "a": "é"}, "n": 9007199254740993}
    frame = responses(spark, json.dumps({"items": [item, {"id": 2}], "bookmark": "x"}), '{"items":[]}')
    rows = landed.listed_items(frame).orderBy("item_pos").collect()
    assert [json.loads(r["item"]) for r in rows] == [item, {"id": 2}]
    assert [r["id"] for r in landed.listed_ids(frame).orderBy("item_pos").collect()] == ["1", "2"]


def test_absent_date_is_told_from_null(spark):
    body = '[{"AD_ID":"a","DATE":"2024-01-05"},{"AD_ID":"b"},{"AD_ID":"c","DATE":null}, null]'
    rows = landed.report_records(responses(spark, body), specs.AD_FACT).collect()
    assert [(r["raw"] and r["raw"]["AD_ID"], r["has_date"]) for r in rows] == [
        ("a", True), ("b", False), ("c", True), (None, False)]


def test_breakdown_shapes(spark):
    body = json.dumps({"data": [
        {"targeting_type": "X", "targeting_value": "500", "metrics": {"AD_ID": "a", "DATE": None}},
        {"targeting_value": 501, "metrics": {"AD_ID": "b"}}, {"targeting_value": "502"}]})
    frame = responses(spark, body, '{"other":1}')
    rows = landed.breakdown_records(frame, specs.AD_MARKET_FACT).collect()
    assert [(r["targeting_value"], r["has_date"]) for r in rows] == [
        ("500", True), ("501", False), ("502", False)]


def test_last_option_wins(spark):
    frame = responses(spark, '[{"1":"a","2":"b"},{"2":"c"}]', '[{"1":"z"}]')
    rows = landed.option_names(frame).select("raw.*").collect()
    assert {r["code"]: r["name"] for r in rows} == {"1": "z", "2": "c"}


def test_response_files_keep_ids_as_text(spark, tmp_path):
    folder = tmp_path / "ad_account_id=007" / "page_no=0"
    folder.mkdir(parents=True)
    (folder / "page.json").write_text('{"items":[{"id":"1"},\n{"id":"2"}]}')
    files = landed.read_response_files(spark, str(tmp_path), "ad_account_id string, page_no bigint")
    rows = landed.listed_ids(files).collect()
    assert [(r["ad_account_id"], r["page_no"], r["item_pos"], r["id"]) for r in rows] == [
        ("007", 0, 0, "1"), ("007", 0, 1, "2")]


@pytest.mark.parametrize("bad", [
    '{"items":[{"id":"1"}]}{"items":[{"id":"2"}]}', '{"items":[{"id":"1"}]} x', '{"items":[{"id":"1"}]}]', "[1]", "<html>", ""])
def test_text_after_a_listing_is_unreadable(spark, bad):
    rows = spark.createDataFrame([("a", 0, '{"items":[{"id":"1"}]}'), ("b", 0, bad)], "account string, page_no int, body string")
    good, rest = landed.split_unreadable(rows, "listing")
    assert [r["account"] for r in good.collect()] == ["a"] and [r["account"] for r in rest.collect()] == ["b"]
    with pytest.raises(Exception, match="unreadable response"):
        landed.listed_ids(rows).collect()


@pytest.mark.parametrize("bad", ['[{"DATE":"x"}][{"DATE":"y"}]', '[{"DATE":"x"}] ]', '[{"DATE":"x"}], 1'])
def test_text_after_a_report_is_unreadable(spark, bad):
    rows = spark.createDataFrame([('[{"DATE":"x"}]',), (' [ ] ',), (bad,)], "body string")
    good, rest = landed.split_unreadable(rows, "report")
    assert good.count() == 2 and rest.count() == 1


def test_an_object_without_id_aborts(spark):
    rows = spark.createDataFrame([("a", '{"items":[{"id":"1"},{"name":"x"},{"id":"3"}]}')], "account string, body string")
    with pytest.raises(Exception, match="without id"):
        landed.listed_ids(rows).collect()
