import datetime as dt
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException

from adlake import specs
from adlake.operators import checks, flatten
from adlake.plans import pulls
from adlake.sources import landed
from test_landed import responses

TS = dt.datetime(2024, 1, 2, 3, 4, 5, tzinfo=dt.timezone.utc)


def ad_rows(spark, *records):
    return pulls.fact_rows(responses(spark, json.dumps(records)), specs.AD_FACT, TS).collect()


def test_schemas():
    sizes = {s.name: len(s.fields) for s in specs.ALL_TABLES}
    assert sizes == {
        "ad_performance": 21, "ad_group_performance": 22, "campaign_performance": 22,
        "ad_dma_performance": 22, "ad_gender_performance": 22, "ad_age_performance": 22,
        "dma_reference": 3, "campaign_dim": 27, "ad_group_dim": 39, "ad_dim": 40}
    assert [len(s.requested) for s in (*specs.PERFORMANCE_FACTS, *specs.BREAKDOWN_FACTS)] == [
        19, 20, 20, 19, 19, 19]
    assert specs.AD_GROUP_FACT.requested[:5] == [
        "AD_GROUP_ID", "CAMPAIGN_ID", "AD_ACCOUNT_ID", "AD_GROUP_NAME", "AD_GROUP_ENTITY_STATUS"]


def test_edge_values(spark):
    (row,) = ad_rows(spark, {
        "AD_ID": 42, "AD_ACCOUNT_ID": "other", "SPEND_IN_DOLLAR": 0, "TOTAL_IMPRESSION": 12.7,
        "TOTAL_CLICKTHROUGH": "12", "LEADS": None, "TOTAL_CONVERSIONS": 9007199254740993})
    assert row["ad_id"] == "42" and row["ad_account_id"] == "acct"
    assert row["spend"] == 0.0 and row["impressions"] == 12 and row["clicks"] == 12
    assert row["leads"] is None and row["ctr"] is None
    assert row["conversions"] == 9007199254740993
    assert row["stat_date"] == dt.date(2024, 1, 1)  # no date: window start


@pytest.mark.parametrize("record, problem", [
    ({"DATE": "2024-01-01"}, "ad_id missing"),
    ({"AD_ID": "a", "DATE": None}, "stat_date missing"),
    ({"AD_ID": "a", "DATE": "2024-02-30"}, "stat_date unreadable"),
    ({"AD_ID": "a", "LEADS": "many"}, "leads unreadable"),
    ({"AD_ID": "a", "SPEND_IN_DOLLAR": {"x": 1}}, "spend unreadable"),
])
def test_bad_rows(spark, record, problem):
    with pytest.raises(PySparkException, match=problem):
        ad_rows(spark, {"AD_ID": "fine"}, record)
    records = landed.report_records(responses(spark, json.dumps([{"AD_ID": "fine"}, record])), specs.AD_FACT)
    good, bad = checks.quarantine(flatten.typed(records, specs.AD_FACT, TS), specs.AD_FACT)
    assert [r["ad_id"] for r in good.collect()] == ["fine"]
    assert [r["problems"] for r in bad.collect()] == [problem]
    assert good.columns == specs.AD_FACT.columns


def test_breakdown_value_is_required(spark):
    body = json.dumps({"data": [{"metrics": {"AD_ID": "a"}}]})
    with pytest.raises(PySparkException, match="gender missing"):
        pulls.fact_rows(responses(spark, body), specs.AD_GENDER_FACT, TS).collect()


def test_entity_values(spark):
    entity = {
        "id": "g1", "campaign_id": 5, "bid_multiplier": 2, "local_inventory_radius_in_miles": 5,
        "created_time": 0, "updated_time": None, "customer_segment_id": "007",
        "is_local_inventory": False, "promotion_ids": [], "ext_features": {},
        "dca_assets": '{"a":1}', "tracking_urls": None,
        "targeting_spec": {"z": 1, "a": [2.0, None, "é"], "n": 9007199254740993},
        "optimization_goal_metadata": "plain \"text\"", "targeting_template_ids": 5}
    pages = responses(spark, json.dumps({"items": [entity]}))
    (row,) = pulls.dimension_rows(pages, specs.AD_GROUP_DIM, TS).collect()
    assert row["campaign_id"] == "5" and row["bid_multiplier"] == 2.0
    assert row["local_inventory_radius_in_miles"] == 5.0 and row["customer_segment_id"] == "007"
    assert row["created_time"].timestamp() == 0 or row["created_time"] == dt.datetime(1970, 1, 1)
    assert row["updated_time"] is None and row["is_local_inventory"] is False
    assert row["promotion_ids_json"] == "[]" and row["ext_features_json"] == "{}"
    assert row["tracking_urls_json"] is None and row["targeting_template_ids_json"] == "5"
    for name in ("dca_assets", "targeting_spec", "optimization_goal_metadata"):
        assert json.loads(row[f"{name}_json"]) == entity[name]
    assert list(json.loads(row["targeting_spec_json"])) == ["z", "a", "n"]


numbers = st.one_of(st.none(), st.integers(-2**62, 2**62))
reals = st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False, width=64))
texts = st.one_of(st.none(), st.text(st.characters(blacklist_categories=("Cs", "Cc")), max_size=8))
row_strategy = st.fixed_dictionaries({
    f.name: {"long": numbers, "double": reals, "text": texts}[f.kind]
    for f in specs.AD_FACT.payload if f.kind != "date"})


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row_strategy, min_size=1, max_size=8))
def test_flatten_inverts_rendering(spark, rows):
    raw = {f.name: f.raw for f in specs.AD_FACT.payload}
    records = [{raw[k]: v for k, v in r.items()} | {"AD_ID": f"id{i}", "DATE": "2024-01-03"}
               for i, r in enumerate(rows)]
    got = {r["ad_id"]: r for r in ad_rows(spark, *records)}
    for i, row in enumerate(rows):
        for name, value in row.items():
            if name != "ad_id":
                assert got[f"id{i}"][name] == value, name
