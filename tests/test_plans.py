"""Whole runs against a scripted API of three accounts, one of them without entities."""

import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException

from adlake import specs
from adlake.operators.tables import Target
from adlake.plans import pulls
from adlake.sources.paged import RetryPolicy

TS = dt.datetime(2024, 1, 20, tzinfo=dt.timezone.utc)
RUN = dt.date(2024, 1, 20)


class Api:
    def __init__(self, ads=260, revision=0, broken=None):
        self.ads, self.revision, self.broken = ads, revision, broken

    def page(self, request, items, size):
        start = int(request.get("bookmark", 0))
        more = str(start + size) if start + size < len(items) else None
        return 200, {}, json.dumps({"items": items[start:start + size], "bookmark": more})

    def __call__(self, request):
        path, account = request["path"], request.get("ad_account_id")
        if path == self.broken:
            return 404, {}, "gone"
        if path == "ad_accounts":
            return self.page(request, [{"id": "1"}, {"id": "2"}, {"id": "empty"}], 2)
        if path.startswith("resources/"):
            return 200, {}, '[{"500":"Portland","501":"New York"}]'
        if path in ("ads", "ad_groups", "campaigns"):
            count = 0 if account == "empty" else self.ads if path == "ads" else 3
            items = [{"id": f"{account}-{i}", "name": f"{path} {i}", "created_time": i} for i in range(count)]
            return self.page(request, items, request["page_size"])
        ids = request["ids"].split(",")
        limit = 250 if "targeting" in path or not path.startswith("ads") else 100
        assert len(ids) <= limit and request["granularity"] == "DAY"
        days = sorted({request["start_date"], request["end_date"]})
        id_name = request["id_param"].removesuffix("s").upper()
        rows = [{id_name: i, "DATE": d, "SPEND_IN_DOLLAR": n + self.revision, "AD_ACCOUNT_ID": "?"}
                for n, i in enumerate(ids) for d in days]
        if "targeting" not in path:
            return 200, {}, json.dumps(rows)
        data = [{"targeting_type": request["targeting_types"], "targeting_value": v, "metrics": r}
                for r in rows for v in ("500", "501")]
        return 200, {}, json.dumps({"data": data})


def source(**options):
    return pulls.Source(Api(**options), concurrency=3, policy=RetryPolicy(first_wait=0))


def test_performance_runs(spark, tmp_path):
    target = Target(path=str(tmp_path / "t"))
    report = pulls.pull_fact(spark, specs.AD_FACT, source(), target, run_date=RUN, run_ts=TS)
    assert report.written[0].rows == 2 * 260 * 2 and report.missing_accounts.count() == 0
    rows = target.read(spark, specs.AD_FACT)
    assert rows.select("ad_account_id").distinct().count() == 2
    assert {str(r[0]) for r in rows.select("stat_date").distinct().collect()} == {"2024-01-06", "2024-01-19"}
    total = rows.agg({"spend": "sum"}).first()[0]
    report = pulls.pull_fact(spark, specs.AD_FACT, source(revision=1), target, run_date=RUN, run_ts=TS,
                             allowlist="2, 2,nobody")
    assert [r["ad_account_id"] for r in report.missing_accounts.collect()] == ["nobody"]
    rows = target.read(spark, specs.AD_FACT)
    assert rows.count() == 1040 and rows.agg({"spend": "sum"}).first()[0] == total + 520


@pytest.mark.parametrize("spec", [specs.AD_GROUP_FACT, specs.CAMPAIGN_FACT], ids=lambda s: s.name)
def test_other_levels(spark, tmp_path, spec):
    target = Target(path=str(tmp_path / "t"))
    report = pulls.pull_fact(spark, spec, source(), target, run_date=RUN, run_ts=TS, lookback="1")
    assert report.written[0].rows == 6 and report.written[0].days == 1


@pytest.mark.parametrize("spec", specs.BREAKDOWN_FACTS, ids=lambda s: s.name)
def test_breakdown_runs(spark, tmp_path, spec):
    target = Target(path=str(tmp_path / "t"))
    report = pulls.pull_fact(spark, spec, source(ads=5), target, run_date=RUN, run_ts=TS,
                             start="2023-12-01", end="2023-12-02")
    assert report.written[0].rows == 2 * 5 * 2 * 2 and report.written[0].days == 2


def test_no_accounts_no_write(spark, tmp_path):
    target = Target(path=str(tmp_path / "t"))
    report = pulls.pull_fact(spark, specs.AD_FACT, source(), target, run_date=RUN, run_ts=TS, allowlist="9")
    assert report.written[0].rows == 0 and target.read(spark, specs.AD_FACT).count() == 0


def test_dimension_runs(spark, tmp_path):
    targets = {s.name: Target(path=str(tmp_path / s.name)) for s in specs.DIMENSIONS}
    count = lambda s: targets[s.name].read(spark, s).count()
    report = pulls.pull_dimensions(spark, source(), targets, run_ts=TS)
    assert [w.rows for w in report.written] == [6, 6, 520]
    with pytest.raises(PySparkException, match="status 404"):
        pulls.pull_dimensions(spark, source(ads=1, broken="ads"), targets, run_ts=TS)
    assert [count(s) for s in specs.DIMENSIONS] == [6, 6, 520]
    pulls.pull_dimensions(spark, source(ads=10), targets, run_ts=TS, allowlist="1", scoped=True)
    assert [count(s) for s in specs.DIMENSIONS] == [6, 6, 270]
    pulls.pull_dimensions(spark, source(ads=10), targets, run_ts=TS, allowlist="1")
    assert [count(s) for s in specs.DIMENSIONS] == [3, 3, 10]


def test_reference_run(spark, tmp_path):
    target = Target(path=str(tmp_path / "t"))
    pulls.pull_reference(spark, source(), target, run_ts=TS)
    rows = target.read(spark, specs.MARKET_REFERENCE).collect()
    assert {(r["dma_code"], r["dma_name"]) for r in rows} == {("500", "Portland"), ("501", "New York")}
