import datetime as dt
import os
import uuid

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from test_plans import Api

from adlake import specs
from adlake.operators.tables import Target
from adlake.plans import pulls
from adlake.sources.paged import RetryPolicy
from adlake.streaming.polling import _Due, poll
from adlake.streaming.revisions import LANDED_SCHEMA, PULL, Sidings, StreamReport, stream_revisions

FIRST = dt.datetime(2024, 1, 20, 6, tzinfo=dt.timezone.utc)
DAY = dt.timedelta(days=1)


class LoggedApi(Api):
    """Leaves a file per call; refuses reports of accounts that it does not serve."""

    def __init__(self, log, serves=("1", "2"), **options):
        super().__init__(**options)
        self.log, self.serves = log, serves

    def __call__(self, request):
        open(os.path.join(self.log, f"{request['path'].replace('/', '-')}.{uuid.uuid4()}"), "w").close()
        if "ids" in request and request["ad_account_id"] not in self.serves:
            return 403, {}, "not now"
        return super().__call__(request)


class Poll:
    def __init__(self, spark, folder):
        self.spark, self.folder, self.logs = spark, folder, 0
        self.target = Target(path=str(folder / "table"))

    def __call__(self, until, sidings=None, **options):
        self.logs += 1
        self.log = self.folder / f"log{self.logs}"
        self.log.mkdir()
        report = StreamReport()
        source = pulls.Source(LoggedApi(str(self.log), **options), policy=RetryPolicy(first_wait=0), per_task=1)
        poll(self.spark, source, self.target, specs.CAMPAIGN_FACT, first=FIRST, every=DAY, until=until, report=report, sidings=sidings,
             landing=str(self.folder / "landing"), checkpoint=str(self.folder / "check")).awaitTermination()
        return report

    def asked(self):
        return sorted(name.split(".")[0] for name in os.listdir(self.log))

    def content(self, target=None):
        rows = (target or self.target).read(self.spark, specs.CAMPAIGN_FACT).collect()
        return sorted((r["ad_account_id"], r["campaign_id"], str(r["stat_date"]), r["spend"]) for r in rows)


def test_polls_equal_landed_pulls_over_restarts(spark, tmp_path):
    run = Poll(spark, tmp_path)
    assert run(FIRST - DAY).batches == 0 and run.asked() == []  # nothing due yet
    assert (first := run(FIRST + DAY / 2)).batches == 1 and first.rows == 12
    assert {r[2] for r in run.content()} == {"2024-01-06", "2024-01-19"}
    assert run(FIRST + DAY / 2).batches == 0 and run.asked() == []  # a restart does nothing twice
    later = run(FIRST + 3 * DAY, revision=1)  # three pulls, made up for by one
    assert later.batches == 1 and run.asked().count("campaigns-analytics") == 2
    assert {r[2] for r in run.content()} == {"2024-01-06", "2024-01-07", "2024-01-19", "2024-01-22"}
    landed, copy = str(tmp_path / "landed"), Target(path=str(tmp_path / "copy"))
    for pull in (FIRST, FIRST + 3 * DAY):
        number = int(pull.timestamp())
        pages = spark.read.parquet(f"{tmp_path}/landing/{number}/{specs.CAMPAIGN_FACT.name}")
        pages = pages.withColumn(PULL, F.lit(number).cast("bigint"))
        pages.select(*(c.split()[0] for c in LANDED_SCHEMA.split(", "))).write.mode("append").parquet(landed)
    stream_revisions(spark, landed, copy, specs.CAMPAIGN_FACT, checkpoint=str(tmp_path / "other"),
                     run_date=FIRST.date(), run_ts=FIRST).awaitTermination()
    assert run.content() == run.content(copy) and len(run.content()) == 24


def test_a_poll_that_died_goes_on(spark, tmp_path):
    run = Poll(spark, tmp_path)
    with pytest.raises(StreamingQueryException):
        run(FIRST, serves=("1",))
    assert run.asked().count("campaigns-analytics") >= 1
    again = run(FIRST + DAY)  # the batch that failed, as it was
    assert (again.batches, again.rows) == (1, 12) and {r[2] for r in run.content()} == {"2024-01-06", "2024-01-19"}
    assert not {"ad_accounts", "campaigns"} & set(run.asked())  # listings had landed
    assert run(FIRST + DAY).rows == 12 and run.asked().count("campaigns") == 3  # the pull after it


def test_bad_values_of_a_poll_are_set_aside(spark, tmp_path):
    run, sidings = Poll(spark, tmp_path), Sidings(str(tmp_path / "sidings"))
    run(FIRST, sidings=sidings)
    assert [tuple(r) for r in sidings.ledger(spark).select("rows", "late", "bad", "unreadable").collect()] == [(12, 0, 0, 0)]


def test_pulls_due():
    due = _Due(1000, 60, 1150)
    assert due.initialOffset() == {"pull": 940} and due.latestOffset() == {"pull": 1120}
    assert [p.value for p in due.partitions({"pull": 940}, {"pull": 1120})] == [(1000, 1120)]
    assert due.partitions({"pull": 1120}, {"pull": 1120}) == [] == due.partitions({"pull": 1180}, {"pull": 1120})
    assert _Due(1000, 60, 10).latestOffset() == {"pull": 940}
    assert list(due.read(due.partitions({"pull": 1000}, {"pull": 1060})[0])) == [(1060, 1060)]
