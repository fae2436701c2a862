"""Landed requests: what a run that died need not ask again."""

import json
import os
import time
from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from adlake.sources import landed, landing
from adlake.sources.landing import ForeignPages
from adlake.sources.paged import RetryPolicy

QUICK = RetryPolicy(attempts=1)


class Counting:
    """Serves two pages a request, notes every first call in a folder, and refuses some."""

    def __init__(self, folder, refused=()):
        self.folder, self.refused = str(folder), set(refused)

    def __call__(self, request):
        account = request["ad_account_id"]
        if account in self.refused:
            time.sleep(4)  # the other tasks end meanwhile
            return 403, {}, "no"
        if "bookmark" not in request:
            with open(f"{self.folder}/{account}", "a") as notes:
                notes.write("x")
        more = None if "bookmark" in request else "2"
        return 200, {}, json.dumps({"items": [{"id": f"{account}-{more}"}], "bookmark": more})

    def calls(self):
        return Counter({name: os.path.getsize(f"{self.folder}/{name}") for name in os.listdir(self.folder)})


@pytest.fixture
def notes(tmp_path):
    (tmp_path / "notes").mkdir()
    return tmp_path / "notes"


def accounts(spark, *names):
    return spark.createDataFrame([(n, None) for n in names], "ad_account_id string, note string")


def ids(frame):
    return sorted(r["id"] for r in landed.listed_ids(frame).collect())


def test_a_run_that_failed_goes_on(spark, tmp_path, notes):
    names = [f"a{n}" for n in range(12)]
    folder = str(tmp_path / "landing")
    with pytest.raises(PySparkException, match="status 403"):
        landing.land(accounts(spark, *names), Counting(notes, {"a5"}), folder, policy=QUICK, per_task=1)
    done = {r[0] for r in spark.read.parquet(folder).select("ad_account_id").distinct().collect()}
    assert len(done) > 5 and "a5" not in done  # what had ended before is there, with all its pages
    assert spark.read.parquet(folder).count() == 2 * len(done)
    before = Counting(notes).calls()
    frame = landing.land(accounts(spark, *names), Counting(notes), folder, policy=QUICK, per_task=1)
    again = Counting(notes).calls()
    assert {n for n in names if again[n] > before[n]} == set(names) - done
    assert ids(frame) == sorted(f"{n}-{m}" for n in names for m in ("2", None))
    assert frame.columns == ["ad_account_id", "note", "page_no", "body"]


def test_a_task_that_died_leaves_no_part(spark, tmp_path, notes):
    """All requests of the failing task are asked again, and none appears twice."""
    names = [f"a{n}" for n in range(10)]
    folder = str(tmp_path / "landing")
    with pytest.raises(PySparkException):
        landing.land(accounts(spark, *names), Counting(notes, {"a7"}), folder, policy=QUICK, per_task=10)
    assert landing.landed_requests(spark, folder).count() == 0
    assert len(ids(landing.land(accounts(spark, *names), Counting(notes), folder, per_task=3))) == 20


def test_a_landed_work_list_is_not_asked_again(spark, tmp_path, notes):
    folder, fetch = str(tmp_path / "landing"), Counting(notes)
    work = accounts(spark, "a", "b", "b")
    assert len(ids(landing.land(work, fetch, folder))) == 4
    assert len(ids(landing.land(work, fetch, folder))) == 4
    assert fetch.calls() == {"a": 1, "b": 1}  # one that is named twice is one request
    assert len(ids(landing.land(accounts(spark, "a", "b", "c"), fetch, folder))) == 6
    assert fetch.calls() == {"a": 1, "b": 1, "c": 1}
    with pytest.raises(ForeignPages):
        landing.land(accounts(spark, "a", "b"), fetch, folder)


def test_parameters_are_the_identity(spark):
    rows = spark.createDataFrame([("1", None), ("1", ""), (None, "1"), ("1", "2")], "a string, b string")
    assert rows.select(landing.request_id(rows)).distinct().count() == 4


def test_tasks_follow_the_work_list(spark, tmp_path, notes, monkeypatch):
    seen = []
    fetched = landing.fetch_pages
    monkeypatch.setattr(landing, "fetch_pages", lambda work, *a, **k: (seen.append(work.rdd.getNumPartitions()), fetched(work, *a, **k))[1])
    work = accounts(spark, *(f"a{n}" for n in range(20)))
    landing.land(work, Counting(notes), str(tmp_path / "1"), per_task=3)
    assert seen == [7]
    landing.land(work, Counting(notes), str(tmp_path / "2"), per_task=3, concurrency=2)
    assert seen[1:] == [2, 2, 2, 2]


def test_an_empty_work_list(spark, tmp_path, notes):
    frame = landing.land(accounts(spark, "a").where(F.lit(False)), Counting(notes), str(tmp_path / "landing"))
    assert frame.count() == 0 and not os.path.exists(tmp_path / "landing")
