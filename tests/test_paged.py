import json

import pytest
from pyspark.errors import PySparkException

from adlake.sources import landed
from adlake.sources.paged import RequestFailed, RetryPolicy, fetch_pages, pages, request

OK = (200, {}, "body")


class Script:
    """A fetch that gives prepared answers in order."""

    def __init__(self, *answers):
        self.answers, self.seen = list(answers), []

    def __call__(self, params):
        self.seen.append(params)
        return self.answers.pop(0)


def run(*answers):
    slept = []
    script = Script(*answers)
    return request(script, {}, RetryPolicy(sleep=slept.append)), slept


def test_retries_wait_and_double():
    assert run(OK) == ("body", [])
    assert run((500, {}, ""), (503, {}, ""), OK) == ("body", [2.0, 4.0])
    assert run((429, {"Retry-After": "7"}, ""), (502, {}, ""), OK) == ("body", [7.0, 4.0])
    assert run((429, {}, ""), OK) == ("body", [2.0])


def test_other_errors_do_not_retry():
    slept = []
    with pytest.raises(RequestFailed, match="status 403 after 1"):
        request(Script((403, {}, "no"), OK), {}, RetryPolicy(sleep=slept.append))
    assert slept == []


def test_attempts_run_out():
    slept = []
    with pytest.raises(RequestFailed, match="status 500 after 5"):
        request(Script(*[(500, {}, "")] * 5), {}, RetryPolicy(sleep=slept.append))
    assert slept == [2.0, 4.0, 8.0, 16.0]


@pytest.mark.parametrize("end", [None, "", "absent"])
def test_bookmarks_are_followed(end):
    last = {"items": []} | ({} if end == "absent" else {"bookmark": end})
    script = Script((200, {}, json.dumps({"items": [], "bookmark": "p2"})), (200, {}, json.dumps(last)))
    assert len(list(pages(script, {"k": 1}, RetryPolicy()))) == 2
    assert script.seen == [{"k": 1}, {"k": 1, "bookmark": "p2"}]


def test_arrays_and_unreadable_bodies_are_single_pages():
    assert list(pages(Script((200, {}, "[]")), {}, RetryPolicy())) == ["[]"]
    assert list(pages(Script((200, {}, "<html>")), {}, RetryPolicy())) == ["<html>"]


def numbered(params):
    """Account n has n pages of two ids."""
    page = int(params.get("bookmark", 0))
    items = [{"id": f"{params['ad_account_id']}-{page}-{i}"} for i in range(2)]
    more = str(page + 1) if page + 1 < int(params["ad_account_id"]) else None
    return 200, {}, json.dumps({"items": items, "bookmark": more})


def test_requests_spread_over_tasks(spark):
    accounts = spark.createDataFrame([(str(n), None) for n in range(1, 8)], "ad_account_id string, note string")
    got = landed.listed_ids(fetch_pages(accounts, numbered, concurrency=3))
    assert got.count() == 2 * sum(range(1, 8))
    assert {r["page_no"] for r in got.filter("ad_account_id = '7'").collect()} == set(range(7))
    assert accounts.columns == ["ad_account_id", "note"]


def test_large_answers_leave_in_parts(spark, monkeypatch):
    monkeypatch.setattr("adlake.sources.paged.FLUSH_BYTES", 10)
    accounts = spark.createDataFrame([("5",), ("3",)], "ad_account_id string").coalesce(1)
    assert fetch_pages(accounts, numbered).count() == 8


def test_a_failing_request_fails_the_job(spark):
    def refuse(params):
        return 401, {}, "no"

    accounts = spark.createDataFrame([("1",)], "ad_account_id string")
    with pytest.raises(PySparkException, match="status 401"):
        fetch_pages(accounts, refuse).collect()


def test_the_wait_header_has_no_case():
    waits = []
    fetch = Script((429, {"retry-after": "7"}, ""), (429, {"RETRY-AFTER": "9"}, ""), OK)
    assert request(fetch, {}, RetryPolicy(sleep=waits.append)) == "body"
    assert waits == [7.0, 9.0]
