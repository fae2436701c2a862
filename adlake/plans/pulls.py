"""Four job shapes: performance, breakdown, dimensions, reference.

Each step lands its responses as Parquet before the next one reads them, so that nothing
is requested twice, also not by a run that takes up one that died (``Source.landing``), and
a run leaves its raw responses for a later replay. Performance
and breakdown runs differ only in their table specification. Every step is a frame:
accounts, entities and requests never pass through the driver.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.functions.dates import window_of
from adlake.operators import batching, flatten
from adlake.operators.accounts import ACCOUNT, resolve_accounts
from adlake.operators.checks import Problems, watched
from adlake.operators.tables import Target, WriteReport, replace_all, replace, upsert
from adlake.session import run_dir
from adlake.sources import landed
from adlake.sources.landing import PER_TASK, land
from adlake.sources.paged import Fetch, RetryPolicy
from adlake.specs import (
    AD_DIM, AD_GROUP_DIM, CAMPAIGN_DIM, MARKET_REFERENCE, PAGE_SIZE, TableSpec,
)


@dataclass(frozen=True)
class Source:
    """How a run reaches the API: the caller's fetch, retries, requests per task, an upper bound
    of calls at once (by default what the cluster has room for), and where responses land.

    ``landing`` is the folder of one run (by default a fresh shared one). A run that died is
    repeated with the same folder and goes on with the requests that it does not hold yet.
    """

    fetch: Fetch
    concurrency: int | None = None
    policy: RetryPolicy = RetryPolicy()
    landing: str | None = None
    per_task: int = PER_TASK

    def land(self, worklist: DataFrame, label: str) -> DataFrame:
        """Request every row of the work list that has not landed, and read all pages."""
        base = self.landing or run_dir(worklist.sparkSession, "landing")
        return land(worklist, self.fetch, f"{base}/{label}", policy=self.policy, per_task=self.per_task,
                    concurrency=self.concurrency)


@dataclass(frozen=True)
class PullReport:
    """What a run wrote, and the requested accounts that are not visible."""

    written: list[WriteReport]
    missing_accounts: DataFrame | None = None


def discover(spark: SparkSession, source: Source, allowlist: str | None):
    """(accounts to pull, requested accounts that are not visible)."""
    listing = spark.range(1, numPartitions=1).select(
        F.lit("ad_accounts").alias("path"), F.lit(PAGE_SIZE).cast("bigint").alias("page_size")
    )
    return resolve_accounts(landed.listed_accounts(source.land(listing, "accounts")), allowlist)


def fact_rows(responses: DataFrame, spec: TableSpec, run_ts: dt.datetime) -> DataFrame:
    """Landed report or breakdown responses to checked table rows."""
    read = landed.breakdown_records if spec.targeting_type else landed.report_records
    return flatten.strict(read(responses, spec), spec, run_ts)


def dimension_rows(pages: DataFrame, spec: TableSpec, run_ts: dt.datetime) -> DataFrame:
    """Landed entity listings to checked table rows."""
    return flatten.strict(landed.entity_records(pages, spec), spec, run_ts)


def watched_fact_rows(responses: DataFrame, spec: TableSpec, run_ts: dt.datetime, problems: Problems) -> DataFrame:
    """As ``fact_rows``, but bad values pass as nulls and ``problems`` counts them all; whoever
    writes the rows has to call ``problems.refuse`` before they become visible."""
    read = landed.breakdown_records if spec.targeting_type else landed.report_records
    return watched(flatten.typed(read(responses, spec, problems.unread()), spec, run_ts), spec, problems)


def watched_dimension_rows(pages: DataFrame, spec: TableSpec, run_ts: dt.datetime, problems: Problems) -> DataFrame:
    """As ``dimension_rows``, with all problems counted."""
    return watched(flatten.typed(landed.entity_records(pages, spec, problems.unread()), spec, run_ts), spec, problems)


def reference_rows(responses: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Landed code-to-name responses to checked table rows."""
    return flatten.strict(landed.option_names(responses), MARKET_REFERENCE, run_ts)


def requested(spark: SparkSession, spec: TableSpec, source: Source, first: str, last: str, *, allowlist: str | None = None,
              max_records: int | None = None, values: int = 1) -> tuple[DataFrame, DataFrame]:
    """(landed responses of the days from ``first`` to ``last``, requested accounts that are not visible)."""
    accounts, missing = discover(spark, source, allowlist)
    listings = source.land(batching.listing_requests(accounts, spec.endpoint), spec.endpoint)
    batches = batching.page_batches(landed.listed_pages(listings), spec.batch_size)
    requests = batching.report_requests(batches, spec, first, last, max_records=max_records, values=values)
    return source.land(requests, spec.name), missing


def pull_fact(spark: SparkSession, spec: TableSpec, source: Source, target: Target, *,
              run_date: dt.date, run_ts: dt.datetime, allowlist: str | None = None,
              lookback: str | None = None, start: str | None = None,
              end: str | None = None, max_records: int | None = None, values: int = 1) -> PullReport:
    """A performance or breakdown run: list ids, batch them, request the window, upsert.

    Accounts without entities give no batch and so no request. Bad values refuse the run, with
    all of them counted per field (``checks.BadRows``), before the table changes. ``max_records`` cuts a long
    window into slices (``batching.report_requests``).
    """
    first, last = window_of(spark, run_date, lookback, start, end)
    responses, missing = requested(spark, spec, source, first, last, allowlist=allowlist, max_records=max_records, values=values)
    problems = Problems(spec)
    rows = watched_fact_rows(responses, spec, run_ts, problems)
    return PullReport([upsert(rows, target, spec, accept=problems.refuse)], missing)


def pull_dimensions(spark: SparkSession, source: Source, targets: dict[str, Target], *,
                    run_ts: dt.datetime, allowlist: str | None = None,
                    scoped: bool = False) -> PullReport:
    """Full listings of campaigns, ad groups and ads; the three tables are replaced only
    after all of them have been fetched, flattened and staged.

    An allowlisted run leaves only its accounts in the tables, unless ``scoped`` keeps the
    rows of the others.
    """
    accounts, missing = discover(spark, source, allowlist)
    parts, seen = [], []
    for spec in (CAMPAIGN_DIM, AD_GROUP_DIM, AD_DIM):
        pages = source.land(batching.listing_requests(accounts, spec.endpoint), spec.name)
        seen.append(Problems(spec))
        parts.append((watched_dimension_rows(pages, spec, run_ts, seen[-1]), targets[spec.name], spec))
    scope = accounts.select(ACCOUNT).distinct() if scoped else None
    return PullReport(replace_all(parts, scope, accept=lambda: [p.refuse() for p in seen]), missing)


def pull_reference(spark: SparkSession, source: Source, target: Target, *,
                   run_ts: dt.datetime) -> PullReport:
    """The market code-to-name list, replaced in full."""
    spec = MARKET_REFERENCE
    request = spark.range(1, numPartitions=1).select(
        F.lit(f"resources/targeting/{spec.targeting_type}").alias("path")
    )
    responses = source.land(request, spec.name)
    return PullReport([replace(reference_rows(responses, run_ts), target, spec)])
