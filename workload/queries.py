"""One query per operator: test tables, rendered as responses, through the library.

Results carry only strings, whole numbers, doubles and dates, so that two engines can be
compared by value; the run stamp is left out.
"""

from __future__ import annotations

import datetime as dt
import functools
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake import specs
from adlake.functions import lists, values, variants
from adlake.functions.dates import in_window, window_columns, window_of
from adlake.operators import batching, checks, flatten, reports, tables
from adlake.operators.accounts import resolve_accounts
from adlake.operators.tables import Target
from adlake.plans import pulls
from adlake.session import run_dir
from adlake.sources import landed
from adlake.sources.landing import land
from adlake.sources.paged import RetryPolicy, fetch_pages
from adlake.streaming.revisions import (
    LANDED_SCHEMA, PULL, Sidings, StreamReport, divert_batch, stream_revisions,
)
from workload import responses as R

RUN_TS = dt.datetime(2024, 1, 2, 3, 4, 5, tzinfo=dt.timezone.utc)
WINDOW_RUN = dt.date(2000, 6, 22)  # its 14-day window is 2000-06-08 .. 2000-06-21
ALLOWLIST = " 3, ,7,999,3"


def comparable(df: DataFrame) -> DataFrame:
    """Timestamps as Unix seconds, flags as text, no run stamp."""
    def column(field: T.StructField) -> Column:
        if isinstance(field.dataType, T.TimestampType):
            return F.unix_seconds(field.name).alias(field.name)
        if isinstance(field.dataType, T.BooleanType):
            return F.col(field.name).cast("string").alias(field.name)
        return F.col(field.name)

    return df.select(*(column(f) for f in df.schema if f.name != "ingested_at"))


# --- facts: source, flatten, checks --------------------------------------------------


def _reading(spec, columns):
    """What a report reads of a table: all of it, or the columns that it names."""
    return spec.only(*columns) if columns else spec


def ad_facts(spark, sf, *columns):
    return pulls.fact_rows(R.ad_report(spark, sf), _reading(specs.AD_FACT, columns), RUN_TS)


def campaign_facts(spark, sf, *columns):
    return pulls.fact_rows(R.campaign_report(spark, sf), _reading(specs.CAMPAIGN_FACT, columns), RUN_TS)


def breakdown_facts(spark, sf, spec, column, *columns):
    bodies = R.ad_breakdown(spark, sf, column, spec.targeting_type)
    return pulls.fact_rows(bodies, _reading(spec, columns), RUN_TS)


def market_facts(spark, sf, *columns):
    return breakdown_facts(spark, sf, specs.AD_MARKET_FACT, "dma_code", *columns)


def ad_performance(spark, sf):
    return comparable(ad_facts(spark, sf))


def ad_group_performance(spark, sf):
    return comparable(pulls.fact_rows(R.ad_group_report(spark, sf), specs.AD_GROUP_FACT, RUN_TS))


def campaign_performance(spark, sf):
    return comparable(campaign_facts(spark, sf))


def ad_market_performance(spark, sf):
    return comparable(market_facts(spark, sf))


def ad_gender_performance(spark, sf):
    return comparable(breakdown_facts(spark, sf, specs.AD_GENDER_FACT, "gender"))


def ad_age_performance(spark, sf):
    return comparable(breakdown_facts(spark, sf, specs.AD_AGE_FACT, "age_bucket"))


def default_dates(spark, sf):
    """Absent dates become the window start; rows with problems are set aside."""
    good, _ = _order_rows(spark, sf)
    return good.select("ad_account_id", "ad_id", "stat_date", "impressions", "spend")


def quarantined_rows(spark, sf):
    """Bad rows with what is wrong with them and their raw texts."""
    _, bad = _order_rows(spark, sf)
    return bad.select(
        "ad_account_id", F.col("raw.AD_ID").alias("raw_ad_id"),
        F.col("raw.TOTAL_IMPRESSION").alias("raw_impressions"), "spend", checks.PROBLEMS,
    )


def _order_rows(spark, sf):
    records = landed.report_records(R.order_report(spark, sf), specs.AD_FACT)
    return checks.quarantine(flatten.typed(records, specs.AD_FACT, RUN_TS), specs.AD_FACT)


def unreadable_bodies(spark, sf):
    """Web pages and event properties as listing responses: a page is not JSON at all, the
    properties are an object without items."""
    pages = R.table(spark, sf, "pages").select(
        F.concat(F.lit("page "), F.col("page_id").cast("string")).alias("response"),
        F.col("html").alias("body"))
    events = R.table(spark, sf, "events").select(
        F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("response"),
        F.col("props").alias("body"))
    readable, unreadable = landed.split_unreadable(pages.unionByName(events), "listing")
    return unreadable.select("response", F.lit("unreadable").alias("verdict")).unionByName(
        readable.select("response", F.lit("readable").alias("verdict")))


def refused_run(spark, sf):
    """What a run is told whose responses are bad: web pages among reports of uneven quality.
    The table keeps the rows of the run before."""
    target = Target(path=run_dir(spark, "ad-performance"))
    good, _ = _order_rows(spark, sf)
    before = tables.upsert(good, target, specs.AD_FACT, check_duplicates=False).rows
    pages = R.table(spark, sf, "pages").select(
        F.col("page_id").cast("string").alias("ad_account_id"), F.lit(R.FIRST_DAY).alias("start_date"), F.col("html").alias("body"))
    problems = checks.Problems(specs.AD_FACT)
    rows = pulls.watched_fact_rows(R.order_report(spark, sf).unionByName(pages), specs.AD_FACT, RUN_TS, problems)
    try:
        tables.upsert(rows, target, specs.AD_FACT, accept=problems.refuse)
        found = []
    except checks.BadRows as refused:
        found = refused.problems
    kept = target.read(spark, specs.AD_FACT).agg(F.count(F.lit(1)).alias("rows_kept"))
    report = spark.createDataFrame([(p, n, e) for p, n, e in found], "problem string, n bigint, example string")
    return report.where("problem != 'unreadable response'").unionByName(
        report.where("problem = 'unreadable response'").withColumn("example", F.lit(None).cast("string"))) \
        .join(kept).withColumn("rows_before", F.lit(before).cast("bigint"))


def run_stamps(spark, sf):
    """The run's stamp in every row of a table, as Unix seconds."""
    return campaign_facts(spark, sf).groupBy("campaign_id", F.unix_seconds("ingested_at").alias("stamp")).agg(
        F.count(F.lit(1)).alias("n"))


# --- dimensions and reference --------------------------------------------------------


def campaign_dimension(spark, sf):
    rows = pulls.dimension_rows(R.campaign_pages(spark, sf), specs.CAMPAIGN_DIM, RUN_TS)
    return comparable(rows)


def ad_group_dimension(spark, sf):
    rows = pulls.dimension_rows(R.ad_group_pages(spark, sf), specs.AD_GROUP_DIM, RUN_TS)
    return comparable(rows)


def ad_dimension(spark, sf):
    return comparable(pulls.dimension_rows(R.ad_pages(spark, sf), specs.AD_DIM, RUN_TS))


def market_reference(spark, sf):
    """Fetched in full, table replaced, read back."""
    target = Target(path=run_dir(spark, "reference"))
    rows = pulls.reference_rows(R.market_options(spark, sf), RUN_TS)
    tables.replace(rows, target, specs.MARKET_REFERENCE)
    return comparable(target.read(spark, specs.MARKET_REFERENCE))


def options_last_wins(spark, sf):
    """Codes that repeat over pages and objects."""
    return comparable(pulls.reference_rows(R.customer_options(spark, sf), RUN_TS))


# --- listings, accounts, batches -----------------------------------------------------


def _discovered(spark, sf):
    return landed.listed_accounts(R.account_pages(spark, sf))


def account_discovery(spark, sf):
    return _discovered(spark, sf).select("ad_account_id")


def allowlist_visible(spark, sf):
    accounts, _ = resolve_accounts(_discovered(spark, sf), ALLOWLIST)
    return accounts.select(F.col("request_pos").cast("bigint").alias("request_pos"), "ad_account_id")


def allowlist_missing(spark, sf):
    _, missing = resolve_accounts(_discovered(spark, sf), ALLOWLIST)
    return missing.select("ad_account_id")


def entity_files(spark, sf):
    """Listing pages landed as one text file per response, read with their folder columns."""
    folder = run_dir(spark, "pages")
    pages = R.campaign_pages(spark, sf)
    pages.write.partitionBy("ad_account_id", "page_no").text(folder)
    files = landed.read_response_files(spark, folder, "ad_account_id string, page_no bigint")
    return landed.listed_items(files).select(
        "ad_account_id", "page_no", F.col("item_pos").cast("bigint").alias("item_pos"),
        values.json_field(F.col("item"), "$.id").alias("campaign_id"),
        values.json_field(F.col("item"), "$.name").alias("name"),
    )


def _ad_listing(spark, sf):
    return landed.listed_pages(R.ad_pages(spark, sf))


def listing_positions(spark, sf):
    return batching.page_positions(_ad_listing(spark, sf), "ad_id")


def request_batches(spark, sf):
    return batching.page_batches(_ad_listing(spark, sf), specs.AD_FACT.batch_size)


def report_requests(spark, sf):
    """The complete work list of a market breakdown run."""
    spec = specs.AD_MARKET_FACT
    batches = batching.page_batches(_ad_listing(spark, sf), spec.batch_size)
    return batching.report_requests(batches, spec, *window_of(spark, WINDOW_RUN))


BACKFILL = ("1995-01-01", "1999-12-31")
MAX_RECORDS, MARKETS = 50_000, 25


def sliced_requests(spark, sf):
    """The work list of a five-year backfill, cut so that a response stays near MAX_RECORDS."""
    spec = specs.AD_MARKET_FACT
    batches = batching.page_batches(_ad_listing(spark, sf), spec.batch_size)
    requests = batching.report_requests(batches, spec, *BACKFILL, max_records=MAX_RECORDS, values=MARKETS)
    return requests.select("ad_account_id", "batch_no", "start_date", "end_date", "ids")


def listing_ids(spark, sf):
    """Ids numbered within their listing, one row per id from the start."""
    ids = landed.listed_ids(R.ad_pages(spark, sf), "ad_id")
    return batching.listing_position(ids).select("ad_account_id", "ad_id", "listing_pos")


def accounts_with_entities(spark, sf):
    """Customers as accounts and their orders as entities: a customer without orders gets
    no request."""
    orders = R.table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("ad_account_id"), F.col("o_orderkey").alias("o"),
        F.struct(F.col("o_orderkey").cast("string").alias("id")).alias("obj"))
    pages = R.listing_pages(orders, "o", F.floor(F.col("o") / R.PAGE_KEYS))
    accounts = R.table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("ad_account_id"))
    known = landed.listed_pages(pages).join(accounts, "ad_account_id", "left_semi")
    batches = batching.page_batches(known, specs.CAMPAIGN_FACT.batch_size)
    return batches.groupBy("ad_account_id").agg(F.sum("n_ids").alias("n_ids"))


class PagedListing:
    """A caller's fetch: serves the pages that the work-list row carries, and answers the
    first call of a request with 429 or 503 for two requests in three."""

    def __init__(self):
        self.refused = set()

    def __call__(self, request: dict):
        campaign = request["campaign_id"]
        trouble = {0: (429, {"Retry-After": "0"}), 1: (503, {})}.get(int(campaign) % 3)
        if trouble and campaign not in self.refused:
            self.refused.add(campaign)
            return (*trouble, "try again")
        return 200, {}, request["pages"][int(request.get("bookmark", 0))]


def _paged_worklist(spark, sf) -> DataFrame:
    """One request per campaign, with the pages that its answers will be."""
    ads = R.entities(spark, sf, "ad_id").withColumn("page", F.floor(F.col("part") / 6))
    last = F.floor(F.lit(19) / 6)
    ids = F.concat_ws(",", F.expr("transform(sort_array(collect_list(ad_id)),"
                                  " i -> concat('{\"id\":\"', i, '\"}'))"))
    pages = ads.groupBy("ad_account_id", "campaign_id", "page").agg(ids.alias("ids"))
    everyone = pages.groupBy("ad_account_id", "campaign_id").agg(
        F.map_from_entries(F.collect_list(F.struct("page", "ids"))).alias("by_page"))
    bodies = F.transform(
        F.sequence(F.lit(0).cast("bigint"), last),
        lambda p: F.concat(
            F.lit('{"items":['), F.coalesce(F.element_at("by_page", p), F.lit("")), F.lit("]"),
            F.when(p < last, F.concat(F.lit(',"bookmark":"'), (p + 1).cast("string"), F.lit('"')))
            .otherwise(F.lit(',"bookmark":null')), F.lit("}")))
    return everyone.select("ad_account_id", "campaign_id", bodies.alias("pages"))


def paged_fetch(spark, sf):
    """Ads of each campaign requested page by page, with retries, on the executors."""
    _ship(spark)
    policy = RetryPolicy(first_wait=0)
    fetched = fetch_pages(_paged_worklist(spark, sf), PagedListing(), concurrency=8, policy=policy).drop("pages")
    listed = landed.listed_ids(fetched, "ad_id")
    return listed.select("ad_account_id", "campaign_id", "page_no",
                         F.col("item_pos").cast("bigint").alias("item_pos"), "ad_id")


class NumberedRun(PagedListing):
    """The same answers, each naming the run that asked."""

    def __init__(self, run: int):
        super().__init__()
        self.run = run

    def __call__(self, request: dict):
        status, headers, body = super().__call__(request)
        return status, headers, body.replace("{", f'{{"run":{self.run},', 1) if status == 200 else body


def resumed_fetch(spark, sf):
    """A run that ends after the even campaigns, and a second one over all of them into the
    same folder: which run asked for each page."""
    _ship(spark)
    worklist, folder, policy = _paged_worklist(spark, sf), run_dir(spark, "landing"), RetryPolicy(first_wait=0)
    land(worklist.where("campaign_id % 2 = 0"), NumberedRun(1), folder, policy=policy)
    pages = land(worklist, NumberedRun(2), folder, policy=policy)
    return pages.select("ad_account_id", "campaign_id", "page_no",
                        values.json_typed(F.col("body"), "$.run", "bigint").alias("asked_by_run"),
                        F.md5(F.concat_ws(",", values.json_struct(F.col("body"), "items array<struct<id:string>>")["items"]["id"]))
                        .alias("ids"))


@functools.cache
def _package_zip() -> str:
    root = Path(__file__).resolve().parent.parent
    stage = Path(tempfile.mkdtemp(prefix="adlake-zip-"))
    for package in ("adlake", "workload"):
        shutil.copytree(root / package, stage / "src" / package,
                        ignore=shutil.ignore_patterns("__pycache__"))
    return shutil.make_archive(str(stage / "adlake_package"), "zip", stage / "src")


def _ship(spark: SparkSession) -> None:
    """Make the packages importable for Python tasks."""
    spark.sparkContext.addPyFile(_package_zip())


# --- upsert --------------------------------------------------------------------------


def _revision(rows: DataFrame) -> DataFrame:
    """The 14-day window pulled again: revised spend, leads not delivered, ads ending in -7
    not returned."""
    window = in_window(F.col("stat_date"), *window_of(rows.sparkSession, WINDOW_RUN))
    kept = rows.filter(window & ~F.col("ad_id").endswith("-7"))
    return kept.withColumn("spend", F.col("spend") + 1000).withColumn(
        "leads", F.lit(None).cast("bigint"))


def _upserted(spark, sf, target: Target, second=tables.upsert):
    """The whole history loaded, then the window revised."""
    landed_rows = run_dir(spark, "facts")
    ad_facts(spark, sf).write.parquet(landed_rows)
    rows = spark.read.parquet(landed_rows)
    tables.upsert(rows, target, specs.AD_FACT)
    second(_revision(rows), target, specs.AD_FACT)
    return target.read(spark, specs.AD_FACT)


def _dies_and_is_finished(rows: DataFrame, target: Target, spec) -> None:
    """An upsert whose run ends when its days are written, and the next run's finish."""
    tables.stage_upsert(rows, target, spec)
    if tables.finish_upserts(rows.sparkSession, target) != 1:
        raise ValueError("nothing was left to finish")


def merge_upsert(spark, sf):
    return comparable(_upserted(spark, sf, Target(path=run_dir(spark, "ad-performance"))))


def _fresh_table(spark, label: str) -> Target:
    location = run_dir(spark, label)
    return Target(f"{label}_{location[-32:]}", location)


def merge_upsert_catalog(spark, sf):
    """The same through a catalog table."""
    return comparable(_upserted(spark, sf, _fresh_table(spark, "ad_performance")))


def upsert_finished(spark, sf):
    """A revision cut off before its switch, finished by the next run."""
    target = Target(path=run_dir(spark, "ad-performance"))
    return comparable(_upserted(spark, sf, target, _dies_and_is_finished))


def upsert_finished_catalog(spark, sf):
    """The same where partitions are pointed at their new folders."""
    return comparable(_upserted(spark, sf, _fresh_table(spark, "ad_performance"), _dies_and_is_finished))


def _history(spark, sf: str) -> Target:
    """The whole ad history as a day-partitioned table."""
    target = Target(path=run_dir(spark, "ad-history"))
    tables.upsert(ad_facts(spark, sf), target, specs.AD_FACT)
    return target


def lookback_window(spark, sf):
    """The default window of a run, read from the day-partitioned table."""
    rows = _history(spark, sf).read(spark, specs.AD_FACT)
    window = in_window(F.col("stat_date"), *window_of(spark, WINDOW_RUN))
    return rows.filter(window).select("ad_account_id", "ad_id", "stat_date", "spend")


def empty_pull(spark, sf):
    """A pull without rows leaves the table untouched."""
    target = _history(spark, sf)
    report = tables.upsert(ad_facts(spark, sf).filter(F.col("spend") < 0), target, specs.AD_FACT)
    return target.read(spark, specs.AD_FACT).groupBy("campaign_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(report.rows).cast("bigint").alias("written"))


def duplicate_keys(spark, sf):
    lines = R.table(spark, sf, "lineitem")
    return checks.duplicate_keys(lines, ["l_orderkey", "l_linenumber"])


def latest_per_key(spark, sf):
    lines = R.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("l_shipdate"),
        "l_extendedprice", "l_quantity", "l_partkey")
    return checks.latest_per_key(lines, ["l_orderkey", "l_linenumber"], "l_shipdate")


# --- replace -------------------------------------------------------------------------


def _campaign_rows(spark, sf):
    return pulls.dimension_rows(R.campaign_pages(spark, sf), specs.CAMPAIGN_DIM, RUN_TS)


def _remaining(rows: DataFrame) -> DataFrame:
    """Campaigns that still exist at the second pull: the active ones."""
    return rows.filter("status = 'ACTIVE'")


def _snapshot(spark, sf, target: Target):
    rows = _campaign_rows(spark, sf)
    tables.replace(rows, target, specs.CAMPAIGN_DIM)
    tables.replace(_remaining(rows), target, specs.CAMPAIGN_DIM)
    return target.read(spark, specs.CAMPAIGN_DIM).select("campaign_id", "ad_account_id", "name")


def snapshot_replace(spark, sf):
    """Deleted entities disappear."""
    return _snapshot(spark, sf, Target(path=run_dir(spark, "campaign-dim")))


def snapshot_replace_catalog(spark, sf):
    """The same by switching a catalog table to its new snapshot."""
    return _snapshot(spark, sf, Target(_fresh_table(spark, "campaign_dim").table))


def scoped_replace(spark, sf):
    """A run over two accounts replaces only theirs."""
    target = Target(path=run_dir(spark, "campaign-dim"))
    rows = _campaign_rows(spark, sf)
    tables.replace(rows, target, specs.CAMPAIGN_DIM)
    scope, _ = resolve_accounts(_discovered(spark, sf), ALLOWLIST)
    scope = scope.select("ad_account_id").distinct()
    pulled = _remaining(rows).join(scope, "ad_account_id", "left_semi")
    tables.replace(pulled, target, specs.CAMPAIGN_DIM, scope)
    return target.read(spark, specs.CAMPAIGN_DIM).select("campaign_id", "ad_account_id", "name")


def _dimension_parts(spark, sf, targets):
    pages = {"campaigns": R.campaign_pages, "ad_groups": R.ad_group_pages, "ads": R.ad_pages}
    return [(pulls.dimension_rows(pages[spec.endpoint](spark, sf), spec, RUN_TS), target, spec)
            for spec, target in zip(specs.DIMENSIONS, targets, strict=True)]


def _entities_written(spark, parts, written):
    found = [
        target.read(spark, spec).select(
            F.lit(spec.name).alias("table_name"), F.col(spec.key[0]).alias("entity_id"),
            F.lit(report.rows).cast("bigint").alias("rows_written"))
        for (_, target, spec), report in zip(parts, written)
    ]
    return functools.reduce(DataFrame.unionByName, found)


def staged_multi_replace(spark, sf):
    """Three dimension tables staged together, then switched; rows and ids of each."""
    parts = _dimension_parts(spark, sf, [Target(path=run_dir(spark, spec.name)) for spec in specs.DIMENSIONS])
    return _entities_written(spark, parts, tables.replace_all(parts))


def replace_finished(spark, sf):
    """Three tables staged by a run that ends there, and switched by the next one, which knows
    its name; one is a folder, two are in the catalog."""
    parts = _dimension_parts(spark, sf, [Target(path=run_dir(spark, "campaign-dim")), _fresh_table(spark, "ad_group_dim"),
                                         _fresh_table(spark, "ad_dim")])
    name = tables.stage_replace(parts)
    return _entities_written(spark, parts, tables.finish_replace(spark, name))


# --- reports -------------------------------------------------------------------------


def spend_per_ad_day(spark, sf):
    rows = breakdown_facts(spark, sf, specs.AD_GENDER_FACT, "gender")
    return reports.totals(rows, ["ad_account_id", "ad_id", "stat_date"], ["spend", "clicks"])


def market_named(spark, sf):
    reference = pulls.reference_rows(R.market_options(spark, sf), RUN_TS)
    named = reports.with_market_names(market_facts(spark, sf), reference)
    return named.select("ad_account_id", "ad_id", "stat_date", "dma_code", "dma_name", "spend")


def fact_with_campaign(spark, sf):
    dimension = _campaign_rows(spark, sf)
    joined = reports.with_entity(ad_facts(spark, sf), dimension, "campaign_id",
                                 {"name": "campaign_name", "objective_type": "objective"})
    return joined.select("ad_account_id", "ad_id", "campaign_id", "stat_date", "campaign_name",
                         "objective", "impressions")


def fact_with_names(spark, sf):
    """Ad facts beside the names of their ad and ad group."""
    groups = pulls.dimension_rows(R.ad_group_pages(spark, sf), specs.AD_GROUP_DIM, RUN_TS)
    ads = pulls.dimension_rows(R.ad_pages(spark, sf), specs.AD_DIM, RUN_TS)
    named = reports.with_entity(ad_facts(spark, sf), groups, "ad_group_id", {"name": "ad_group_name"})
    named = reports.with_entity(named, ads, "ad_id", {"name": "ad_name", "status": "ad_status"})
    return named.select("ad_account_id", "ad_id", "stat_date", "ad_group_name", "ad_name", "ad_status", "clicks")


def gender_age_reconcile(spark, sf):
    """Two breakdowns of the same traffic, each against its whole: what is left is 0."""
    keys, metrics = ["ad_account_id", "ad_id", "stat_date"], ["impressions", "spend"]
    whole = ad_facts(spark, sf, *keys, *metrics)
    found = [
        reports.reconcile(whole, breakdown_facts(spark, sf, spec, column, *keys, *metrics), keys, metrics)
        .groupBy("ad_account_id", "side").agg(F.count(F.lit(1)).alias("n"), F.sum("impressions_rest").alias("impressions_rest"),
                                              F.sum("spend_rest").alias("spend_rest"))
        .withColumn("breakdown", F.lit(column))
        for spec, column in ((specs.AD_GENDER_FACT, "gender"), (specs.AD_AGE_FACT, "age_bucket"))]
    return functools.reduce(DataFrame.unionByName, found)


def breakdown_reconcile(spark, sf):
    keys, metrics = ["ad_account_id", "ad_id", "stat_date"], ["impressions", "spend"]
    return reports.reconcile(ad_facts(spark, sf, *keys, *metrics), market_facts(spark, sf, *keys, *metrics), keys, metrics)


def level_reconcile(spark, sf):
    keys, metrics = ["ad_account_id", "campaign_id", "stat_date"], ["clicks", "conversions", "spend"]
    return reports.reconcile(campaign_facts(spark, sf, *keys, *metrics), ad_facts(spark, sf, *keys, *metrics), keys, metrics)


def stacked_breakdown(spark, sf):
    metrics = ["spend", "impressions"]
    stacked = reports.stack_breakdowns({
        kind: (breakdown_facts(spark, sf, spec, column, column, "campaign_id", *metrics), column)
        for kind, spec, column in (("GENDER", specs.AD_GENDER_FACT, "gender"), ("AGE_BUCKET", specs.AD_AGE_FACT, "age_bucket"))})
    keys = [reports.BREAKDOWN_TYPE, reports.BREAKDOWN_VALUE, "campaign_id"]
    return reports.totals(stacked, keys, metrics)


def rollup_ratios(spark, sf):
    return reports.rollup(ad_facts(spark, sf), ["campaign_id"])


def _crosswalk(spark, sf) -> DataFrame:
    """Two market taxonomies over nations: the other one counts from 100, one nation is
    unmapped, one is mapped twice."""
    nation = R.table(spark, sf, "nation")
    code = F.col("n_nationkey").cast("string").alias("dma_code")
    other = (F.col("n_nationkey") + 100).cast("string").alias("other_code")
    rows = nation.filter("n_name <> 'CHINA' and n_nationkey <> 4").select(
        code, other, F.concat(F.lit("region "), F.col("n_regionkey").cast("string")).alias("market"))
    twice = nation.filter("n_nationkey = 7").select(code, other, F.lit("region x").alias("market"))
    return rows.unionByName(twice)


def market_crosswalk(spark, sf):
    """Totals of both taxonomies per common market."""
    clean = _crosswalk(spark, sf).filter("market <> 'region x'")
    other = R.table(spark, sf, "orders").join(
        R.table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")
    ).select((F.col("c_nationkey") + 100).cast("string").alias("other_code"),
             F.col("o_totalprice").alias("spend"), F.lit(1).cast("bigint").alias("clicks"))
    return reports.by_common_market(market_facts(spark, sf), other, clean, ["spend", "clicks"])


def crosswalk_problems(spark, sf):
    return reports.crosswalk_problems(market_facts(spark, sf), _crosswalk(spark, sf), "dma_code")


def run_counts(spark, sf):
    return reports.run_counts(ad_facts(spark, sf), "ad_id")


# --- scalar functions ----------------------------------------------------------------


def json_access(spark, sf):
    props = F.col("props")
    return R.table(spark, sf, "events").select(
        "event_id", values.json_field(props, "$.k").alias("k_text"),
        values.json_typed(props, "$.k", "bigint").alias("k"),
        values.json_field(props, "$.absent").alias("absent"))


def _group_rows(spark, sf):
    return pulls.dimension_rows(R.ad_group_pages(spark, sf), specs.AD_GROUP_DIM, RUN_TS)


def json_list_rows(spark, sf):
    """Elements of a JSON list column as rows."""
    ads = pulls.dimension_rows(R.ad_pages(spark, sf), specs.AD_DIM, RUN_TS)
    return variants.element_rows(ads, "carting_products_json", ["ad_id"],
                                 {"product": ("$.b", "bigint"), "kind": ("$.a", "string"), "absent": ("$.c", "string")})


JSON_COLUMNS = ["promotion_ids_json", "targeting_spec_json", "dca_assets_json", "ext_features_json"]


def json_shapes(spark, sf):
    """What the JSON columns of a table hold."""
    return variants.shapes(_group_rows(spark, sf), JSON_COLUMNS)


def json_changed_shapes(spark, sf):
    """Columns whose shape differs between two pulls: the second one has its promotions as text
    and no assets any more."""
    before = _group_rows(spark, sf)
    after = before.withColumn("promotion_ids_json", F.regexp_replace("promotion_ids_json", r"(\d+)", '"$1"')).withColumn(
        "dca_assets_json", F.lit(None).cast("string"))
    return variants.changed_shapes(before, after, JSON_COLUMNS)


def json_structs(spark, sf):
    """A JSON column read with a schema of the caller's choice."""
    spec = values.json_struct(F.col("targeting_spec_json"), "geo array<string>, b struct<z: bigint>")
    return _group_rows(spark, sf).select("ad_group_id", F.element_at(spec["geo"], 1).alias("geo"), spec["b"]["z"].alias("z"))


def unix_times(spark, sf):
    """Seconds as they arrive, to a timestamp, and back."""
    seconds = R.unix("ts")
    stamp = values.unix_time(seconds.cast("string"))
    return R.table(spark, sf, "events").select(
        "event_id", F.unix_seconds(stamp).alias("seconds"),
        F.unix_micros(values.unix_time(F.concat(seconds.cast("string"), F.lit(".5")))).alias("micros"))


def number_casts(spark, sf):
    """Delivered numbers as text: counts are truncated, words are not numbers."""
    value = F.col("value").cast("decimal(18,4)").cast("string")
    return R.table(spark, sf, "events").select(
        "event_id", values.to_long(value).alias("as_long"),
        values.to_long(F.concat(F.lit("-"), value)).alias("as_negative"),
        values.to_double(value).alias("as_double"), values.to_long(F.col("event_type")).alias("word"))


def csv_lists(spark, sf):
    """Texts as comma-separated lists: trimmed, blanks dropped, joined again."""
    items = lists.csv_items(F.col("text"))
    return R.table(spark, sf, "documents").select(
        "doc_id", F.size(items).cast("bigint").alias("n_items"), F.md5(lists.csv_text(items)).alias("joined"))


def date_windows(spark, sf):
    """Every order as a run: explicit pair, half a pair, a lookback of 0 or 7, the default."""
    kind = F.col("o_orderkey") % 5
    day = F.col("o_orderdate").cast("date")
    first, last = window_columns(
        day, F.when(kind == 0, "0").when(kind == 1, "7").otherwise(F.lit("")),
        F.when(kind.isin(2, 3), F.lit("2000-01-01")), F.when(kind == 2, F.lit("2000-01-31")))
    return R.table(spark, sf, "orders").select("o_orderkey", first.alias("first_day"), last.alias("last_day"))


# --- stream --------------------------------------------------------------------------


def _stream(spark, sf, lookback: str):
    """Two pulls landed, the second revising the window, streamed into one table."""
    landing, check = run_dir(spark, "landing"), run_dir(spark, "stream-checkpoint")
    target = Target(path=run_dir(spark, "campaign-performance"))
    first = R.campaign_report(spark, sf).withColumn(PULL, F.lit(1).cast("bigint"))
    revised = campaign_facts(spark, sf).filter(in_window(F.col("stat_date"), *window_of(spark, WINDOW_RUN)))
    record = F.struct(
        F.col("stat_date").cast("string").alias("DATE"), F.col("campaign_id").alias("CAMPAIGN_ID"),
        (F.col("spend") + 1000).alias("SPEND_IN_DOLLAR"))
    second = revised.groupBy("ad_account_id", "campaign_id").agg(F.collect_list(record).alias("r")).select(
        "ad_account_id", F.lit(R.FIRST_DAY).alias("start_date"), F.to_json("r").alias("body"),
        F.lit(2).cast("bigint").alias(PULL))
    both = first.unionByName(second)
    both.select(*[c.split()[0] for c in LANDED_SCHEMA.split(", ")]).write.options(**landed.BODY_FILES).parquet(landing)
    report = StreamReport()
    query = stream_revisions(spark, landing, target, specs.CAMPAIGN_FACT, checkpoint=check,
                             run_date=WINDOW_RUN, run_ts=RUN_TS, lookback=lookback, report=report)
    query.awaitTermination()
    return target.read(spark, specs.CAMPAIGN_FACT), report


def stream_upsert(spark, sf):
    rows, _ = _stream(spark, sf, "20000")
    return rows.select("ad_account_id", "campaign_id", "campaign_name", "stat_date", "spend", "clicks")


def stream_late_rows(spark, sf):
    """A lookback of 1,000 days: what is older is dropped and counted."""
    rows, report = _stream(spark, sf, "1000")
    return rows.agg(
        F.count(F.lit(1)).alias("kept"), F.min("stat_date").alias("first_day"),
        F.lit(report.late).cast("bigint").alias("late"))


def _diverted(spark, sf):
    """Order reports and web pages as two batches of a stream, the first one replayed."""
    target, sidings = Target(path=run_dir(spark, "ad-performance")), Sidings(run_dir(spark, "sidings"))
    pull = F.lit(1).cast("bigint").alias(PULL)
    reports_ = R.order_report(spark, sf).select("ad_account_id", "start_date", pull, "body")
    pages = R.table(spark, sf, "pages").select(
        F.col("page_id").cast("string").alias("ad_account_id"), F.lit(R.FIRST_DAY).alias("start_date"), pull, F.col("html").alias("body"))
    for number, batch in ((0, reports_), (1, pages), (0, reports_)):
        divert_batch(batch, number, target, specs.AD_FACT, sidings, first_day="1998-01-01", run_ts=RUN_TS)
    return target, sidings


def stream_quarantine(spark, sf):
    """Bad rows of a stream, set aside with what is wrong with them; each once."""
    _, sidings = _diverted(spark, sf)
    return sidings.bad_rows(spark, specs.AD_FACT).select(
        "ad_account_id", F.col("raw.AD_ID").alias("raw_ad_id"),
        F.col("raw.TOTAL_IMPRESSION").alias("raw_impressions"), "spend", checks.PROBLEMS)


def stream_ledger(spark, sf):
    """The account of a stream's batches, and the rows its table has."""
    target, sidings = _diverted(spark, sf)
    held = target.read(spark, specs.AD_FACT).agg(F.count(F.lit(1)).alias("held"))
    return sidings.ledger(spark).select("batch_id", "rows", "late", "bad", "unreadable").join(held)


QUERIES = {
    f.__name__: f
    for f in (
        ad_performance, ad_group_performance, campaign_performance, ad_market_performance,
        ad_gender_performance, ad_age_performance, default_dates, quarantined_rows,
        unreadable_bodies, campaign_dimension, ad_group_dimension, ad_dimension,
        market_reference, options_last_wins, account_discovery, allowlist_visible,
        allowlist_missing, entity_files, listing_positions, request_batches, report_requests,
        accounts_with_entities, paged_fetch, merge_upsert, merge_upsert_catalog,
        lookback_window, empty_pull, duplicate_keys, latest_per_key, snapshot_replace,
        snapshot_replace_catalog, scoped_replace, staged_multi_replace, spend_per_ad_day,
        market_named, fact_with_campaign, breakdown_reconcile, level_reconcile,
        stacked_breakdown, rollup_ratios, market_crosswalk, crosswalk_problems, run_counts,
        json_access, unix_times, number_casts, csv_lists, date_windows, stream_upsert,
        stream_late_rows, resumed_fetch, sliced_requests, listing_ids, upsert_finished, upsert_finished_catalog,
        replace_finished, refused_run, run_stamps, fact_with_names, gender_age_reconcile, json_list_rows, json_shapes,
        json_changed_shapes, json_structs, stream_quarantine, stream_ledger,
    )
}
