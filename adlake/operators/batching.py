"""Listed ids to request batches: the work list for ``paged.fetch_pages``.

Batches are consecutive in listing order, at most N ids each. Numbering an account's ids
by one window would put all of a large account into one task. Instead the page sizes are
summed up, first over blocks of pages and then within each block; an id's position is the
start of its page plus its place on the page. The largest group any task sees is one
block of pages, or one account's block totals (its ids / 100,000).

While they are numbered pages are rows, their ids an array (``landed.listed_pages``): a
listing is read and dealt once, and ids appear only when their page's start is known.

Windows of any length are requested in slices of whole days, so that one response stays
near a given number of records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlake.functions.lists import csv_text
from adlake.operators.accounts import ACCOUNT
from adlake.sources.landed import IDS, ITEM_POS, PAGE_NO
from adlake.specs import GRANULARITY, PAGE_SIZE, TableSpec

BLOCK_PAGES = 1000


def _running_start(frame: DataFrame, keys: list[str], order: str, size: str, name: str) -> DataFrame:
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return frame.withColumn(name, F.coalesce(F.sum(size).over(before), F.lit(0)))


def listing_position(ids: DataFrame, block_pages: int = BLOCK_PAGES) -> DataFrame:
    """Add ``listing_pos``, the 0-based place of each id in its account's listing.

    ``ids`` has account, ``page_no`` and ``item_pos`` (0, 1, ... on each page).
    """
    block = F.floor(F.col(PAGE_NO) / block_pages).alias("_block")
    sizes = ids.groupBy(ACCOUNT, PAGE_NO).agg(F.count(F.lit(1)).alias("_n"))
    sizes = sizes.select(ACCOUNT, PAGE_NO, block, "_n")
    totals = sizes.groupBy(ACCOUNT, "_block").agg(F.sum("_n").alias("_total"))
    totals = _running_start(totals, [ACCOUNT], "_block", "_total", "_block_start")
    starts = _running_start(sizes, [ACCOUNT, "_block"], PAGE_NO, "_n", "_page_start")
    starts = starts.join(totals, [ACCOUNT, "_block"]).select(
        ACCOUNT, PAGE_NO, (F.col("_block_start") + F.col("_page_start")).alias("_start")
    )
    placed = ids.join(starts, [ACCOUNT, PAGE_NO])
    return placed.withColumn("listing_pos", F.col("_start") + F.col(ITEM_POS)).drop("_start")


def page_starts(pages: DataFrame, block_pages: int = BLOCK_PAGES) -> DataFrame:
    """Pages (account, ``page_no``, ``ids``) with the listing position of their first id.

    Both sums read the same exchange, so pages are parsed and dealt once. For that the two
    sides must stay alike down to it: the totals use every column that the pages carry, and
    the join is null-safe, as a plain one would put filters on nulls below the exchange.
    """
    block = F.floor(F.col(PAGE_NO) / block_pages).alias("_block")
    dealt = pages.select(ACCOUNT, PAGE_NO, IDS, block).repartition(ACCOUNT, "_block")
    totals = dealt.groupBy(ACCOUNT, "_block").agg(F.sum(F.size(IDS)).alias("_total"), F.max(PAGE_NO).alias("_last"))
    totals = _running_start(totals, [ACCOUNT], "_last", "_total", "_block_start")
    totals = totals.select(F.col(ACCOUNT).alias("_account"), F.col("_block").alias("_of"), "_block_start")
    sized = dealt.withColumn("_n", F.size(IDS))
    starts = _running_start(sized, [ACCOUNT, "_block"], PAGE_NO, "_n", "_page_start")
    placed = starts.join(totals, F.col(ACCOUNT).eqNullSafe(F.col("_account")) & F.col("_block").eqNullSafe(F.col("_of")))
    return placed.select(ACCOUNT, PAGE_NO, IDS, (F.col("_block_start") + F.col("_page_start")).alias("start"))


def page_positions(pages: DataFrame, id_column: str, block_pages: int = BLOCK_PAGES) -> DataFrame:
    """(account, id, ``listing_pos``) of all ids on ``pages``."""
    placed = page_starts(pages, block_pages).select(ACCOUNT, "start", F.posexplode(IDS).alias("_pos", id_column))
    return placed.select(ACCOUNT, id_column, (F.col("start") + F.col("_pos")).alias("listing_pos"))


def page_batches(pages: DataFrame, size: int, block_pages: int = BLOCK_PAGES) -> DataFrame:
    """``request_batches`` of the ids on ``pages``."""
    return _batches(page_positions(pages, "id", block_pages), "id", size)


def request_batches(ids: DataFrame, id_column: str, size: int,
                    block_pages: int = BLOCK_PAGES) -> DataFrame:
    """One row per request: account, ``batch_no``, ``n_ids`` and the ids as one CSV text."""
    return _batches(listing_position(ids, block_pages), id_column, size)


def _batches(placed: DataFrame, id_column: str, size: int) -> DataFrame:
    number = F.floor(F.col("listing_pos") / size).alias("batch_no")
    entry = F.struct("listing_pos", F.col(id_column).alias("id"))
    batches = placed.select(ACCOUNT, number, entry.alias("_entry")).groupBy(ACCOUNT, "batch_no").agg(
        F.sort_array(F.collect_list("_entry")).alias("_entries")  # at most `size` entries
    )
    return batches.select(
        ACCOUNT, "batch_no", F.size("_entries").cast("bigint").alias("n_ids"),
        csv_text(F.col("_entries.id")).alias("ids"),
    )


def days_per_request(n_ids: Column, values: int, max_records: int) -> Column:
    """Whole days whose records, one per id, day and breakdown value, stay within
    ``max_records``; at least one day."""
    return F.greatest(F.lit(1), F.floor(F.lit(max_records) / (n_ids * values)))


def report_requests(batches: DataFrame, spec: TableSpec, start: str, end: str, *,
                    max_records: int | None = None, values: int = 1) -> DataFrame:
    """The work list: request parameters beside each batch.

    With ``max_records`` a batch asks for the window in consecutive slices of whole days, each
    expected to bring at most that many records (``values``: of the breakdown, per id and day;
    a single day is never cut). Slices of one batch do not overlap and cover the window.
    """
    path = "analytics" if spec.targeting_type is None else "targeting_analytics"
    first, last = F.lit(start), F.lit(end)
    if max_records is not None:
        window = F.datediff(last.cast("date"), first.cast("date")) + 1
        days = F.least(days_per_request(F.col("n_ids"), values, max_records), window).cast("int")
        span = F.sequence(first.cast("date"), last.cast("date"), F.make_dt_interval(days))
        batches = batches.where(first.cast("date") <= last.cast("date")).select("*", days.alias("_days"), F.explode(span).alias("_first"))
        first = F.col("_first").cast("string")
        last = F.least(F.date_add("_first", F.col("_days") - 1), F.lit(end).cast("date")).cast("string")
    return batches.select(
        ACCOUNT, "batch_no",
        F.lit(f"{spec.endpoint}/{path}").alias("path"),
        F.lit(spec.id_param).alias("id_param"), "ids",
        first.alias("start_date"), last.alias("end_date"),
        F.lit(GRANULARITY).alias("granularity"),
        F.lit(",".join(spec.requested)).alias("columns"),
        F.lit(spec.targeting_type).cast("string").alias("targeting_types"),
    )


def listing_requests(accounts: DataFrame, endpoint: str) -> DataFrame:
    """One listing per account. An account asked for twice is listed once."""
    return accounts.select(ACCOUNT).distinct().select(
        ACCOUNT, F.lit(endpoint).alias("path"), F.lit(PAGE_SIZE).cast("bigint").alias("page_size")
    )
