"""The test tables rendered as API responses.

account = supplier's nation, campaign = supplier, ad group = supplier and part mod 5,
ad = ad group and part mod 20, day = ship date, gender = return flag, age bucket = line
number, market = the customer's nation. Every response is bounded by what it covers: one
ad group, ad or campaign with one record per day (and breakdown value), or one page of a
key range, so no key can make a body grow with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.functions.values import MAX_UNIX, MIN_UNIX

FIRST_DAY = "1990-01-01"  # window start of the rendered requests
PAGE_KEYS = 100           # keys per rendered page


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _str(column: str) -> Column:
    return F.col(column).cast("string")


def ads_base(spark: SparkSession, sf_dir: str, per: str) -> DataFrame:
    """One row per line item with the ids and values the responses are built from, dealt out by
    account and ``per``, the campaign or ad group. A response covers one of them or a part, so
    sums and responses need no further shuffle. What is dealt out is the line items' own narrow
    columns; orders meet their customers first, so that line items move once for both."""
    lines = table(spark, sf_dir, "lineitem")
    supplier = table(spark, sf_dir, "supplier")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    owned = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    account, campaign = _str("s_nationkey"), _str("l_suppkey")
    group = F.concat_ws("-", campaign, (F.col("l_partkey") % 5).cast("string"))
    return (
        lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(owned, F.col("l_orderkey") == F.col("o_orderkey"))
        .repartition(account, {"campaign_id": campaign, "ad_group_id": group}[per])
        .select(
            account.alias("ad_account_id"),
            campaign.alias("campaign_id"),
            group.alias("ad_group_id"),
            F.concat_ws("-", group, (F.col("l_partkey") % 20).cast("string")).alias("ad_id"),
            F.col("l_shipdate").cast("date").alias("stat_date"),
            F.col("l_returnflag").alias("gender"),
            _str("l_linenumber").alias("age_bucket"),
            _str("c_nationkey").alias("dma_code"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("amt"),
            F.col("l_quantity").cast("bigint").alias("qty"),
            F.col("l_linenumber").cast("bigint").alias("line"),
            (F.col("l_returnflag") == "R").cast("bigint").alias("is_lead"),
            (F.col("l_linestatus") == "F").cast("bigint").alias("is_conv"),
            F.col("s_name").alias("campaign_name"),
            F.when(F.col("s_acctbal") < 0, "PAUSED").otherwise("ACTIVE").alias("status"),
            F.when(F.col("s_nationkey") % 2 == 0, "AWARENESS").otherwise("CONVERSIONS")
            .alias("objective"),
        )
    )


def _metrics(base: DataFrame, keys: list[str]) -> DataFrame:
    """Raw metric values per key, under the API's names."""
    def played(upto: int) -> Column:
        return F.sum(F.when(F.col("line") <= upto, F.col("qty")).otherwise(0))

    sums = base.groupBy(*keys).agg(
        F.sum("amt").cast("double").alias("SPEND_IN_DOLLAR"),
        F.sum("qty").alias("TOTAL_IMPRESSION"),
        F.count(F.lit(1)).alias("TOTAL_CLICKTHROUGH"),
        F.sum("line").cast("double").alias("TOTAL_ENGAGEMENT"),   # arrives as 12.0
        F.sum("is_conv").alias("TOTAL_CONVERSIONS"),
        F.sum("is_lead").cast("string").alias("LEADS"),           # arrives as text
        F.sum("qty").alias("TOTAL_VIDEO_P0_COMBINED"),
        played(5).alias("TOTAL_VIDEO_P25_COMBINED"),
        played(4).alias("TOTAL_VIDEO_P50_COMBINED"),
        played(3).alias("TOTAL_VIDEO_P75_COMBINED"),
        played(2).alias("TOTAL_VIDEO_P100_COMPLETE"),
    )
    spend, shown = F.col("SPEND_IN_DOLLAR"), F.nullif("TOTAL_IMPRESSION", F.lit(0))
    clicks, leads = F.col("TOTAL_CLICKTHROUGH"), F.col("LEADS").cast("double")
    return sums.select(
        "*",
        F.when(leads != 0, spend / leads).alias("COST_PER_LEAD"),  # absent without leads
        (spend / clicks).alias("ECPC_IN_DOLLAR"),
        (spend / shown * 1000).alias("CPM_IN_DOLLAR"),
        (clicks.cast("double") / shown).alias("CTR"),
    )


_METRIC_NAMES = [
    "SPEND_IN_DOLLAR", "TOTAL_IMPRESSION", "TOTAL_CLICKTHROUGH", "TOTAL_ENGAGEMENT",
    "TOTAL_CONVERSIONS", "LEADS", "COST_PER_LEAD", "ECPC_IN_DOLLAR", "CPM_IN_DOLLAR", "CTR",
    "TOTAL_VIDEO_P0_COMBINED", "TOTAL_VIDEO_P25_COMBINED", "TOTAL_VIDEO_P50_COMBINED",
    "TOTAL_VIDEO_P75_COMBINED", "TOTAL_VIDEO_P100_COMPLETE",
]


def _record(ids: dict[str, str]) -> Column:
    """One flat record. The payload's own account is wrong on purpose: the request wins."""
    fields = [_str("stat_date").alias("DATE"), F.lit("payload").alias("AD_ACCOUNT_ID")]
    fields += [F.col(c).alias(raw) for raw, c in ids.items()]
    return F.struct(*fields, *_METRIC_NAMES)


def _bodies(records: DataFrame, keys: list[str], body: Column) -> DataFrame:
    grouped = records.groupBy("ad_account_id", *keys).agg(F.collect_list("rec").alias("recs"))
    return grouped.select("ad_account_id", F.lit(FIRST_DAY).alias("start_date"),
                          F.to_json(body).alias("body"))


def report(base: DataFrame, ids: dict[str, str], response_key: str) -> DataFrame:
    """Report responses: one per ``response_key``, one record per entity and day."""
    sums = _metrics(base, ["ad_account_id", *ids.values(), "stat_date"])
    records = sums.select("ad_account_id", response_key, _record(ids).alias("rec"))
    return _bodies(records, [response_key], F.col("recs"))


AD_IDS = {"AD_ID": "ad_id", "AD_GROUP_ID": "ad_group_id", "CAMPAIGN_ID": "campaign_id"}
AD_GROUP_IDS = {
    "AD_GROUP_ID": "ad_group_id", "CAMPAIGN_ID": "campaign_id",
    "AD_GROUP_NAME": "ad_group_name", "AD_GROUP_ENTITY_STATUS": "status",
}
CAMPAIGN_IDS = {
    "CAMPAIGN_ID": "campaign_id", "CAMPAIGN_NAME": "campaign_name",
    "CAMPAIGN_ENTITY_STATUS": "status", "CAMPAIGN_OBJECTIVE_TYPE": "objective",
}


def ad_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(ads_base(spark, sf_dir, "ad_group_id"), AD_IDS, "ad_group_id")


def ad_group_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = F.concat(F.lit("Group "), "ad_group_id")
    base = ads_base(spark, sf_dir, "campaign_id").withColumn("ad_group_name", named)
    return report(base, AD_GROUP_IDS, "campaign_id")


def campaign_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(ads_base(spark, sf_dir, "campaign_id"), CAMPAIGN_IDS, "campaign_id")


def ad_breakdown(spark: SparkSession, sf_dir: str, column: str, kind: str) -> DataFrame:
    """Breakdown responses: one per ad, the value beside the metrics object."""
    base = ads_base(spark, sf_dir, "ad_group_id")
    sums = _metrics(base, ["ad_account_id", *AD_IDS.values(), "stat_date", column])
    rec = F.struct(F.lit(kind).alias("targeting_type"), F.col(column).alias("targeting_value"),
                   _record(AD_IDS).alias("metrics"))
    records = sums.select("ad_account_id", "ad_group_id", "ad_id", rec.alias("rec"))
    return _bodies(records, ["ad_group_id", "ad_id"], F.struct(F.col("recs").alias("data")))


# --- listings ------------------------------------------------------------------------


def listing_pages(items: DataFrame, order: str, page_key: Column) -> DataFrame:
    """Listing pages per account: items in ``order``, pages numbered by a key range. ``items``
    has the account, the ``order`` column and the object as struct ``obj``."""
    paged = items.select("ad_account_id", page_key.cast("bigint").alias("page_no"),
                         F.struct(F.col(order).alias("o"), F.col("obj")).alias("rec"))
    pages = paged.groupBy("ad_account_id", "page_no").agg(F.collect_list("rec").alias("recs"))
    body = F.struct(F.expr("sort_array(recs).obj").alias("items"),
                    _str("page_no").alias("bookmark"))
    return pages.select("ad_account_id", "page_no", F.to_json(body).alias("body"))


def unix(stamp: str) -> Column:
    """Seconds since 1970 of a timestamp without zone, whatever the session zone."""
    return F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {stamp})")


def _supplier_page() -> Column:
    return F.floor(F.col("s_suppkey") / PAGE_KEYS)


def account_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account listing: every nation that has suppliers."""
    nations = table(spark, sf_dir, "supplier").select("s_nationkey").distinct()
    items = nations.select(F.lit("token").alias("ad_account_id"), "s_nationkey",
                           F.struct(_str("s_nationkey").alias("id")).alias("obj"))
    return listing_pages(items, "s_nationkey", F.floor(F.col("s_nationkey") / PAGE_KEYS))


def campaign_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance = F.col("s_acctbal")
    created = F.try_multiply("s_suppkey", F.lit(86400))
    obj = F.struct(
        F.col("s_suppkey").alias("id"),  # a number: the table wants its digits
        F.col("s_name").alias("name"),
        F.when(F.col("s_nationkey") % 2 == 0, "AWARENESS").otherwise("CONVERSIONS")
        .alias("objective_type"),
        F.when(balance < 0, "PAUSED").otherwise("ACTIVE").alias("status"),
        # a product beyond a bigint, a time beyond the year 9999: not delivered, as the table
        # could not hold it (the lifetime cap from key 1024 on)
        F.when(balance >= 0, F.try_multiply("s_suppkey", F.lit(1000000))).alias("daily_spend_cap"),
        F.try_multiply("s_suppkey", F.lit(9007199254740993)).alias("lifetime_spend_cap"),
        (balance >= 0).alias("is_automated_campaign"),
        (F.col("s_suppkey") % 3 == 0).alias("is_carting"),
        F.when(created.between(MIN_UNIX, MAX_UNIX), created).alias("created_time"),
        F.lit(0).alias("start_time"),
        F.struct(F.struct(F.col("s_nationkey").alias("z"), F.lit(2.0).alias("a")).alias("caps"))
        .alias("bid_options"),
        F.array(F.col("s_name"), F.lit("u")).alias("tracking_urls"),
    )
    items = table(spark, sf_dir, "supplier").select(
        _str("s_nationkey").alias("ad_account_id"), "s_suppkey", obj.alias("obj"))
    return listing_pages(items, "s_suppkey", _supplier_page())


def entities(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    """One row per ad group or ad seen in the line items, with the span of its days."""
    lines, supplier = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "supplier")
    group, ad = F.col("l_partkey") % 5, F.col("l_partkey") % 20
    part = {"ad_group_id": group, "ad_id": ad}[key]
    joined = lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    group_id = F.concat_ws("-", _str("l_suppkey"), (F.col("part") % 5).cast("string"))
    entity = joined.groupBy("s_nationkey", "l_suppkey", part.alias("part")).agg(
        F.min("l_shipdate").alias("first_day"), F.max("l_shipdate").alias("last_day"),
        F.count(F.lit(1)).alias("n"), F.min("l_partkey").alias("min_part"),
        F.max("l_partkey").alias("max_part"),
    )
    return entity.select(
        _str("s_nationkey").alias("ad_account_id"), F.col("l_suppkey").alias("s_suppkey"), "part",
        group_id.alias("ad_group_id"),
        F.concat_ws("-", group_id, _str("part")).alias("ad_id"),
        _str("l_suppkey").alias("campaign_id"),
        "first_day", "last_day", "n", "min_part", "max_part",
    )


def ad_group_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad group listing: one page per campaign."""
    rows = entities(spark, sf_dir, "ad_group_id")
    odd = F.col("part") % 2 == 1
    obj = F.struct(
        F.col("ad_group_id").alias("id"), "campaign_id",
        F.concat(F.lit("Group "), "ad_group_id").alias("name"),
        _str("min_part").alias("customer_segment_id"),
        F.col("n").alias("bid_in_micro_currency"),
        (F.col("n") + 0.75).alias("budget_in_micro_currency"),  # truncated on the way in
        F.col("part").cast("int").alias("bid_multiplier"),      # a whole number for a double
        (F.col("n") / 4).alias("local_inventory_radius_in_miles"),
        odd.alias("is_creative_optimization"),
        unix("first_day").alias("created_time"), unix("last_day").alias("updated_time"),
        F.when(odd, F.concat(F.lit('{"note":"'), "ad_group_id", F.lit('"}'))).alias("dca_assets"),
        F.array("min_part", "max_part").alias("promotion_ids"),
        F.struct(F.array("campaign_id").alias("geo"), F.struct(F.col("n").alias("z")).alias("b"))
        .alias("targeting_spec"),
    )
    return listing_pages(rows.withColumn("obj", obj), "part", F.col("s_suppkey"))


def ad_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad listing: one page per campaign."""
    rows = entities(spark, sf_dir, "ad_id")
    obj = F.struct(
        F.col("ad_id").alias("id"), "ad_group_id", "campaign_id",
        F.col("min_part").alias("pin_id"),
        F.concat(F.lit("Ad \""), "ad_id", F.lit("\" é")).alias("name"),
        F.when(F.col("n") > 30, "ACTIVE").alias("status"),
        F.concat(F.lit("https://example.com/"), _str("max_part")).alias("destination_url"),
        (F.col("part") % 2 == 0).alias("is_carting"), F.lit(False).alias("is_pin_deleted"),
        unix("first_day").alias("created_time"), unix("last_day").alias("updated_time"),
        F.expr("array()").cast("array<string>").alias("rejected_reasons"),
        F.struct(F.col("n").alias("k")).alias("quiz_pin_data"),
        F.array(F.struct(F.col("max_part").alias("b"), F.lit("x").alias("a")))
        .alias("carting_products"),
    )
    return listing_pages(rows.withColumn("obj", obj), "part", F.col("s_suppkey"))


def market_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The code-to-name response: nations, 25 rows whatever the scale."""
    entry = F.create_map(_str("n_nationkey"), F.col("n_name"))
    nations = table(spark, sf_dir, "nation").agg(F.collect_list(entry).alias("objects"))
    return nations.select(F.to_json("objects").alias("body"))


def customer_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes repeated over pages and objects: nation to customer name, in customer order."""
    entry = F.struct("c_custkey", F.create_map(_str("c_nationkey"), F.col("c_name")).alias("m"))
    page = F.floor(F.col("c_custkey") / PAGE_KEYS).alias("page_no")
    pairs = F.struct("c_custkey", _str("c_nationkey").alias("code"), F.col("c_name").alias("name"))
    pages = table(spark, sf_dir, "customer").groupBy(page).agg(F.collect_list(pairs).alias("pairs"))
    objects = F.transform(F.sort_array("pairs"), lambda p: F.create_map(p["code"], p["name"]))
    return pages.select("page_no", F.to_json(objects).alias("body"))


def order_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report responses of uneven quality, from orders: the date is absent for status O and
    null for P; the id is absent for one priority; a count is not a number for another."""
    text = F.to_json(F.struct(
        F.when(F.col("o_orderpriority") != "1-URGENT", _str("o_orderkey")).alias("AD_ID"),
        F.col("o_totalprice").alias("SPEND_IN_DOLLAR"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("n/a"))
        .otherwise(_str("o_custkey")).alias("TOTAL_IMPRESSION"),
        F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("DATE"),
    ))
    null_date = F.regexp_replace(text, r"\}$", ',"DATE":null}')
    record = F.when(F.col("o_orderstatus") == "P", null_date).otherwise(text)
    account = F.floor(F.col("o_orderkey") / PAGE_KEYS).cast("string").alias("ad_account_id")
    bodies = table(spark, sf_dir, "orders").groupBy(account).agg(
        F.concat(F.lit("["), F.array_join(F.collect_list(record), ","), F.lit("]")).alias("body"))
    return bodies.select("ad_account_id", F.lit("2020-02-02").alias("start_date"), "body")
