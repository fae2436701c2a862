"""The same results in SQL, over the given tables only."""

from __future__ import annotations

_BASE = """ads_base as (
  select cast(s_nationkey as varchar) as ad_account_id, cast(l_suppkey as varchar) as campaign_id,
         cast(l_suppkey as varchar) || '-' || cast(l_partkey % 5 as varchar) as ad_group_id,
         cast(l_suppkey as varchar) || '-' || cast(l_partkey % 5 as varchar)
           || '-' || cast(l_partkey % 20 as varchar) as ad_id,
         cast(l_shipdate as date) as stat_date, l_returnflag as gender,
         cast(l_linenumber as varchar) as age_bucket, cast(c_nationkey as varchar) as dma_code,
         cast(l_extendedprice as decimal(18,2)) as amt, cast(l_quantity as bigint) as qty,
         cast(l_linenumber as bigint) as line,
         case when l_returnflag = 'R' then 1 else 0 end as is_lead,
         case when l_linestatus = 'F' then 1 else 0 end as is_conv,
         s_name as campaign_name,
         case when s_acctbal < 0 then 'PAUSED' else 'ACTIVE' end as status,
         case when s_nationkey % 2 = 0 then 'AWARENESS' else 'CONVERSIONS' end as objective
  from lineitem
  join supplier on l_suppkey = s_suppkey
  join orders on l_orderkey = o_orderkey
  join customer on o_custkey = c_custkey)"""

_METRICS = """cast(sum(amt) as double) as spend, cast(sum(qty) as bigint) as impressions,
  cast(count(*) as bigint) as clicks, cast(sum(line) as bigint) as engagements,
  cast(sum(is_conv) as bigint) as conversions, cast(sum(is_lead) as bigint) as leads,
  cast(sum(amt) as double) / nullif(cast(sum(is_lead) as double), 0) as cost_per_lead,
  cast(sum(amt) as double) / cast(count(*) as double) as ecpc,
  cast(sum(amt) as double) / nullif(cast(sum(qty) as double), 0) * 1000 as cpm,
  cast(count(*) as double) / nullif(cast(sum(qty) as double), 0) as ctr,
  cast(sum(qty) as bigint) as video_p0_combined,
  cast(sum(case when line <= 5 then qty else 0 end) as bigint) as video_p25_combined,
  cast(sum(case when line <= 4 then qty else 0 end) as bigint) as video_p50_combined,
  cast(sum(case when line <= 3 then qty else 0 end) as bigint) as video_p75_combined,
  cast(sum(case when line <= 2 then qty else 0 end) as bigint) as video_completions"""


def _fact(keys: str, name: str = "") -> str:
    named = f"{keys}, {name}" if name else keys
    return f"select {named}, {_METRICS} from ads_base group by {keys}"


_AD = "ad_account_id, ad_id, ad_group_id, campaign_id, stat_date"
_CAMPAIGN = "ad_account_id, campaign_id, campaign_name, status, objective, stat_date"

_WITH = f"with {_BASE}"
_AD_PERF = f"ad_perf as ({_fact(_AD)})"
_CAMPAIGN_PERF = f"campaign_perf as ({_fact(_CAMPAIGN)})"
_MARKET_PERF = f"market_perf as ({_fact(_AD + ', dma_code')})"
_WINDOW = "stat_date between date '2000-06-08' and date '2000-06-21'"


def _upserted() -> str:
    """The whole history, the window revised by rows that deliver no leads."""
    others = ", ".join(f"s.{c}" for c in (
        "engagements conversions").split())
    rest = ("cost_per_lead, ecpc, cpm, ctr, video_p0_combined, video_p25_combined, "
            "video_p50_combined, video_p75_combined, video_completions")
    head = "ad_account_id, ad_id, ad_group_id, campaign_id, stat_date"
    return f"""{_WITH}, {_AD_PERF},
source as (select * from ad_perf where {_WINDOW} and ad_id not like '%-7')
select {head}, spend + 1000 as spend, impressions, clicks, {others},
       cast(null as bigint) as leads, {rest} from source s
union all
select {head}, spend, impressions, clicks, engagements, conversions, leads, {rest}
from ad_perf t where not exists (
  select 1 from source s where s.ad_account_id = t.ad_account_id and s.ad_id = t.ad_id
  and s.stat_date = t.stat_date)"""


_SUPPLIER = """supplier_dim as (
  select cast(s_suppkey as varchar) as campaign_id, cast(s_nationkey as varchar) as ad_account_id,
         s_name as name, s_suppkey, s_nationkey, s_acctbal,
         case when s_acctbal < 0 then 'PAUSED' else 'ACTIVE' end as status
  from supplier)"""

_ENTITY = """entity as (
  select cast(s_nationkey as varchar) as ad_account_id, l_suppkey, l_partkey % {n} as part,
         cast(l_suppkey as varchar) || '-' || cast((l_partkey % {n}) % 5 as varchar) as ad_group_id,
         cast(l_suppkey as varchar) as campaign_id,
         min(l_shipdate) as first_day, max(l_shipdate) as last_day, count(*) as n,
         min(l_partkey) as min_part, max(l_partkey) as max_part
  from lineitem join supplier on l_suppkey = s_suppkey
  group by s_nationkey, l_suppkey, l_partkey % {n})"""
_GROUPS, _ADS = _ENTITY.replace("{n}", "5"), _ENTITY.replace("{n}", "20")
_AD_ID = "ad_group_id || '-' || cast(part as varchar)"

_PLACED = f"""{_ADS}, placed as (
  select ad_account_id, {_AD_ID} as ad_id,
         row_number() over (partition by ad_account_id order by l_suppkey, part) - 1 as listing_pos
  from entity)"""


def _nulls(names: str, sql_type: str) -> str:
    return "".join(f", cast(null as {sql_type}) as {n}" for n in names.split())


def _batches(size: int) -> str:
    return f"""select ad_account_id, cast(floor(listing_pos / {size}.0) as bigint) as batch_no,
  cast(count(*) as bigint) as n_ids, string_agg(ad_id, ',' order by listing_pos) as ids
from placed group by ad_account_id, cast(floor(listing_pos / {size}.0) as bigint)"""


_EPOCH = "cast(epoch({}) as bigint)"

_BAD_ORDERS = """order_rows as (
  select cast(cast(floor(o_orderkey / 100.0) as bigint) as varchar) as ad_account_id,
         case when o_orderpriority <> '1-URGENT' then cast(o_orderkey as varchar) end as raw_ad_id,
         case when o_orderpriority = '5-LOW' then 'n/a' else cast(o_custkey as varchar) end as raw_impressions,
         case when o_orderstatus = 'F' then cast(o_orderdate as date)
              when o_orderstatus = 'P' then null else date '2020-02-02' end as stat_date,
         o_totalprice as spend
  from orders),
judged as (
  select *, concat_ws(', ',
    case when raw_ad_id is null then 'ad_id missing' end,
    case when stat_date is null then 'stat_date missing' end,
    case when raw_impressions = 'n/a' then 'impressions unreadable' end) as problems
  from order_rows)"""

_REQUESTED = ("AD_ID,AD_GROUP_ID,CAMPAIGN_ID,AD_ACCOUNT_ID,SPEND_IN_DOLLAR,TOTAL_IMPRESSION,"
              "TOTAL_CLICKTHROUGH,TOTAL_ENGAGEMENT,TOTAL_CONVERSIONS,LEADS,COST_PER_LEAD,"
              "ECPC_IN_DOLLAR,CPM_IN_DOLLAR,CTR,TOTAL_VIDEO_P0_COMBINED,TOTAL_VIDEO_P25_COMBINED,"
              "TOTAL_VIDEO_P50_COMBINED,TOTAL_VIDEO_P75_COMBINED,TOTAL_VIDEO_P100_COMPLETE")

_REPLACED = f"""with {_SUPPLIER}, g as (with {_GROUPS} select ad_group_id from entity),
a as (with {_ADS} select {_AD_ID} as ad_id from entity)
select 'campaign_dim' as table_name, campaign_id as entity_id,
  (select count(*) from supplier_dim) as rows_written from supplier_dim
union all select 'ad_group_dim', ad_group_id, (select count(*) from g) from g
union all select 'ad_dim', ad_id, (select count(*) from a) from a"""

ORACLE = {
    "ad_performance": f"{_WITH} {_fact(_AD)}",
    "ad_group_performance": f"""{_WITH}
select ad_account_id, ad_group_id, campaign_id, 'Group ' || ad_group_id as ad_group_name,
  status as ad_group_status, stat_date, {_METRICS}
from ads_base group by ad_account_id, ad_group_id, campaign_id, status, stat_date""",
    "campaign_performance": f"""{_WITH}
select ad_account_id, campaign_id, campaign_name, status as campaign_status,
  objective as campaign_objective_type, stat_date, {_METRICS}
from ads_base group by {_CAMPAIGN}""",
    "ad_market_performance": f"{_WITH} {_fact(_AD + ', dma_code')}",
    "ad_gender_performance": f"{_WITH} {_fact(_AD + ', gender')}",
    "ad_age_performance": f"{_WITH} {_fact(_AD + ', age_bucket')}",
    "default_dates": f"""with {_BAD_ORDERS}
select ad_account_id, raw_ad_id as ad_id, stat_date, cast(raw_impressions as bigint) as impressions, spend
from judged where problems = ''""",
    "quarantined_rows": f"""with {_BAD_ORDERS}
select ad_account_id, raw_ad_id, raw_impressions, spend, problems from judged where problems <> ''""",
    "unreadable_bodies": """
select 'page ' || cast(page_id as varchar) as response,
  case when try_cast(html as json) is null then 'unreadable' else 'readable' end as verdict from pages
union all
select 'event ' || cast(event_id as varchar),
  case when try_cast(props as json) is null then 'unreadable' else 'readable' end from events""",
    "campaign_dimension": f"""with {_SUPPLIER}
select campaign_id, ad_account_id, name,
  case when s_nationkey % 2 = 0 then 'AWARENESS' else 'CONVERSIONS' end as objective_type, status
  {_nulls("summary_status intended_promotion_type type order_line_id", "varchar")},
  case when s_acctbal >= 0 then s_suppkey * 1000000 end as daily_spend_cap,
  s_suppkey * 9007199254740993 as lifetime_spend_cap
  {_nulls("default_ad_group_budget_in_micro_currency", "bigint")},
  case when s_acctbal >= 0 then 'true' else 'false' end as is_automated_campaign
  {_nulls("is_campaign_budget_optimization", "varchar")},
  case when s_suppkey % 3 = 0 then 'true' else 'false' end as is_carting
  {_nulls("is_flexible_daily_budgets is_ltv_optimized is_performance_plus is_top_of_search", "varchar")},
  s_suppkey * 86400 as created_time {_nulls("updated_time", "bigint")},
  cast(0 as bigint) as start_time {_nulls("end_time", "bigint")},
  '{{"caps":{{"z":' || cast(s_nationkey as varchar) || ',"a":2.0}}}}' as bid_options_json
  {_nulls("performance_plus_campaign_settings_json", "varchar")},
  '["' || name || '","u"]' as tracking_urls_json
from supplier_dim""",
    "ad_group_dimension": f"""with {_GROUPS}
select ad_group_id, ad_account_id, campaign_id, 'Group ' || ad_group_id as name
  {_nulls("status summary_status type billable_event bid_strategy_type conversion_learning_mode_type budget_type pacing_delivery_type placement_group placement_traffic_type promotion_application_level promotion_id feed_profile_id", "varchar")},
  cast(min_part as varchar) as customer_segment_id, n as bid_in_micro_currency,
  n as budget_in_micro_currency {_nulls("lifetime_frequency_cap", "bigint")},
  cast(n as double) / 4 as local_inventory_radius_in_miles, cast(part as double) as bid_multiplier
  {_nulls("auto_targeting_enabled", "varchar")},
  case when part % 2 = 1 then 'true' else 'false' end as is_creative_optimization
  {_nulls("is_local_inventory", "varchar")},
  {_EPOCH.format("first_day")} as created_time, {_EPOCH.format("last_day")} as updated_time
  {_nulls("start_time end_time", "bigint")},
  '[' || cast(min_part as varchar) || ',' || cast(max_part as varchar) || ']' as promotion_ids_json
  {_nulls("targeting_template_ids_json", "varchar")},
  case when part % 2 = 1 then '"{{\\"note\\":\\"' || ad_group_id || '\\"}}"' end as dca_assets_json
  {_nulls("ext_features_json optimization_goal_metadata_json performance_plus_campaign_settings_json", "varchar")},
  '{{"geo":["' || campaign_id || '"],"b":{{"z":' || cast(n as varchar) || '}}}}' as targeting_spec_json
  {_nulls("tracking_urls_json", "varchar")}
from entity""",
    "ad_dimension": f"""with {_ADS}
select {_AD_ID} as ad_id, ad_account_id, ad_group_id, campaign_id, cast(min_part as varchar) as pin_id,
  'Ad "' || {_AD_ID} || '" é' as name, case when n > 30 then 'ACTIVE' end as status
  {_nulls("summary_status review_status type creative_type customizable_cta_type disclosure_type grid_click_type carting_platform_type collections_header_type lead_form_id android_deep_link ios_deep_link", "varchar")},
  'https://example.com/' || cast(max_part as varchar) as destination_url
  {_nulls("click_tracking_url view_tracking_url disclosure_url collection_items_destination_url_template", "varchar")},
  case when part % 2 = 0 then 'true' else 'false' end as is_carting
  {_nulls("is_collage_accepted_terms is_collage_single_destination", "varchar")},
  'false' as is_pin_deleted {_nulls("is_removable", "varchar")},
  {_EPOCH.format("first_day")} as created_time, {_EPOCH.format("last_day")} as updated_time
  {_nulls("carousel_android_deep_links_json carousel_destination_urls_json carousel_ios_deep_links_json", "varchar")},
  '[{{"b":' || cast(max_part as varchar) || ',"a":"x"}}]' as carting_products_json,
  '{{"k":' || cast(n as varchar) || '}}' as quiz_pin_data_json, '[]' as rejected_reasons_json
  {_nulls("rejection_labels_json tracking_urls_json", "varchar")}
from entity""",
    "market_reference": "select cast(n_nationkey as varchar) as dma_code, n_name as dma_name from nation",
    "options_last_wins": """select cast(c_nationkey as varchar) as dma_code,
  arg_max(c_name, c_custkey) as dma_name from customer group by c_nationkey""",
    "account_discovery": "select distinct cast(s_nationkey as varchar) as ad_account_id from supplier",
    "allowlist_visible": """
select cast(r.pos as bigint) as request_pos, r.id as ad_account_id
from (values (0, '3'), (1, '7'), (2, '999'), (3, '3')) r(pos, id)
where r.id in (select cast(s_nationkey as varchar) from supplier)""",
    "allowlist_missing": """
select r.id as ad_account_id from (values (0, '3'), (1, '7'), (2, '999'), (3, '3')) r(pos, id)
where r.id not in (select cast(s_nationkey as varchar) from supplier)""",
    "entity_files": """
select cast(s_nationkey as varchar) as ad_account_id, cast(floor(s_suppkey / 100.0) as bigint) as page_no,
  row_number() over (partition by s_nationkey, floor(s_suppkey / 100.0) order by s_suppkey) - 1 as item_pos,
  cast(s_suppkey as varchar) as campaign_id, s_name as name from supplier""",
    "listing_positions": f"with {_PLACED} select ad_account_id, ad_id, listing_pos from placed",
    "request_batches": f"with {_PLACED} {_batches(100)}",
    "report_requests": f"""with {_PLACED}, batches as ({_batches(250)})
select ad_account_id, batch_no, 'ads/targeting_analytics' as path, 'ad_ids' as id_param, ids,
  '2000-06-08' as start_date, '2000-06-21' as end_date, 'DAY' as granularity,
  '{_REQUESTED}' as columns, 'LOCATION' as targeting_types from batches""",
    "accounts_with_entities": """
select cast(o_custkey as varchar) as ad_account_id, cast(count(*) as bigint) as n_ids
from orders where o_custkey in (select c_custkey from customer) group by o_custkey""",
    "paged_fetch": f"""with {_ADS}, listed as (
  select ad_account_id, campaign_id, cast(floor(part / 6.0) as bigint) as page_no, {_AD_ID} as ad_id
  from entity)
select ad_account_id, campaign_id, page_no, ad_id,
  row_number() over (partition by ad_account_id, campaign_id, page_no order by ad_id) - 1 as item_pos
from listed""",
    "merge_upsert": _upserted(),
    "merge_upsert_catalog": _upserted(),
    "lookback_window": f"{_WITH}, {_AD_PERF} select ad_account_id, ad_id, stat_date, spend "
                       f"from ad_perf where {_WINDOW}",
    "empty_pull": f"""{_WITH}, {_AD_PERF}
select campaign_id, cast(count(*) as bigint) as n_rows, cast(0 as bigint) as written
from ad_perf group by campaign_id""",
    "duplicate_keys": """select l_orderkey, l_linenumber, cast(count(*) as bigint) as n
from lineitem group by l_orderkey, l_linenumber having count(*) > 1""",
    "latest_per_key": """select l_orderkey, l_linenumber, l_shipdate, l_extendedprice, l_quantity, l_partkey
from (select l_orderkey, l_linenumber, cast(l_shipdate as date) as l_shipdate, l_extendedprice,
        l_quantity, l_partkey,
        row_number() over (partition by l_orderkey, l_linenumber
          order by cast(l_shipdate as date) desc, l_extendedprice desc, l_quantity desc, l_partkey desc) as rn
      from lineitem) t where rn = 1""",
    "snapshot_replace": f"""with {_SUPPLIER}
select campaign_id, ad_account_id, name from supplier_dim where status = 'ACTIVE'""",
    "snapshot_replace_catalog": f"""with {_SUPPLIER}
select campaign_id, ad_account_id, name from supplier_dim where status = 'ACTIVE'""",
    "scoped_replace": f"""with {_SUPPLIER}
select campaign_id, ad_account_id, name from supplier_dim
where status = 'ACTIVE' or ad_account_id not in ('3', '7')""",
    "staged_multi_replace": _REPLACED,
    "spend_per_ad_day": f"""{_WITH}
select ad_account_id, ad_id, stat_date, cast(sum(amt) as double) as spend, cast(count(*) as bigint) as clicks
from ads_base group by ad_account_id, ad_id, stat_date""",
    "market_named": f"""{_WITH}, {_MARKET_PERF}
select d.ad_account_id, d.ad_id, d.stat_date, d.dma_code, n.n_name as dma_name, d.spend
from market_perf d left join nation n on d.dma_code = cast(n.n_nationkey as varchar)""",
    "fact_with_campaign": f"""{_WITH}
select ad_account_id, ad_id, campaign_id, stat_date, campaign_name, objective,
  cast(sum(qty) as bigint) as impressions
from ads_base group by ad_account_id, ad_id, campaign_id, stat_date, campaign_name, objective""",
    "breakdown_reconcile": f"""{_WITH}, {_AD_PERF}, {_MARKET_PERF}, parts as (
  select ad_account_id, ad_id, stat_date, cast(sum(impressions) as bigint) as impressions_parts,
    cast(sum(cast(spend as decimal(18,2))) as double) as spend_parts
  from market_perf group by ad_account_id, ad_id, stat_date)
select coalesce(a.ad_account_id, p.ad_account_id) as ad_account_id, coalesce(a.ad_id, p.ad_id) as ad_id,
  coalesce(a.stat_date, p.stat_date) as stat_date,
  case when a.ad_id is null then 0 else a.impressions end as impressions,
  case when a.ad_id is null then 0 else a.spend end as spend,
  case when p.ad_id is null then 0 else p.impressions_parts end as impressions_parts,
  case when p.ad_id is null then 0 else p.spend_parts end as spend_parts,
  case when a.ad_id is null then 'parts' when p.ad_id is null then 'whole' else 'both' end as side,
  coalesce(a.impressions, 0) - coalesce(p.impressions_parts, 0) as impressions_rest,
  cast(cast(coalesce(a.spend, 0) as decimal(18,2)) - cast(coalesce(p.spend_parts, 0) as decimal(18,2)) as double) as spend_rest
from ad_perf a full join parts p
  on a.ad_account_id = p.ad_account_id and a.ad_id = p.ad_id and a.stat_date = p.stat_date""",
    "level_reconcile": f"""{_WITH}, {_AD_PERF}, {_CAMPAIGN_PERF}, parts as (
  select ad_account_id, campaign_id, stat_date, cast(sum(clicks) as bigint) as clicks_parts,
    cast(sum(conversions) as bigint) as conversions_parts,
    cast(sum(cast(spend as decimal(18,2))) as double) as spend_parts
  from ad_perf group by ad_account_id, campaign_id, stat_date)
select c.ad_account_id, c.campaign_id, c.stat_date, c.clicks, c.conversions, c.spend, 'both' as side,
  clicks_parts, conversions_parts, spend_parts, clicks - clicks_parts as clicks_rest,
  conversions - conversions_parts as conversions_rest,
  cast(cast(spend as decimal(18,2)) - cast(spend_parts as decimal(18,2)) as double) as spend_rest
from campaign_perf c left join parts p
  on c.ad_account_id = p.ad_account_id and c.campaign_id = p.campaign_id and c.stat_date = p.stat_date""",
    "stacked_breakdown": f"""{_WITH}
select 'GENDER' as breakdown_type, gender as breakdown_value, campaign_id,
  cast(sum(amt) as double) as spend, cast(sum(qty) as bigint) as impressions
from ads_base group by gender, campaign_id
union all
select 'AGE_BUCKET', age_bucket, campaign_id, cast(sum(amt) as double), cast(sum(qty) as bigint)
from ads_base group by age_bucket, campaign_id""",
    "rollup_ratios": f"""{_WITH}
select campaign_id, cast(sum(amt) as double) as spend, cast(sum(qty) as bigint) as impressions,
  cast(count(*) as bigint) as clicks, cast(sum(is_lead) as bigint) as leads,
  cast(sum(amt) as double) / cast(count(*) as double) as ecpc,
  cast(sum(amt) as double) / nullif(cast(sum(qty) as double), 0) * 1000 as cpm,
  cast(count(*) as double) / nullif(cast(sum(qty) as double), 0) as ctr,
  cast(sum(amt) as double) / nullif(cast(sum(is_lead) as double), 0) as cost_per_lead
from ads_base group by campaign_id""",
    "market_crosswalk": f"""{_WITH}, walk as (
  select n_nationkey, 'region ' || cast(n_regionkey as varchar) as market from nation
  where n_name <> 'CHINA' and n_nationkey <> 4),
d as (select coalesce(market, 'unmapped') as market, cast(sum(amt) as double) as dma_spend, cast(count(*) as bigint) as dma_clicks
  from ads_base left join walk on dma_code = cast(n_nationkey as varchar) group by 1),
o as (select coalesce(market, 'unmapped') as market, cast(sum(cast(o_totalprice as decimal(18,6))) as double) as other_spend,
    cast(count(*) as bigint) as other_clicks
  from orders join customer on o_custkey = c_custkey left join walk on c_nationkey = n_nationkey group by 1)
select coalesce(d.market, o.market) as market, dma_spend, dma_clicks, other_spend, other_clicks
from d full join o on d.market = o.market""",
    "crosswalk_problems": f"""{_WITH}
select distinct dma_code, 'unmapped' as problem from ads_base
where dma_code not in (select cast(n_nationkey as varchar) from nation
                       where n_name <> 'CHINA' and n_nationkey <> 4)
union all select '7', 'ambiguous'""",
    "run_counts": f"""{_WITH}, {_AD_PERF}
select stat_date, cast(count(*) as bigint) as n_rows, count(distinct ad_account_id) as n_accounts,
  count(distinct ad_id) as n_entities from ad_perf group by stat_date""",
    "json_access": """select event_id, json_extract_string(props, '$.k') as k_text,
  try_cast(json_extract_string(props, '$.k') as bigint) as k,
  json_extract_string(props, '$.absent') as absent from events""",
    "unix_times": f"""select event_id, {_EPOCH.format("date_trunc('second', ts)")} as seconds,
  {_EPOCH.format("date_trunc('second', ts)")} * 1000000 + 500000 as micros from events""",
    "number_casts": """select event_id, cast(trunc(v) as bigint) as as_long,
  cast(-trunc(v) as bigint) as as_negative, cast(cast(v as varchar) as double) as as_double,
  cast(null as bigint) as word
from (select event_id, cast(value as decimal(18,4)) as v from events) t""",
    "csv_lists": """select doc_id, cast(len(items) as bigint) as n_items,
  md5(array_to_string(items, ',')) as joined
from (select doc_id, list_filter(list_transform(string_split(text, ','),
        lambda x: regexp_replace(x, '^[ \\t\\n\\v\\f\\r]+|[ \\t\\n\\v\\f\\r]+$', '', 'g')), lambda x: x <> '') as items
      from documents) t""",
    "date_windows": """select o_orderkey,
  case o_orderkey % 5 when 2 then date '2000-01-01' when 0 then d when 1 then d - 7 else d - 14 end as first_day,
  case o_orderkey % 5 when 2 then date '2000-01-31' else d - 1 end as last_day
from (select o_orderkey, cast(o_orderdate as date) as d from orders) t""",
    "stream_upsert": f"""{_WITH}, {_CAMPAIGN_PERF}
select ad_account_id, campaign_id, case when {_WINDOW} then null else campaign_name end as campaign_name,
  stat_date, case when {_WINDOW} then spend + 1000 else spend end as spend,
  case when {_WINDOW} then null else clicks end as clicks from campaign_perf""",
    "stream_late_rows": f"""{_WITH}, {_CAMPAIGN_PERF}
select cast(sum(case when stat_date >= date '2000-06-22' - 1000 then 1 else 0 end) as bigint) as kept,
  min(case when stat_date >= date '2000-06-22' - 1000 then stat_date end) as first_day,
  cast(sum(case when stat_date < date '2000-06-22' - 1000 then 1 else 0 end) as bigint) as late
from campaign_perf""",
    "listing_ids": f"with {_PLACED} select ad_account_id, ad_id, listing_pos from placed",
    "sliced_requests": f"""with {_PLACED}, batches as ({_batches(250)}),
sized as (select *, cast(greatest(1, floor(50000.0 / (n_ids * 25))) as integer) as days from batches),
slices as (select *, unnest(range(0, 1826, days)) as first_day from sized)
select ad_account_id, batch_no, ids,
  cast(cast(date '1995-01-01' + cast(first_day as integer) as date) as varchar) as start_date,
  cast(cast(least(date '1995-01-01' + cast(first_day + days - 1 as integer), date '1999-12-31') as date) as varchar) as end_date
from slices""",
    "resumed_fetch": f"""with {_ADS}, listed as (
  select ad_account_id, campaign_id, p.page_no, string_agg({_AD_ID}, ',' order by {_AD_ID}) as ids
  from entity right join (select distinct ad_account_id as a, campaign_id as c, unnest(range(0, 4)) as page_no from entity) p
    on ad_account_id = p.a and campaign_id = p.c and cast(floor(part / 6.0) as bigint) = p.page_no
  group by p.a, p.c, ad_account_id, campaign_id, p.page_no)
select ad_account_id, campaign_id, page_no, case when cast(campaign_id as bigint) % 2 = 0 then 1 else 2 end as asked_by_run,
  md5(coalesce(ids, '')) as ids from listed""",
    "upsert_finished": _upserted(),
    "upsert_finished_catalog": _upserted(),
    "replace_finished": _REPLACED,
    "refused_run": f"""with {_BAD_ORDERS}, kept as (select cast(count(*) as bigint) as n from judged where problems = ''),
found as (
  select 'ad_id missing' as problem, cast(count(*) as bigint) as n, cast(null as varchar) as example from judged where raw_ad_id is null
  union all select 'stat_date missing', count(*), null from judged where stat_date is null
  union all select 'impressions unreadable', count(*), min(raw_impressions) from judged where raw_impressions = 'n/a'
  union all select 'unreadable response', count(*), null from pages where try_cast(html as json) is null)
select problem, found.n, example, kept.n as rows_kept, kept.n as rows_before from found, kept where found.n > 0""",
    "run_stamps": f"""{_WITH}, {_CAMPAIGN_PERF}
select campaign_id, cast(epoch(timestamp '2024-01-02 03:04:05') as bigint) as stamp, cast(count(*) as bigint) as n
from campaign_perf group by campaign_id""",
    "fact_with_names": f"""{_WITH}, {_AD_PERF}, ads as (
  with {_ADS} select ad_account_id as account, {_AD_ID} as id, case when n > 30 then 'ACTIVE' end as ad_status from entity)
select ad_account_id, ad_id, stat_date, 'Group ' || ad_group_id as ad_group_name, 'Ad "' || ad_id || '" é' as ad_name,
  ad_status, clicks from ad_perf left join ads on account = ad_account_id and id = ad_id""",
    "gender_age_reconcile": f"""{_WITH}, {_AD_PERF}
select ad_account_id, 'both' as side, cast(count(*) as bigint) as n, cast(0 as bigint) as impressions_rest,
  cast(0 as double) as spend_rest, b.breakdown
from ad_perf, (values ('gender'), ('age_bucket')) b(breakdown) group by ad_account_id, b.breakdown""",
    "json_list_rows": f"""with {_ADS}
select {_AD_ID} as ad_id, cast(0 as bigint) as pos, max_part as product, 'x' as kind, cast(null as varchar) as absent from entity""",
    "json_shapes": f"""with {_GROUPS}
select 'promotion_ids_json' as column, 'ARRAY<BIGINT>' as shape, cast(count(*) as bigint) as n from entity
union all select 'targeting_spec_json', 'OBJECT<b: OBJECT<z: BIGINT>, geo: ARRAY<STRING>>', count(*) from entity
union all select 'dca_assets_json', case when count(*) > 0 then 'STRING' end, count(*) from entity where part % 2 = 1
union all select 'ext_features_json', null, 0""",
    "json_changed_shapes": f"""with {_GROUPS}
select 'promotion_ids_json' as column, 'ARRAY<BIGINT>' as before, 'ARRAY<STRING>' as after from entity having count(*) > 0
union all select 'dca_assets_json', 'STRING', null from entity where part % 2 = 1 having count(*) > 0""",
    "json_structs": f"""with {_GROUPS} select ad_group_id, campaign_id as geo, n as z from entity""",
    "stream_quarantine": f"""with {_BAD_ORDERS}
select ad_account_id, raw_ad_id, raw_impressions, spend, problems from judged where problems <> ''""",
    "stream_ledger": f"""with {_BAD_ORDERS},
g as (select cast(count(*) as bigint) as n from judged where problems = '' and stat_date >= date '1998-01-01'),
l as (select cast(count(*) as bigint) as n from judged where problems = '' and stat_date < date '1998-01-01'),
b as (select cast(count(*) as bigint) as n from judged where problems <> ''),
u as (select cast(count(*) as bigint) as n from pages where try_cast(html as json) is null)
select 0 as batch_id, g.n as rows, l.n as late, b.n as bad, 0 as unreadable, g.n as held from g, l, b
union all select 1, 0, 0, 0, u.n, g.n from g, u""",
}
