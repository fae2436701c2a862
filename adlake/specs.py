"""Table specifications: one declaration per table drives parsing, casting, checks and DDL."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

# Column type of each field kind.
KIND_TYPES = {
    "request": T.StringType(),    # known from the request, not from the payload
    "breakdown": T.StringType(),  # stands beside the metrics object
    "text": T.StringType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "bool": T.BooleanType(),
    "date": T.DateType(),
    "unix": T.TimestampType(),    # Unix seconds in the payload
    "json": T.StringType(),       # nested value kept as JSON text
    "run": T.TimestampType(),     # one stamp for all rows of a run
}


@dataclass(frozen=True)
class Field:
    """One table column: its kind, the payload key it is read from, whether it must be set."""

    name: str
    kind: str
    raw: str | None = None
    required: bool = False

    @property
    def data_type(self) -> T.DataType:
        return KIND_TYPES[self.kind]


@dataclass(frozen=True)
class TableSpec:
    """A table: columns in order, key, partition column and how it is requested."""

    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...]
    partition: str | None = None
    endpoint: str | None = None        # listing the entities come from
    id_param: str | None = None        # request parameter naming them
    batch_size: int | None = None      # most ids one request may name
    targeting_type: str | None = None  # breakdown asked for

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def payload(self) -> list[Field]:
        """Fields read from the payload."""
        return [f for f in self.fields if f.raw]

    @property
    def schema(self) -> T.StructType:
        """Table schema. Required columns are checked before a write, as the table
        itself carries no NOT NULL."""
        return T.StructType([T.StructField(f.name, f.data_type, True) for f in self.fields])

    @property
    def payload_schema(self) -> T.StructType:
        """Every payload key as text, so that a value is never lost to a type mismatch."""
        return T.StructType([T.StructField(f.raw, T.StringType(), True) for f in self.payload])

    def only(self, *columns: str) -> TableSpec:
        """The table as a reader of these columns and its days needs it: payload keys of the others
        are skipped, not read as text."""
        if lost := set(columns) - set(self.columns):
            raise ValueError(f"{self.name} has no {sorted(lost)}")
        return replace(self, fields=tuple(f for f in self.fields if f.name in {*columns, self.partition}))

    @property
    def requested(self) -> list[str]:
        """Report columns to ask for: identifiers, the account, context, metrics."""
        raws = [f.raw for f in self.payload if f.raw != DATE_KEY]
        ids = [r for r in raws if r.endswith("_ID")]
        return ids + ["AD_ACCOUNT_ID"] + [r for r in raws if r not in ids]

    def ddl(self) -> str:
        return ", ".join(f"`{f.name}` {f.data_type.simpleString()}" for f in self.fields)


# --- fixed values: names, limits and defaults set by the reporting API --------------

DATE_KEY = "DATE"
PAGE_SIZE = 100
LOOKBACK_DAYS = 14
GRANULARITY = "DAY"

# payload key, column, kind
METRICS = """
SPEND_IN_DOLLAR           spend               double
TOTAL_IMPRESSION          impressions         long
TOTAL_CLICKTHROUGH        clicks              long
TOTAL_ENGAGEMENT          engagements         long
TOTAL_CONVERSIONS         conversions         long
LEADS                     leads               long
COST_PER_LEAD             cost_per_lead       double
ECPC_IN_DOLLAR            ecpc                double
CPM_IN_DOLLAR             cpm                 double
CTR                       ctr                 double
TOTAL_VIDEO_P0_COMBINED   video_p0_combined   long
TOTAL_VIDEO_P25_COMBINED  video_p25_combined  long
TOTAL_VIDEO_P50_COMBINED  video_p50_combined  long
TOTAL_VIDEO_P75_COMBINED  video_p75_combined  long
TOTAL_VIDEO_P100_COMPLETE video_completions   long
"""

# identifier and context columns of a fact, with their payload keys
AD_IDS = "AD_ID ad_id, AD_GROUP_ID ad_group_id, CAMPAIGN_ID campaign_id"
AD_GROUP_IDS = (
    "AD_GROUP_ID ad_group_id, CAMPAIGN_ID campaign_id, "
    "AD_GROUP_NAME ad_group_name, AD_GROUP_ENTITY_STATUS ad_group_status"
)
CAMPAIGN_IDS = (
    "CAMPAIGN_ID campaign_id, CAMPAIGN_NAME campaign_name, "
    "CAMPAIGN_ENTITY_STATUS campaign_status, CAMPAIGN_OBJECTIVE_TYPE campaign_objective_type"
)

# entity columns by kind; the payload key equals the column, except X for X_json
CAMPAIGN_COLUMNS = {
    "text": "name objective_type status summary_status intended_promotion_type type order_line_id",
    "long": "daily_spend_cap lifetime_spend_cap default_ad_group_budget_in_micro_currency",
    "bool": "is_automated_campaign is_campaign_budget_optimization is_carting "
            "is_flexible_daily_budgets is_ltv_optimized is_performance_plus is_top_of_search",
    "unix": "created_time updated_time start_time end_time",
    "json": "bid_options_json performance_plus_campaign_settings_json tracking_urls_json",
}
AD_GROUP_COLUMNS = {
    "text": "campaign_id name status summary_status type billable_event bid_strategy_type "
            "conversion_learning_mode_type budget_type pacing_delivery_type placement_group "
            "placement_traffic_type promotion_application_level promotion_id feed_profile_id "
            "customer_segment_id",
    "long": "bid_in_micro_currency budget_in_micro_currency lifetime_frequency_cap",
    "double": "local_inventory_radius_in_miles bid_multiplier",
    "bool": "auto_targeting_enabled is_creative_optimization is_local_inventory",
    "unix": "created_time updated_time start_time end_time",
    "json": "promotion_ids_json targeting_template_ids_json dca_assets_json ext_features_json "
            "optimization_goal_metadata_json performance_plus_campaign_settings_json "
            "targeting_spec_json tracking_urls_json",
}
AD_COLUMNS = {
    "text": "ad_group_id campaign_id pin_id name status summary_status review_status type "
            "creative_type customizable_cta_type disclosure_type grid_click_type "
            "carting_platform_type collections_header_type lead_form_id android_deep_link "
            "ios_deep_link destination_url click_tracking_url view_tracking_url disclosure_url "
            "collection_items_destination_url_template",
    "bool": "is_carting is_collage_accepted_terms is_collage_single_destination "
            "is_pin_deleted is_removable",
    "unix": "created_time updated_time",
    "json": "carousel_android_deep_links_json carousel_destination_urls_json "
            "carousel_ios_deep_links_json carting_products_json quiz_pin_data_json "
            "rejected_reasons_json rejection_labels_json tracking_urls_json",
}

# --- end of fixed values -------------------------------------------------------------

_ACCOUNT = Field("ad_account_id", "request", required=True)
_RUN = Field("ingested_at", "run", required=True)
_METRIC_FIELDS = tuple(
    Field(column, kind, raw)
    for raw, column, kind in (line.split() for line in METRICS.strip().splitlines())
)


def _fact(name, ids, entity, endpoint, batch_size, breakdown=None, targeting_type=None):
    """A daily fact keyed by account, entity, breakdown value if any, and day."""
    pairs = [pair.split() for pair in ids.split(",")]
    fields = [_ACCOUNT] + [Field(c, "text", raw, required=c == entity) for raw, c in pairs]
    if breakdown:
        fields.append(Field(breakdown, "breakdown", required=True))
    fields.append(Field("stat_date", "date", DATE_KEY, required=True))
    key = ["ad_account_id", entity] + ([breakdown] if breakdown else []) + ["stat_date"]
    return TableSpec(
        name, (*fields, *_METRIC_FIELDS, _RUN), tuple(key), "stat_date",
        endpoint, f"{entity}s", batch_size, targeting_type,
    )


def _dimension(name, entity, endpoint, columns):
    """A current-state entity table: own id, account, then columns grouped by kind."""
    fields = [Field(entity, "text", "id", required=True), _ACCOUNT]
    for kind, names in columns.items():
        fields += [Field(c, kind, c.removesuffix("_json")) for c in names.split()]
    return TableSpec(name, (*fields, _RUN), (entity,), endpoint=endpoint)


AD_FACT = _fact("ad_performance", AD_IDS, "ad_id", "ads", 100)
AD_GROUP_FACT = _fact("ad_group_performance", AD_GROUP_IDS, "ad_group_id", "ad_groups", 250)
CAMPAIGN_FACT = _fact("campaign_performance", CAMPAIGN_IDS, "campaign_id", "campaigns", 250)
AD_MARKET_FACT = _fact("ad_dma_performance", AD_IDS, "ad_id", "ads", 250, "dma_code", "LOCATION")
AD_GENDER_FACT = _fact("ad_gender_performance", AD_IDS, "ad_id", "ads", 250, "gender", "GENDER")
AD_AGE_FACT = _fact("ad_age_performance", AD_IDS, "ad_id", "ads", 250, "age_bucket", "AGE_BUCKET")

CAMPAIGN_DIM = _dimension("campaign_dim", "campaign_id", "campaigns", CAMPAIGN_COLUMNS)
AD_GROUP_DIM = _dimension("ad_group_dim", "ad_group_id", "ad_groups", AD_GROUP_COLUMNS)
AD_DIM = _dimension("ad_dim", "ad_id", "ads", AD_COLUMNS)

MARKET_REFERENCE = TableSpec(
    "dma_reference",
    (
        Field("dma_code", "text", "code", required=True),
        Field("dma_name", "text", "name", required=True),
        _RUN,
    ),
    ("dma_code",),
    targeting_type="LOCATION",
)

PERFORMANCE_FACTS = (AD_FACT, AD_GROUP_FACT, CAMPAIGN_FACT)
BREAKDOWN_FACTS = (AD_MARKET_FACT, AD_GENDER_FACT, AD_AGE_FACT)
DIMENSIONS = (CAMPAIGN_DIM, AD_GROUP_DIM, AD_DIM)
ALL_TABLES = (*PERFORMANCE_FACTS, *BREAKDOWN_FACTS, MARKET_REFERENCE, *DIMENSIONS)
