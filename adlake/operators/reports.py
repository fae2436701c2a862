"""Reporting queries over the tables.

Joins carry no hints: a market or entity table below Spark's size limit is broadcast by
its measured size, a larger one is shuffled and adaptive execution splits hot keys. Sums
are combined before each shuffle. Money is summed as a decimal, so a total does not depend
on the order in which rows arrive.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNMAPPED = "unmapped"
BREAKDOWN_TYPE, BREAKDOWN_VALUE = "breakdown_type", "breakdown_value"

_MONEY = "decimal(28,10)"
_MONEY_COLUMNS = {"spend"}
_RATIOS = {"cost_per_lead", "ecpc", "cpm", "ctr"}


class DoubleCounting(Exception):
    """A sum that would add up two slices of the same traffic."""


def _money(amount: Column) -> Column:
    """An amount as a decimal; one that is none (NaN, infinite, too large) fails the query, as a
    sum would leave it out."""
    exact = amount.try_cast(_MONEY)
    lost = F.raise_error(F.concat(F.lit("not an amount: "), amount.cast("string")))
    return F.when(amount.isNotNull() & exact.isNull(), lost.cast(_MONEY)).otherwise(exact)


def total(metric: str) -> Column:
    """Sum of one additive metric, exact for money. Ratios have no sum."""
    if metric in _RATIOS:
        raise ValueError(f"{metric} is a ratio; recompute it from sums (rollup)")
    if metric in _MONEY_COLUMNS:
        return F.sum(_money(F.col(metric))).cast("double").alias(metric)
    return F.sum(metric).cast("bigint").alias(metric)


def totals(df: DataFrame, keys, metrics) -> DataFrame:
    """Sum of metrics per key over one table. A stacked frame has to be summed per slice."""
    if BREAKDOWN_TYPE in df.columns and BREAKDOWN_TYPE not in keys:
        raise DoubleCounting(f"group by {BREAKDOWN_TYPE}: its slices cover the same traffic")
    return df.groupBy(*keys).agg(*(total(m) for m in metrics))


def _over(numerator: Column, denominator: Column) -> Column:
    return numerator / F.nullif(denominator, F.lit(0))


def rollup(df: DataFrame, keys) -> DataFrame:
    """Sums per key with the cost and rate columns recomputed from those sums."""
    sums = totals(df, keys, ["spend", "impressions", "clicks", "leads"])
    return sums.select(
        "*",
        _over(F.col("spend"), F.col("clicks")).alias("ecpc"),
        (_over(F.col("spend"), F.col("impressions")) * 1000).alias("cpm"),
        _over(F.col("clicks").cast("double"), F.col("impressions")).alias("ctr"),
        _over(F.col("spend"), F.col("leads")).alias("cost_per_lead"),
    )


# --- names ---------------------------------------------------------------------------


def with_market_names(fact: DataFrame, reference: DataFrame) -> DataFrame:
    """Market facts with readable names; a code without a name stays, with a null."""
    return fact.join(reference.select("dma_code", "dma_name"), "dma_code", "left")


def with_entity(fact: DataFrame, dimension: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """Facts with columns of a parent entity, renamed by ``columns``. Entity ids are matched
    within their account."""
    keys = ["ad_account_id", key]
    named = dimension.select(*keys, *(F.col(c).alias(name) for c, name in columns.items()))
    return fact.join(named, keys, "left")


# --- reconciliation ------------------------------------------------------------------


_ANY_VALUE = {"string": "''", "date": "date'1970-01-01'", "timestamp": "timestamp'1970-01-01 00:00:00Z'", "boolean": "false",
              **{kind: f"cast(0 as {kind})" for kind in ("tinyint", "smallint", "int", "bigint")}}


def _split_keys(df: DataFrame, keys) -> DataFrame:
    """Each key as two columns that are never null: its value, and whether it has none."""
    kinds = dict(df.dtypes)
    found = ((F.coalesce(k, F.expr(_ANY_VALUE[kinds[k]])).alias(f"_{k}_value"), F.col(k).isNull().alias(f"_{k}_none")) for k in keys)
    return df.select(*(c for pair in found for c in pair), *(c for c in df.columns if c not in keys))


def _whole_keys(df: DataFrame, keys) -> DataFrame:
    """The keys beside the two columns of each."""
    return df.select("*", *(F.when(~F.col(f"_{k}_none"), F.col(f"_{k}_value")).alias(k) for k in keys))


def _matched(whole: DataFrame, parts: DataFrame, keys, metrics) -> tuple[DataFrame, DataFrame, Column]:
    """Rows of ``whole``, the sums of ``parts``, and when they have the same keys, nulls included.
    A null-safe comparison would deal the sums out once more, so keys are summed and compared by
    columns that are never null, where their types allow it."""
    kinds = [dict(df.dtypes) for df in (whole, parts)]
    if any(kinds[0][k] != kinds[1][k] or kinds[0][k] not in _ANY_VALUE for k in keys):
        own, sums = whole.select(*keys, *metrics), totals(parts, keys, metrics)
        return own, sums, reduce(and_, (F.col(f"own.{k}").eqNullSafe(F.col(f"sums.{k}")) for k in keys))
    split = [f"_{k}_{what}" for k in keys for what in ("value", "none")]
    own = _whole_keys(_split_keys(whole.select(*keys, *metrics), keys), keys)
    sums = _whole_keys(totals(_split_keys(parts, keys), split, metrics), keys)
    return own, sums, reduce(and_, (F.col(f"own.{c}") == F.col(f"sums.{c}") for c in split))


def reconcile(whole: DataFrame, parts: DataFrame, keys, metrics) -> DataFrame:
    """Each row of ``whole`` beside the summed rows of ``parts``: ``<m>_parts``, the
    remainder ``<m>_rest``, and the ``side`` that has the key: both, whole or parts. A
    missing side counts as 0, so what is not attributed at all is in the remainder.

    With a breakdown as parts the remainder is unattributed traffic; with ads as parts of
    a campaign it should be zero.
    """
    if BREAKDOWN_TYPE in parts.columns and BREAKDOWN_TYPE not in keys:
        raise DoubleCounting(f"group by {BREAKDOWN_TYPE}: its slices cover the same traffic")
    own, sums, same = _matched(whole, parts, keys, metrics)
    own = own.select("*", F.lit(True).alias("_whole")).alias("own")
    sums = sums.withColumnsRenamed({m: f"{m}_parts" for m in metrics}).select("*", F.lit(True).alias("_parts")).alias("sums")
    has_whole, has_parts = F.col("_whole").isNotNull(), F.col("_parts").isNotNull()
    side = F.when(has_whole & has_parts, "both").when(has_whole, "whole").otherwise("parts")
    joined = own.join(sums, same, "full").select(
        *(F.coalesce(f"own.{k}", f"sums.{k}").alias(k) for k in keys),
        *(F.when(has_whole, F.col(m)).otherwise(F.lit(0)).alias(m) for m in metrics),
        *(F.when(has_parts, F.col(f"{m}_parts")).otherwise(F.lit(0)).alias(f"{m}_parts") for m in metrics),
        side.alias("side"))
    return joined.select("*", *(_rest(m).alias(f"{m}_rest") for m in metrics))


def _rest(metric: str) -> Column:
    own, parts = (F.coalesce(F.col(c), F.lit(0)) for c in (metric, f"{metric}_parts"))
    if metric in _MONEY_COLUMNS:
        return (_money(own) - _money(parts)).cast("double")
    return own - parts


# --- slices --------------------------------------------------------------------------


def stack_breakdowns(slices: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Breakdown tables under one another, as a view: ``{type: (table, value column)}``.
    ``totals`` refuses to sum across the types."""
    parts = [
        df.withColumnRenamed(column, BREAKDOWN_VALUE).withColumn(BREAKDOWN_TYPE, F.lit(kind))
        for kind, (df, column) in slices.items()
    ]
    return reduce(DataFrame.unionByName, parts)


# --- crosswalk -----------------------------------------------------------------------


def crosswalk_problems(codes: DataFrame, crosswalk: DataFrame, column: str) -> DataFrame:
    """Codes in use that the crosswalk does not map, and codes it maps more than once."""
    used = codes.select(column).distinct()
    unmapped = used.join(crosswalk, column, "left_anti").withColumn("problem", F.lit("unmapped"))
    counts = crosswalk.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    repeated = counts.filter("n > 1").select(column, F.lit("ambiguous").alias("problem"))
    return unmapped.unionByName(repeated)


def by_common_market(left: DataFrame, right: DataFrame, crosswalk: DataFrame, metrics) -> DataFrame:
    """Totals of two market taxonomies side by side, joined through an explicit crosswalk
    ``(dma_code, other_code, market)`` and never on code or name.

    Both sides are summed per code first, so the joins see one row per market code. Totals
    in equal totals out: codes without a market are summed under UNMAPPED, and a code with
    two markets fails the query. ``crosswalk_problems`` lists both.
    """
    first = _market_totals(left, "dma_code", crosswalk, metrics, "dma")
    second = _market_totals(right, "other_code", crosswalk, metrics, "other")
    return first.join(second, "market", "full")


def _market_totals(df: DataFrame, code: str, crosswalk: DataFrame, metrics, side: str) -> DataFrame:
    per_code = totals(df, [code], metrics)
    markets = crosswalk.groupBy(code).agg(F.min("market").alias("market"), F.max("market").alias("_other"))
    ambiguous = F.raise_error(F.concat(F.lit(f"{code} with two markets: "), F.col(code)))
    market = F.when(F.col("market") != F.col("_other"), ambiguous).otherwise(F.coalesce("market", F.lit(UNMAPPED)))
    mapped = per_code.join(markets, code, "left").withColumn("market", market)
    summed = totals(mapped, ["market"], metrics)
    return summed.select("market", *(F.col(m).alias(f"{side}_{m}") for m in metrics))


# --- run report ----------------------------------------------------------------------


def run_counts(fact: DataFrame, entity: str) -> DataFrame:
    """Rows, accounts and entities of a run, in one row per day.

    Facts are counted per day, account and entity first; only these counts move on.
    """
    counts = fact.groupBy("stat_date", "ad_account_id", entity).agg(F.count(F.lit(1)).alias("n"))
    accounts = (counts.groupBy("stat_date", "ad_account_id").agg(F.sum("n").alias("n"))
                .groupBy("stat_date").agg(F.sum("n").alias("n_rows"), F.count("ad_account_id").alias("n_accounts")))
    entities = (counts.select(F.col("stat_date").alias("_day"), entity).distinct()
                .groupBy("_day").agg(F.count(entity).alias("n_entities")))
    return accounts.join(entities, F.col("stat_date").eqNullSafe(F.col("_day"))).drop("_day")
