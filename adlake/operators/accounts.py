"""Which accounts a run covers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.functions.lists import csv_items

ACCOUNT = "ad_account_id"


def requested_accounts(like: DataFrame, allowlist: str) -> DataFrame:
    """The allowlist as rows: ``request_pos`` and account, in request order."""
    items = csv_items(F.lit(allowlist))
    one = like.sparkSession.range(1, numPartitions=1)
    return one.select(F.posexplode(items).alias("request_pos", ACCOUNT))


def resolve_accounts(discovered: DataFrame, allowlist: str | None) -> tuple[DataFrame, DataFrame]:
    """(accounts to pull, requested accounts that are not visible).

    Without an allowlist all discovered accounts are pulled. With one, its order and its
    repetitions are kept. The allowlist is a job parameter, so Spark measures it as small
    and cuts the discovered accounts down to it before anything moves.
    """
    if not allowlist:
        none = discovered.select(ACCOUNT).filter(F.lit(False))
        return discovered.select(ACCOUNT), none
    requested = requested_accounts(discovered, allowlist)
    wanted = requested.select(ACCOUNT)
    visible = discovered.select(ACCOUNT).join(wanted, ACCOUNT, "left_semi").distinct()
    return (
        requested.join(visible, ACCOUNT, "left_semi"),
        requested.join(visible, ACCOUNT, "left_anti"),
    )
