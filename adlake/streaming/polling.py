"""Pulls as a stream: the reporting window is requested again whenever a pull falls due.

The offset of the source is the time of a pull, so the checkpoint says which pulls are done. A
micro-batch has one row: the first and the last pull that fell due since the batch before.
Its window is requested once, from the first pull's first day to the last pull's last one:
an answer is the state at the time of the request, so pulls that are made up for after a
pause differ in their days only. Responses land in a folder of the last pull, request by
request, and are then upserted as revisions with its time as their stamp. A batch that is
replayed after a failure asks only for what has not landed.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Iterator
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from adlake.functions.dates import window_of
from adlake.operators.tables import Target
from adlake.plans.pulls import Source, requested
from adlake.specs import TableSpec
from adlake.streaming.revisions import LANDED_SCHEMA, PULL, Sidings, StreamReport, apply_batch, divert_batch


class PullTimes(DataSource):
    """Pulls that fall due ``every`` so many seconds from ``first`` on (Unix seconds), up to
    ``until`` if it is given and up to now otherwise."""

    @classmethod
    def name(cls) -> str:
        return "pull_times"

    def schema(self) -> str:
        return "first_pull bigint, last_pull bigint"

    def streamReader(self, schema) -> DataSourceStreamReader:
        until = self.options.get("until")
        return _Due(int(self.options["first"]), int(self.options["every"]), None if until is None else int(until))


class _Due(DataSourceStreamReader):
    def __init__(self, first: int, every: int, until: int | None):
        self.first, self.every, self.until = first, every, until

    def initialOffset(self) -> dict:
        return {"pull": self.first - self.every}

    def latestOffset(self) -> dict:
        now = int(time.time()) if self.until is None else self.until
        return {"pull": self.first + max(-1, (now - self.first) // self.every) * self.every}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        due = (start["pull"] + self.every, end["pull"])
        return [InputPartition(due)] if due[0] <= due[1] else []  # none where the caller's clock went back

    def read(self, partition: InputPartition) -> Iterator[tuple[int, int]]:
        yield partition.value


def _at(pull: int) -> dt.datetime:
    return dt.datetime.fromtimestamp(pull, dt.timezone.utc)


def poll(spark: SparkSession, source: Source, target: Target, spec: TableSpec, *, first: dt.datetime,
         every: dt.timedelta, landing: str, checkpoint: str, until: dt.datetime | None = None,
         lookback: str | None = None, allowlist: str | None = None, max_records: int | None = None,
         values: int = 1, report: StreamReport | None = None, sidings: Sidings | None = None) -> StreamingQuery:
    """Start the stream. With ``until`` it does the pulls due by then and stops, or the batch
    that failed if there is one, and the next start goes on from there; without, it goes on by
    the clock. Days are those of UTC. ``landing`` and ``checkpoint`` belong together;
    a bad value stops the stream unless ``sidings`` says where to set it aside."""
    report = report if report is not None else StreamReport()

    def batch(due: DataFrame, batch_id: int) -> None:
        pulls = due.agg(F.min("first_pull"), F.max("last_pull")).first()
        if pulls[0] is None:
            return
        earliest, latest = map(_at, pulls)
        first_day, _ = window_of(due.sparkSession, earliest.date(), lookback)
        _, last_day = window_of(due.sparkSession, latest.date(), lookback)
        folder = replace(source, landing=f"{landing}/{pulls[1]}")
        responses, _ = requested(due.sparkSession, spec, folder, first_day, last_day, allowlist=allowlist,
                                 max_records=max_records, values=values)
        columns = [c.split()[0] for c in LANDED_SCHEMA.split(", ")]
        responses = responses.withColumn(PULL, F.lit(pulls[1]).cast("bigint")).select(*columns)
        if sidings is not None:
            divert_batch(responses, batch_id, target, spec, sidings, first_day=first_day, run_ts=latest, report=report)
        else:
            apply_batch(responses, target, spec, first_day=first_day, run_ts=latest, report=report)

    spark.dataSource.register(PullTimes)
    pulls = spark.readStream.format(PullTimes.name()).option("first", int(first.timestamp())).option("every", int(every.total_seconds()))
    if until is not None:
        pulls = pulls.option("until", int(until.timestamp()))
    writer = pulls.load().writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if until is not None else writer.trigger(processingTime=f"{int(every.total_seconds())} seconds")
    return writer.start()
