"""Requests that a cut-off run need not repeat: responses landed request by request.

A landing folder belongs to one run and one work list. A request is known by its parameters.
``land`` asks only for what the folder does not hold yet: the work list is anti-joined with
the requests landed there, by a run that died or by an earlier call. Each task takes a few
requests and its file appears when the task ends, all pages of its requests or none; the
write as a whole need not succeed. So a run that fails at one request, or is killed, leaves
what other tasks had finished, and the next one goes on from there.

The number of tasks follows the work list. How many of them run at once is the cluster's
matter, unless ``concurrency`` bounds it; then the requests go in waves of as many tasks.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.session import discard, run_dir
from adlake.sources.landed import BODY_FILES, PAGE_NO
from adlake.sources.paged import Fetch, RetryPolicy, fetch_pages

REQUEST_ID = "request_id"
PER_TASK = 8  # requests of one task: what a failure may cost

# A finished task's file goes to its place at once, not only when the whole job ends.
_COMMIT = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


class ForeignPages(Exception):
    """The landing folder holds responses to requests of another work list."""


def request_id(worklist: DataFrame) -> Column:
    """The identity of a request: all its parameters, nulls included."""
    return F.sha2(F.to_json(F.struct(*worklist.columns), {"ignoreNullFields": "false"}), 256)


def landed_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of the requests that a landing folder holds; one column of it is read."""
    try:
        pages = spark.read.schema(f"{REQUEST_ID} string").parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        pages = spark.createDataFrame([], f"{REQUEST_ID} string")
    return pages.distinct()


def outstanding(worklist: DataFrame, folder: str) -> DataFrame:
    """Requests not landed yet, with their ids. One that the work list repeats is one request."""
    asked = worklist.withColumn(REQUEST_ID, request_id(worklist)).dropDuplicates([REQUEST_ID])
    return asked.join(landed_requests(worklist.sparkSession, folder), REQUEST_ID, "left_anti")


def _no_foreign_pages(worklist: DataFrame, folder: str) -> None:
    ids = worklist.select(request_id(worklist).alias(REQUEST_ID))
    foreign = landed_requests(worklist.sparkSession, folder).join(ids, REQUEST_ID, "left_anti").limit(3).collect()
    if foreign:
        raise ForeignPages(f"{folder} is another run's: {[r[0] for r in foreign]}")


def land(worklist: DataFrame, fetch: Fetch, folder: str, *, policy: RetryPolicy = RetryPolicy(),
         per_task: int = PER_TASK, concurrency: int | None = None) -> DataFrame:
    """Request what is outstanding into ``folder``, and read all of it back: the work list's
    columns, ``page_no`` and ``body``."""
    spark = worklist.sparkSession
    _no_foreign_pages(worklist, folder)
    staged = run_dir(spark, "requests")
    todo = outstanding(worklist, folder)
    todo.write.parquet(staged)
    todo = spark.read.schema(todo.schema).parquet(staged)
    tasks = -(-todo.count() // per_task)
    at_once = min(tasks, concurrency or tasks)
    waves = -(-tasks // at_once) if tasks else 0
    for wave in range(waves):
        turn = todo.where(F.pmod(F.xxhash64(REQUEST_ID), F.lit(waves)) == wave) if waves > 1 else todo
        pages = fetch_pages(turn.repartition(at_once), fetch, policy=policy)
        pages.write.mode("append").options(**_COMMIT, **BODY_FILES).parquet(folder)
    discard(spark, staged)
    return _landed(worklist, folder)


def _landed(worklist: DataFrame, folder: str) -> DataFrame:
    schema = T.StructType(list(worklist.schema)).add(PAGE_NO, "long").add("body", "string")
    try:
        return worklist.sparkSession.read.schema(schema).parquet(folder)
    except AnalysisException as error:  # an empty work list lands nothing
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return worklist.sparkSession.createDataFrame([], schema)
