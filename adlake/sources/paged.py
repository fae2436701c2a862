"""Requests as a distributed job: one work-list row is one request, followed page by page.

The caller supplies ``fetch(request) -> (status, headers, body)``; ``request`` is the
work-list row as a dict, plus ``bookmark`` from the second page on. Requests spread over
the tasks of the work list, so the number of its partitions caps the number of
simultaneous calls. Pages leave the task in batches of bounded size. Land the result
before using it twice: a frame that is computed again requests again.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from adlake.sources.landed import PAGE_NO

Fetch = Callable[[dict], tuple[int, dict, str]]

FLUSH_BYTES = 8 << 20


@dataclass(frozen=True)
class RetryPolicy:
    """Retry on 429 and 5xx with a doubling wait; ``Retry-After`` overrides it for 429."""

    attempts: int = 5
    first_wait: float = 2.0
    sleep: Callable[[float], None] = time.sleep


class RequestFailed(Exception):
    """A status that is not retried, or that outlasted all attempts."""


def request(fetch: Fetch, params: dict, policy: RetryPolicy) -> str:
    """Body of one response."""
    wait = policy.first_wait
    for attempt in range(1, policy.attempts + 1):
        status, headers, body = fetch(params)
        if status < 400:
            return body
        if status != 429 and status < 500:
            break
        if attempt < policy.attempts:
            named = {name.lower(): value for name, value in headers.items()}  # names have no case
            hint = named.get("retry-after") if status == 429 else None
            policy.sleep(wait if hint is None else float(hint))
            wait *= 2
    raise RequestFailed(f"status {status} after {attempt} attempt(s): {body[:200]}")


def _bookmark(body: str):
    """Where the next page starts; only listings have one. An unreadable body ends the
    paging here and is reported by the readers."""
    try:
        page = json.loads(body)
    except ValueError:
        return None
    return page.get("bookmark") if isinstance(page, dict) else None


def pages(fetch: Fetch, params: dict, policy: RetryPolicy) -> Iterator[str]:
    """All pages of one request, until the bookmark is null, absent or empty."""
    bookmark = None
    while True:
        body = request(fetch, {**params, "bookmark": bookmark} if bookmark else params, policy)
        yield body
        bookmark = _bookmark(body)
        if not bookmark:
            return


def fetch_pages(worklist: DataFrame, fetch: Fetch, *, concurrency: int | None = None,
                policy: RetryPolicy = RetryPolicy()) -> DataFrame:
    """Responses frame: the work-list columns, ``page_no`` and ``body``."""
    if concurrency:
        worklist = worklist.repartition(concurrency)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, numbers, bodies, size = [], [], [], 0
            for row, params in enumerate(batch.to_pylist()):
                for number, body in enumerate(pages(fetch, params, policy)):
                    rows.append(row)
                    numbers.append(number)
                    bodies.append(body)
                    size += len(body)
                    if size >= FLUSH_BYTES:
                        yield _pages_batch(batch, rows, numbers, bodies)
                        rows, numbers, bodies, size = [], [], [], 0
            if rows:
                yield _pages_batch(batch, rows, numbers, bodies)

    schema = T.StructType(list(worklist.schema)).add(PAGE_NO, "long").add("body", "string")
    return worklist.mapInArrow(run, schema)


def _pages_batch(batch: pa.RecordBatch, rows, numbers, bodies) -> pa.RecordBatch:
    context = batch.take(pa.array(rows, pa.int64()))
    return pa.RecordBatch.from_arrays(
        [*context.columns, pa.array(numbers, pa.int64()), pa.array(bodies, pa.string())],
        names=[*batch.schema.names, PAGE_NO, "body"],
    )
