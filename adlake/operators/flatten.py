"""Records to typed rows, for every table, from its specification.

``strict`` gives table rows and aborts the run at a value that is missing or cannot be
read, in the pass that computes it; as writes are staged (see ``tables``), no target has
been touched by then. ``typed`` gives nulls instead and keeps the raw texts, for
``checks.quarantine`` to judge. Both are one projection of JVM expressions: no Python per
row, no shuffle, every value cast once, and unused columns are never cast.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.functions import values
from adlake.sources.landed import HAS_DATE, ITEM, RAW, VALUE
from adlake.specs import DATE_KEY, Field, TableSpec

_VARIANT, _DATE = "_variant", "_date"

# Kinds whose text may be unreadable.
CAST_KINDS = {"long", "double", "bool", "date", "unix"}

_CASTS = {
    "text": lambda text: text,
    "long": values.to_long,
    "double": values.to_double,
    "bool": values.to_bool,
    "date": values.to_date,
    "unix": values.unix_time,
}


def _raw(field: Field) -> Column:
    """The payload text of a field; the date is settled beforehand."""
    return F.col(_DATE) if field.raw == DATE_KEY else F.col(RAW)[field.raw]


def date_text(default: Column) -> Column:
    """The record's own date; the window start only where the key is absent, so that an
    explicit null stays null."""
    own = F.col(RAW)[DATE_KEY]
    return F.when(own.isNull() & ~F.col(HAS_DATE), default).otherwise(own)


def _in_small_methods(column: Column) -> Column:
    """The same value, by a lambda. A projection that holds one is compiled into small methods;
    else the casts of a wide table become one method, too large for the JVM to compile."""
    return F.get(F.transform(F.array(column), lambda same: same), F.lit(0))


def _column(field: Field, run_ts: Column) -> Column:
    raw = _raw(field) if field.raw else None
    if field.kind == "request":
        return _in_small_methods(F.col(field.name))
    if field.kind == "breakdown":
        return F.col(VALUE)
    if field.kind == "run":
        return run_ts
    if field.kind == "json":
        return values.json_text(raw, F.col(_VARIANT), field.raw)
    return _CASTS[field.kind](raw)


def _prepared(records: DataFrame, spec: TableSpec, default_date: str) -> DataFrame:
    """Records with the date text settled and, for JSON columns, the item as a variant."""
    if spec.partition:
        known = default_date in records.columns
        start = F.col(default_date).cast("string") if known else F.lit(None).cast("string")
        records = records.withColumn(_DATE, date_text(start))
    if any(f.kind == "json" for f in spec.fields):
        records = records.withColumn(_VARIANT, F.try_parse_json(ITEM))
    return records


def _checked(field: Field, column: Column, table: str) -> Column:
    """The value, or an error where it is unreadable or missing."""
    label = f"{table}.{field.name}"
    options = [column]
    if field.kind in CAST_KINDS:
        raw = _raw(field)
        message = F.concat(F.lit(f"{label} unreadable: "), raw)
        options.append(F.when(raw.isNotNull(), F.raise_error(message).cast(field.data_type)))
    if field.required:
        options.append(F.raise_error(F.lit(f"{label} missing")).cast(field.data_type))
    return F.coalesce(*options) if len(options) > 1 else column


def strict(records: DataFrame, spec: TableSpec, run_ts: dt.datetime,
           default_date: str = "start_date", keep: tuple[str, ...] = ()) -> DataFrame:
    """Table rows and the request columns to ``keep``; a bad value fails the job."""
    stamp = F.lit(run_ts)
    columns = (_checked(f, _column(f, stamp), spec.name).alias(f.name) for f in spec.fields)
    return _prepared(records, spec, default_date).select(*columns, *keep)


def typed(records: DataFrame, spec: TableSpec, run_ts: dt.datetime,
          default_date: str = "start_date", keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed columns of ``spec``, the request columns to ``keep``, and the raw struct.

    The account comes from the request column, whatever the payload says. ``default_date``
    names the request column with the window start.
    """
    stamp = F.lit(run_ts)
    columns = (_column(f, stamp).alias(f.name) for f in spec.fields)
    raw = F.col(RAW).withField(DATE_KEY, F.col(_DATE)) if spec.partition else F.col(RAW)
    return _prepared(records, spec, default_date).select(*columns, *keep, raw.alias(RAW))
