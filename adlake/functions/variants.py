"""JSON columns as variants: list elements as rows, and the shapes that a column holds.

The entity tables keep nested values as JSON text. What such a column holds is the API's
matter and may change; ``shapes`` tells its present form, ``changed_shapes`` what differs
between two pulls. Both aggregate on the JVM, one partial shape per task and column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_variant(column) -> Column:
    """JSON text as a variant; text that is not JSON is null."""
    return F.try_parse_json(column)


def element_rows(df: DataFrame, column: str, keep: list[str], fields: dict[str, tuple[str, str]]) -> DataFrame:
    """One row per element of a JSON list: ``keep``, its 0-based ``pos``, and typed ``fields`` of
    the element as {name: (path, type)}. Rows whose column is not a list give none; a field
    that is absent or of another type is null."""
    held = df.select(*keep, as_variant(column).alias("_list"))
    lists = held.where(F.schema_of_variant("_list").startswith("ARRAY"))
    elements = lists.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("_list").outer()))
    typed = (F.try_variant_get("value", path, kind).alias(name) for name, (path, kind) in fields.items())
    return elements.select(*keep, F.col("pos").cast("bigint").alias("pos"), *typed)


def shapes(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, shape, n): the merged shape of each JSON column's values, and how many there
    are; null where a column has none."""
    aggregates = [a for c in columns for a in (
        F.schema_of_variant_agg(as_variant(c)).alias(f"{c}__shape"), F.count(as_variant(c)).alias(f"{c}__n"))]
    found = df.agg(*aggregates)
    rows = F.array(*(F.struct(F.lit(c).alias("column"), F.when(F.col(f"{c}__n") > 0, F.col(f"{c}__shape")).alias("shape"),
                              F.col(f"{c}__n").alias("n")) for c in columns))
    return found.select(F.inline(rows))


def changed_shapes(before: DataFrame, after: DataFrame, columns: list[str]) -> DataFrame:
    """(column, before, after) of the columns whose shape differs between two tables."""
    old = shapes(before, columns).select("column", F.col("shape").alias("before"))
    new = shapes(after, columns).select("column", F.col("shape").alias("after"))
    return old.join(new, "column").where(~F.col("before").eqNullSafe(F.col("after")))


def object_keys(df: DataFrame, column: str) -> DataFrame:
    """(key, n): the keys of a JSON column's objects, and how many objects have each."""
    held = df.select(as_variant(column).alias("_object"))
    objects = held.where(F.schema_of_variant("_object").startswith("OBJECT"))
    entries = objects.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("_object").outer()))
    return entries.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
