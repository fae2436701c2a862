"""Landed responses to records.

A *responses* frame has one row per response: a ``body`` column with the JSON text and any
number of request columns (account, window start, page number, ...), which every function
here carries along. Responses may be landed as a Parquet table (what ``paged.fetch_pages``
gives) or as one file per response (``read_response_files``). A body is bounded by what
one request may ask for; everything after it is narrow, so records never shuffle here.

Body shapes:

* listing     ``{"items": [{...}, ...], "bookmark": ...}``
* report      ``[{"DATE": ..., "AD_ID": ..., ...}, ...]``
* breakdown   ``{"data": [{"targeting_value": ..., "metrics": {...}}, ...]}``
* options     ``[{"code": "name", ...}, ...]``
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.functions.lists import last_wins
from adlake.specs import DATE_KEY, TableSpec

RAW = "raw"            # struct of payload texts
ITEM = "item"          # JSON text of one listed entity
PAGE_NO, ITEM_POS = "page_no", "item_pos"
IDS = "ids"            # of one page
VALUE = "targeting_value"
HAS_DATE = "has_date"  # whether the record carries a date key at all

# How files of bodies are to be written. The Parquet reader unpacks up to 4,096 rows of a row group
# into one buffer; groups of the usual size hold more text than a task's memory, or an array.
BODY_FILES = {
    "parquet.block.size": str(2 << 20), "parquet.block.size.row.check.min": "8", "parquet.block.size.row.check.max": "8",
    "parquet.page.size.row.check.min": "8",
}

_PARSED = "_parsed"
_FLAGS = "_has_date"


def read_response_files(spark: SparkSession, path: str, partitions: str = "") -> DataFrame:
    """One row per file. ``partitions`` names the ``key=value`` folder columns as a DDL list,
    so that an id such as ``007`` stays text."""
    schema = "value string" + (f", {partitions}" if partitions else "")
    files = spark.read.schema(schema).text(path, wholetext=True)
    return files.withColumnRenamed("value", "body")


# --- unreadable bodies ---------------------------------------------------------------


def _roots(body: Column, schema) -> Column:
    """The body as the first of two elements of an array. The JSON reader accepts text after
    a value's end; inside an array it is a further element, or an error."""
    if isinstance(schema, str):
        schema = T.DataType.fromDDL(schema)
    return F.from_json(F.concat(F.lit("["), body, F.lit(",null]")), T.ArrayType(schema))


def _envelope_ok(body: Column, value: Column, key: str) -> Column:
    """An object is readable if its list was read, or if it is valid and lacks the key."""
    found = F.variant_get(F.try_parse_json(body), f"$.{key}", "variant")
    object_ = F.trim(F.regexp_replace(body, r"^\s+", "")).startswith("{")
    absent = object_ & F.try_parse_json(body).isNotNull() & F.schema_of_variant(found).isNull()
    return F.when(value.isNotNull(), True).otherwise(absent)


_SHAPES = {
    "listing": ("items", "items array<string>"),
    "report": (None, "array<struct<DATE:string>>"),
    "breakdown": ("data", "data array<struct<targeting_value:string>>"),
    "options": (None, "array<map<string,string>>"),
}


def _readable(body: Column, roots: Column, key: str | None) -> Column:
    """Whether a body is one value of the expected shape, and nothing after it."""
    root = F.get(roots, F.lit(0))
    shape = root.isNotNull() if key is None else _envelope_ok(body, root[key], key)
    return F.coalesce((F.size(roots) == 2) & shape, F.lit(False))


def split_unreadable(responses: DataFrame, shape: str) -> tuple[DataFrame, DataFrame]:
    """(readable, unreadable) responses. Valid JSON without its list counts as readable and
    empty; anything that is not JSON of the expected root is unreadable."""
    key, schema = _SHAPES[shape]
    ok = _readable(F.col("body"), _roots(F.col("body"), schema), key)
    checked = responses.withColumn("_ok", ok)
    return checked.filter("_ok").drop("_ok"), checked.filter("not _ok").drop("_ok")


def _parse(responses: DataFrame, schema, key: str | None, unread: Observation | None = None) -> DataFrame:
    """Replace the body by its parsed list; an unreadable body aborts the job, in the same
    pass that reads it and so before anything is written. With ``unread`` such bodies give no
    records and are observed instead: their number and the first of them in text order."""
    frame = responses.withColumn(_PARSED, _roots(F.col("body"), schema))
    root = F.get(F.col(_PARSED), F.lit(0))
    ok = _readable(F.col("body"), F.col(_PARSED), key)
    if unread is not None:
        frame = frame.withColumn("_ok", ok).observe(
            unread, F.count_if(~F.col("_ok")).alias("n"), F.min(F.when(~F.col("_ok"), F.left("body", F.lit(200)))).alias("example"))
        return frame.withColumn(_PARSED, F.when(F.col("_ok"), root[key] if key else root)).drop("_ok")
    message = F.concat(F.lit("unreadable response: "), F.left("body", F.lit(200)))
    return frame.withColumn(_PARSED, F.when(ok, root[key] if key else root).otherwise(F.raise_error(message)))


def _listed(frame: DataFrame, columns: list[str], pos: str, name: str) -> DataFrame:
    """One row per list element. The outer form with a filter on the position keeps the
    optimizer from copying the parsed list, and so the parsing, into a filter of its own."""
    rows = frame.select(*columns, F.posexplode_outer(_PARSED).alias(pos, name))
    return rows.filter(F.col(pos).isNotNull())


def _context(responses: DataFrame) -> list[str]:
    return [c for c in responses.columns if c != "body"]


# --- listings ------------------------------------------------------------------------


def listed_ids(pages: DataFrame, name: str = "id") -> DataFrame:
    """Ids of all listed objects, without keeping the objects' text. An object without an id
    aborts the job, since its data would be missing without notice."""
    context = [c for c in _context(pages) if c != name]
    frame = _parse(pages, "items array<struct<id:string>>", "items")
    items = _listed(frame, context, ITEM_POS, "_item")
    missing = F.raise_error(F.concat(F.lit("listed object without id at "), F.col(ITEM_POS).cast("string")))
    return items.select(*context, ITEM_POS, F.coalesce(F.col("_item.id"), missing).alias(name))


def listed_pages(pages: DataFrame) -> DataFrame:
    """One row per page with the ``ids`` of its objects, in order; for ``batching``, which
    numbers pages and not ids. An object without an id aborts the job."""
    frame = _parse(pages, "items array<struct<id:string>>", "items")
    missing = F.raise_error(F.lit("listed object without id")).cast("string")
    ids = F.transform(F.coalesce(_PARSED, F.array()), lambda item: F.coalesce(item["id"], missing))
    return frame.select(*_context(pages), ids.alias(IDS))


def listed_accounts(pages: DataFrame) -> DataFrame:
    return listed_ids(pages, "ad_account_id")


def listed_items(pages: DataFrame, unread: Observation | None = None) -> DataFrame:
    """Whole listed objects as JSON text, nested values included."""
    frame = _parse(pages, "items array<string>", "items", unread)
    return _listed(frame, _context(pages), ITEM_POS, ITEM)


def entity_records(pages: DataFrame, spec: TableSpec, unread: Observation | None = None) -> DataFrame:
    """Listed objects with the payload keys of ``spec`` read once into a struct of texts."""
    return listed_items(pages, unread).withColumn(RAW, F.from_json(ITEM, spec.payload_schema))


# --- reports -------------------------------------------------------------------------


def _present_dates(body: Column, missing: Column, schema: str, pick) -> Column:
    """Per record, whether it has a date key, known only by parsing into maps.

    A struct cannot tell an absent key from a null. The second parse runs only for the
    rare body in which some date is null; elsewhere the flags stay NULL.
    """
    maps = F.from_json(body, schema)
    return F.when(missing, F.transform(pick(maps), lambda m: F.map_contains_key(m, DATE_KEY)))


def _exploded(frame: DataFrame, context: list[str], record: Column, *extra: Column) -> DataFrame:
    rows = _listed(frame, [*context, _FLAGS], "_pos", "_rec")
    # a null element of the list stays a row of nulls, for the required-field check to see
    flag = F.coalesce(F.get(F.col(_FLAGS), F.col("_pos")), record[DATE_KEY].isNotNull())
    return rows.select(*context, *extra, record.alias(RAW), flag.alias(HAS_DATE))


def report_records(responses: DataFrame, spec: TableSpec, unread: Observation | None = None) -> DataFrame:
    """Records of a report: one per entity and day."""
    fields = T.ArrayType(spec.payload_schema)
    frame = _parse(responses, fields, None, unread)
    missing = F.exists(_PARSED, lambda r: r[DATE_KEY].isNull())
    flags = _present_dates(F.col("body"), missing, "array<map<string,string>>", lambda m: m)
    return _exploded(frame.withColumn(_FLAGS, flags), _context(responses), F.col("_rec"))


def breakdown_records(responses: DataFrame, spec: TableSpec, unread: Observation | None = None) -> DataFrame:
    """Records of a breakdown: one per entity, day and breakdown value."""
    metrics = spec.payload_schema
    row = T.StructType().add(VALUE, "string").add("metrics", metrics)
    frame = _parse(responses, T.StructType().add("data", T.ArrayType(row)), "data", unread)
    missing = F.exists(_PARSED, lambda r: r["metrics"][DATE_KEY].isNull())
    flags = _present_dates(
        F.col("body"), missing, "data array<struct<metrics:map<string,string>>>",
        lambda d: F.transform(d["data"], lambda r: r["metrics"]),
    )
    return _exploded(
        frame.withColumn(_FLAGS, flags), _context(responses),
        F.col("_rec.metrics"), F.col(f"_rec.{VALUE}").alias(VALUE),
    )


# --- code to name --------------------------------------------------------------------


def option_names(responses: DataFrame) -> DataFrame:
    """``(code, name)`` merged over all objects of the lists; of a repeated code the last
    one wins, in the order of pages, objects and keys."""
    frame = _parse(responses, "array<map<string,string>>", None)
    page = F.col(PAGE_NO) if PAGE_NO in responses.columns else F.lit(0)
    objects = _listed(frame.withColumn("_page", page), ["_page"], "_pos", "_object")
    entries = objects.select("_page", "_pos", F.posexplode("_object").alias("_key", "code", "name"))
    merged = last_wins(entries, "code", "name", "_page", "_pos", "_key")
    return merged.select(F.struct("code", "name").alias(RAW))
