"""Writing tables: keyed upsert, full replace, staged replace of several tables.

Two back ends, chosen by what the table's catalog can do:

* *native*: a catalog with row-level operations gets ``mergeInto`` and
  ``createOrReplace``; commits are then the table format's own. No such catalog is
  available where this was built, so that path is untested.
* *rewrite*: plain Parquet, as a catalog table or a folder.

How the rewrite upsert keeps results whole. Every key contains the partition day, so a
matched row never changes partition and only the touched days are rewritten:

1. stage the source (one evaluation; strict checks fail here, before any target changes)
2. touched days, and duplicate keys, from the staged copy
3. kept = target rows of the touched days without a partner in the source
4. write kept + source once, by day, into a hidden folder of the table, and switch day by
   day: a catalog table's partition gets the new folder as its location, a plain folder's
   day is renamed away and the new one into its place

Rows of touched days are written once. A run that dies before step 4 has ended leaves the
table as it was. One that dies while switching is finished by ``finish_upserts``, which the
next upsert calls first; a hidden folder that is not complete is removed. There must be one
writer at a time, and days become visible one after another. With ``staging`` a copy of the
merged days is kept, which ``publish_staged`` can publish again, any number of times; that
copy is a second write, as is what a table gets whose partitions the catalog does not know.

A replaced table is staged beside its place, too, and switched in two phases: a manifest is
written when all tables are staged, and from then on ``finish_replace`` completes the
switches, however often it is called, wherever a run has died.

Merged rows are range-partitioned by day and key: tasks get equal shares whatever the
skew of the days, a day that holds most rows is split by key range, a run of small days
shares a task, and each file covers a narrow key range.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from adlake.operators.checks import BadRows, duplicate_keys
from adlake.session import (
    children, discard, exists, is_complete, read_text, remove, rename, rename_all, run_dir, write_text,
)
from adlake.specs import TableSpec

# Rows that one task of the final write sorts, some 200 MB of a fact in memory: more would spill.
ROWS_PER_TASK = 500_000

_FILE_FORMATS = {"parquet", "orc", "csv", "json", "text", "avro", "hive"}
_HIDDEN = "_upserts"        # in a table's folder; readers skip names that begin with _
_REPLACED = "_replaced"     # days that an upsert has renamed away
_PUBLISHED = "_PUBLISHED"   # in place of _SUCCESS once a catalog knows all days
_SNAPSHOTS = "_snapshots"   # in a replaced table's folder
_MANIFEST = "manifest.json"
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"
_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


class DuplicateKeys(Exception):
    """The source of an upsert names a key more than once."""


@dataclass(frozen=True)
class Target:
    """A table by catalog name, or a Parquet folder by path. A catalog table that has to be
    created takes ``path`` as its location, if given."""

    table: str | None = None
    path: str | None = None
    native_format: str = "iceberg"

    def is_native(self, spark: SparkSession) -> bool:
        """Whether the table's catalog supports row-level operations."""
        if self.table is None:
            return False
        parts = self.table.split(".")
        other = len(parts) > 2 and parts[0] != "spark_catalog"
        if other and not spark.conf.get(f"spark.sql.catalog.{parts[0]}", None):
            return True  # not bound in this session: its name is all there is
        if not spark.catalog.tableExists(self.table):
            return other or spark.conf.get("spark.sql.catalog.spark_catalog", "builtin") != "builtin"
        return self.described(spark).get("Provider", "").lower() not in _FILE_FORMATS

    def described(self, spark: SparkSession) -> dict[str, str]:
        """What the catalog says of the table: Provider, Location, Partition Provider, ..."""
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {self.table}").collect()
        return {r["col_name"]: r["data_type"] for r in rows}

    def home(self, spark: SparkSession) -> str:
        """The folder that the table owns, whatever snapshot it shows."""
        if self.table is None:
            return self.path
        if spark.catalog.tableExists(self.table):
            return self.described(spark)["Location"].split(f"/{_SNAPSHOTS}/")[0]
        database, _, name = self.table.rpartition(".")
        base = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
        return self.path or f"{base.rstrip('/')}/{name}"

    def read(self, spark: SparkSession, spec: TableSpec) -> DataFrame:
        """The rows now in the table; none if it does not exist."""
        if self.table is not None:
            if not spark.catalog.tableExists(self.table):
                return spark.createDataFrame([], spec.schema)
            return spark.table(self.table).select(*spec.columns)
        try:
            found = spark.read.schema(spec.schema).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return spark.createDataFrame([], spec.schema)
            raise
        return found.select(*spec.columns)


@dataclass(frozen=True)
class WriteReport:
    """What a write did: rows of the source, days rewritten, and for a replace the name by
    which ``finish_replace`` knows it."""

    rows: int
    days: int = 0
    staging: str | None = None


def table_name(catalog: str, database: str, table: str) -> str:
    return f"{catalog}.{database}.{table}"


def catalog_confs(catalog: str, implementation: str, warehouse: str, **options: str) -> dict[str, str]:
    """Session settings that bind a catalog; ``catalog_impl`` becomes ``catalog-impl``."""
    prefix = f"spark.sql.catalog.{catalog}"
    confs = {prefix: implementation, f"{prefix}.warehouse": warehouse}
    return confs | {f"{prefix}.{k.replace('_', '-')}": v for k, v in options.items()}


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Columns of the table in order and type; the source may carry more."""
    return df.select(*(F.col(f.name).cast(f.data_type).alias(f.name) for f in spec.fields))


def create_if_missing(spark: SparkSession, target: Target, spec: TableSpec) -> None:
    """Declare the table; an existing one is never altered. Folders need no declaration."""
    if target.table is None:
        return
    native = target.is_native(spark)
    using = target.native_format if native else "parquet"
    part = spec.partition and (f"days({spec.partition})" if native else spec.partition)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {target.table} ({spec.ddl()}) USING {using}"
        + (f" PARTITIONED BY ({part})" if part else "")
        + (f" LOCATION '{target.path}'" if target.path and not native else "")
    )


# --- staging -------------------------------------------------------------------------


def _stage(df: DataFrame, path: str) -> tuple[DataFrame, int]:
    """Write once, count in the same pass, and read back."""
    seen = Observation("staged rows")
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get["rows"]


# --- upsert --------------------------------------------------------------------------


def _touched(staged: DataFrame, day: str) -> list:
    """The distinct days of the source. The calendar bounds their number, not the data."""
    return [r[0] for r in staged.select(day).distinct().collect()]


def _of_days(target: DataFrame, day: str, values: list) -> DataFrame:
    """Target rows of the touched days. Literals prune partitions when the scan is planned."""
    hit = F.col(day).isin([v for v in values if v is not None])
    return target.filter(hit | F.col(day).isNull() if None in values else hit)


def _same_key(left: DataFrame, right: DataFrame, keys: Iterable[str]) -> Column:
    """Plain equality: a null key never matches, as in MERGE."""
    return reduce(and_, (left[k] == right[k] for k in keys))


def _write_tasks(spark: SparkSession, rows: int, days: int) -> int:
    """Tasks of the final write: enough for the rows, and at least one per touched day as
    far as there are cores, since each day costs a file."""
    return max(-(-rows // ROWS_PER_TASK), min(days, spark.sparkContext.defaultParallelism))


def _not_older(staged: DataFrame, current: DataFrame, spec: TableSpec, stamp: str) -> DataFrame:
    """Source rows that the target does not hold in a later version."""
    held = current.select(*spec.key, F.col(stamp).alias("_held")).alias("held")
    joined = staged.alias("source").join(held, _same_key(staged, held, spec.key), "left")
    fresh = F.col("_held").isNull() | (F.col("_held") <= F.col(f"source.{stamp}"))
    return joined.filter(fresh).select("source.*")


def merged_days(target: DataFrame, staged: DataFrame, spec: TableSpec, values: list, rows: int,
                newer_by: str | None = None) -> DataFrame:
    """Complete new content of the touched days. Counting the current rows reads no column,
    only the row counts in the files' footers."""
    current = _of_days(target, spec.partition, values).alias("target")
    held = current.count()
    tasks = _write_tasks(target.sparkSession, rows + held, len(values))
    merged = staged
    if held:  # else there is nothing to compare the source with
        if newer_by:
            staged = _not_older(staged, current, spec, newer_by)
        keys = staged.select(*spec.key).alias("source")
        kept = current.join(keys, _same_key(current, keys, spec.key), "left_anti")
        merged = kept.unionByName(staged)
    order = [spec.partition, *(k for k in spec.key if k != spec.partition)]
    return merged.repartitionByRange(tasks, *order).sortWithinPartitions(*order)


def publish(spark: SparkSession, merged: DataFrame, target: Target, spec: TableSpec) -> None:
    """Replace exactly the day partitions present in ``merged``."""
    if target.table is None:
        writer = merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(spec.partition).parquet(target.path)
        return
    # insertInto ignores the writer option and would drop all other days, so the mode has
    # to come from the session; it takes columns by position, partition column last.
    order = [c for c in spec.columns if c != spec.partition] + [spec.partition]
    before = spark.conf.get(_OVERWRITE_MODE)
    spark.conf.set(_OVERWRITE_MODE, "dynamic")
    try:
        merged.select(*order).write.insertInto(target.table, overwrite=True)
    finally:
        spark.conf.set(_OVERWRITE_MODE, before)
    spark.catalog.refreshTable(target.table)


def publish_staged(spark: SparkSession, staging: str, target: Target, spec: TableSpec) -> None:
    """Finish, or repeat, an upsert from its staging folder. A folder that the dead run had
    not completed is refused; its target is untouched and the run can be started again."""
    folder = f"{staging}/merged"
    if not is_complete(spark, folder):
        raise ValueError(f"nothing to publish, staging was cut off: {folder}")
    publish(spark, spark.read.schema(spec.schema).parquet(folder), target, spec)


# --- days switched in place ----------------------------------------------------------


def _switches_days(spark: SparkSession, target: Target) -> bool:
    """Whether single days can be switched: a plain folder, or Parquet partitions that the
    catalog knows. Other tables take their rows through ``publish``."""
    if target.table is None:
        return True
    found = target.described(spark)
    return found.get("Provider", "").lower() == "parquet" and found.get("Partition Provider") == "Catalog"


def _days(spark: SparkSession, folder: str) -> list[str]:
    return [name for name in children(spark, folder) if "=" in name]


def _switch_renamed(spark: SparkSession, work: str, target: Target) -> None:
    """Move each day of ``work`` into the table's folder. What is still in ``work`` is to do:
    a day whose old folder is away already is only moved in. Days that the table does not
    have yet go in together; a day that it has is missing only between its two renames."""
    staged, live = _days(spark, work), set(_days(spark, target.path))
    rename_all(spark, [(f"{work}/{day}", f"{target.path}/{day}") for day in staged if day not in live])
    for day in staged:
        if day in live:
            rename(spark, f"{target.path}/{day}", f"{work}/{_REPLACED}/{day}")
            rename(spark, f"{work}/{day}", f"{target.path}/{day}")
    remove(spark, work)


def _spec_of(day: str) -> str:
    column, value = day.split("=", 1)
    return f"PARTITION (`{column}` = " + ("null)" if value == _NO_DAY else f"'{value}')")


def _switch_located(spark: SparkSession, work: str, target: Target) -> None:
    """Point each day's partition at its folder in ``work``. New days are declared in one
    statement; a known day is one metadata change, and its old folder goes afterwards."""
    home, staged = target.home(spark), _days(spark, work)
    known = {r[0] for r in spark.sql(f"SHOW PARTITIONS {target.table}").collect()}
    fresh = [f"{_spec_of(day)} LOCATION '{work}/{day}'" for day in staged if day not in known]
    if fresh:
        spark.sql(f"ALTER TABLE {target.table} ADD IF NOT EXISTS {' '.join(fresh)}")
    old = []
    for day in staged:
        if day in known:
            rows = spark.sql(f"DESCRIBE TABLE EXTENDED {target.table} {_spec_of(day)}").collect()
            shown = next(r["data_type"] for r in rows if r["col_name"] == "Location")
            spark.sql(f"ALTER TABLE {target.table} {_spec_of(day)} SET LOCATION '{work}/{day}'")
            if not shown.endswith(f"{work}/{day}".split(":", 1)[-1]):
                old.append(shown)
    rename(spark, f"{work}/_SUCCESS", f"{work}/{_PUBLISHED}")
    spark.catalog.refreshTable(target.table)
    for folder in old:
        if folder.startswith(home):
            remove(spark, folder)
    for name in children(spark, f"{home}/{_HIDDEN}"):
        if not _days(spark, f"{home}/{_HIDDEN}/{name}"):
            remove(spark, f"{home}/{_HIDDEN}/{name}")


def _switch_days(spark: SparkSession, work: str, target: Target) -> None:
    (_switch_renamed if target.table is None else _switch_located)(spark, work, target)


def finish_upserts(spark: SparkSession, target: Target) -> int:
    """Complete what a dead upsert had written whole, and remove what it had not; the number
    of upserts completed. Nothing else may write to the table meanwhile."""
    if target.table is not None and not spark.catalog.tableExists(target.table):
        return 0
    hidden, done = f"{target.home(spark)}/{_HIDDEN}", 0
    for name in children(spark, hidden):
        work = f"{hidden}/{name}"
        if is_complete(spark, work):
            _switch_days(spark, work, target)
            done += 1
        elif not exists(spark, f"{work}/{_PUBLISHED}"):
            if target.table is None and children(spark, f"{work}/{_REPLACED}"):
                raise ValueError(f"days are away and the upsert is incomplete: {work}")
            remove(spark, work)
    return done


def upsert(df: DataFrame, target: Target, spec: TableSpec, *, check_duplicates: bool = True,
           durable: bool = True, staging: str | None = None, newer_by: str | None = None,
           accept: Callable[[], None] | None = None) -> WriteReport:
    """Overwrite matching rows in every column, insert the others, keep the rest.

    An empty source leaves the target alone. A duplicate key is an error; callers that
    have made keys unique (``checks.latest_per_key``) may switch the check off.
    ``staging`` names the folder to stage in and keeps it; without it a fresh one is used
    and removed after success. ``durable=False`` overwrites the days in place, which cannot be
    finished if it is cut off. ``newer_by`` names a column that orders versions: a row that
    the table holds in a later one stays as it is. ``accept`` is called when the source is
    staged and may refuse it by an error (``checks.Problems.refuse``).
    """
    spark = df.sparkSession
    work = staging or run_dir(spark, f"upsert-{spec.name}")
    try:
        report, days = _upsert(df, target, spec, work, check_duplicates, durable, staging is not None, newer_by, accept)
    except BadRows:
        if staging is None:
            discard(spark, work)
        raise
    if days:
        _switch_days(spark, days, target)
    if staging is None:
        discard(spark, work)
    return report


def stage_upsert(df: DataFrame, target: Target, spec: TableSpec, *, check_duplicates: bool = True,
                 newer_by: str | None = None) -> WriteReport:
    """An upsert up to its switch: the new days stand ready, readers see the old ones.
    ``finish_upserts``, or the next upsert, switches them."""
    spark = df.sparkSession
    work = run_dir(spark, f"upsert-{spec.name}")
    report, _ = _upsert(df, target, spec, work, check_duplicates, True, False, newer_by, None)
    discard(spark, work)
    return report


def _upsert(df: DataFrame, target: Target, spec: TableSpec, work: str, check_duplicates: bool,
            durable: bool, keep: bool, newer_by: str | None, accept: Callable[[], None] | None) -> tuple[WriteReport, str | None]:
    """What was written, and the folder of days that are still to be switched."""
    spark = df.sparkSession
    native = target.is_native(spark)
    if not native:
        finish_upserts(spark, target)
    staged, rows = _stage(conform(df, spec), f"{work}/source")
    if accept:
        accept()
    if rows == 0:
        return WriteReport(0), None
    if check_duplicates:
        repeated = duplicate_keys(staged, spec.key).limit(3).collect()
        if repeated:
            raise DuplicateKeys(f"{spec.name}: {[r.asDict() for r in repeated]}")
    create_if_missing(spark, target, spec)
    values = _touched(staged, spec.partition)
    if native:
        _merge_native(staged, target, spec, values, newer_by)
        return WriteReport(rows, len(values)), None
    merged = merged_days(target.read(spark, spec), staged, spec, values, rows, newer_by)
    if durable and not keep and _switches_days(spark, target):
        days = f"{target.home(spark)}/{_HIDDEN}/{uuid.uuid4().hex}"
        merged.write.partitionBy(spec.partition).parquet(days)
        return WriteReport(rows, len(values)), days
    if durable:
        merged.write.partitionBy(spec.partition).parquet(f"{work}/merged")
        publish_staged(spark, work, target, spec)
    else:
        publish(spark, merged, target, spec)
    return WriteReport(rows, len(values)), None


def _merge_native(staged: DataFrame, target: Target, spec: TableSpec, values: list, newer_by: str | None) -> None:
    """The table format's own MERGE, with the touched days as literals to prune its scan."""
    match = [f"{target.table}.{k} = source.{k}" for k in spec.key]
    if None not in values:
        days = ", ".join(f"DATE'{v}'" for v in sorted(values))
        match.append(f"{target.table}.{spec.partition} IN ({days})")
    merge = staged.alias("source").mergeInto(target.table, F.expr(" AND ".join(match)))
    newer = F.expr(f"source.{newer_by} >= {target.table}.{newer_by}") if newer_by else None
    (merge.whenMatched(newer) if newer_by else merge.whenMatched()).updateAll().whenNotMatched().insertAll().merge()


# --- replace -------------------------------------------------------------------------


def _with_others(rows: DataFrame, target: Target, spec: TableSpec, scope: DataFrame) -> DataFrame:
    """Rows of the accounts pulled, and the table's rows of all other accounts."""
    others = target.read(rows.sparkSession, spec)
    return others.join(scope.select("ad_account_id"), "ad_account_id", "left_anti").unionByName(rows)


def stage_replace(parts: Iterable[tuple[DataFrame, Target, TableSpec]], scope: DataFrame | None = None,
                  staging: str | None = None, accept: Callable[[], None] | None = None) -> str:
    """Compute every frame and write it beside its table; the name by which ``finish_replace``
    switches them. Until this returns no table has changed, and none will."""
    parts = list(parts)
    if not parts:
        raise ValueError("nothing to replace")
    session = parts[0][0].sparkSession
    staging = staging or run_dir(session, "replace")
    items, made = [], []
    try:
        for number, (df, target, spec) in enumerate(parts):
            native = target.is_native(session)
            name = f"{staging.rsplit('/', 1)[-1]}-{number}"
            home = None if native else target.home(session)
            folder = (f"{staging}/{number}" if native else f"{home}__{name}" if target.table is None
                      else f"{home}/{_SNAPSHOTS}/{name}")
            made.append(folder)
            seen = Observation("replaced rows")
            counted = conform(df, spec).observe(seen, F.count(F.lit(1)).alias("rows"))
            whole = counted if scope is None else _with_others(counted, target, spec, scope)
            whole.write.parquet(folder)
            items.append({"table": target.table, "path": target.path, "native_format": target.native_format, "native": native,
                          "folder": folder, "rows": seen.get["rows"], "ddl": spec.ddl()})
        if accept:
            accept()
    except Exception:
        for folder in made:
            remove(session, folder)
        raise
    write_text(session, f"{staging}/{_MANIFEST}", json.dumps(items))
    return staging


def finish_replace(spark: SparkSession, staging: str) -> list[WriteReport]:
    """Switch every table of a staged replace that is not switched yet. One that had not been
    staged whole is refused: its tables are untouched, the run can be started again."""
    if not exists(spark, f"{staging}/{_MANIFEST}"):
        raise ValueError(f"nothing to finish, staging was cut off or is done: {staging}")
    items = json.loads(read_text(spark, f"{staging}/{_MANIFEST}"))
    for item in items:
        _switch(spark, item)
    remove(spark, staging)
    return [WriteReport(item["rows"], staging=staging) for item in items]


def _switch(spark: SparkSession, item: dict) -> None:
    """One table of a manifest. A folder that is gone has been switched."""
    table, folder = item["table"], item["folder"]
    if item["rows"] == 0:
        remove(spark, folder)
    elif item["native"]:
        spark.read.parquet(folder).writeTo(table).using(item["native_format"]).createOrReplace()
    elif table is not None:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({item['ddl']}) USING parquet LOCATION '{folder}'")
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(table)
    else:
        away = f"{folder}-old"
        if exists(spark, folder):
            if exists(spark, item["path"]):
                rename(spark, item["path"], away)
            rename(spark, folder, item["path"])
        remove(spark, away)


def expire_snapshots(spark: SparkSession, target: Target) -> int:
    """Remove a replaced catalog table's snapshots except the one it shows; how many went."""
    shown, home = target.described(spark)["Location"], target.home(spark)
    old = [n for n in children(spark, f"{home}/{_SNAPSHOTS}") if not shown.endswith(f"/{_SNAPSHOTS}/{n}")]
    for name in old:
        remove(spark, f"{home}/{_SNAPSHOTS}/{name}")
    return len(old)


def replace_all(parts: Iterable[tuple[DataFrame, Target, TableSpec]], scope: DataFrame | None = None,
                staging: str | None = None, accept: Callable[[], None] | None = None) -> list[WriteReport]:
    """Make each table exactly its frame. All frames are computed and staged before the
    first table changes; an empty frame leaves its table alone.

    A catalog table is switched to its staged folder by one metadata change, so readers see
    the old rows or the new ones; old snapshots stay until ``expire_snapshots``. A plain folder
    is renamed away and the staged one into its place. ``staging`` names the run in advance,
    so that whoever finds it dead can call ``finish_replace`` with that name.
    """
    parts = list(parts)
    return finish_replace(parts[0][0].sparkSession, stage_replace(parts, scope, staging, accept)) if parts else []


def replace(df: DataFrame, target: Target, spec: TableSpec,
            scope: DataFrame | None = None) -> WriteReport:
    """Make the table exactly ``df``, or with ``scope`` (a frame of accounts) exactly ``df``
    for those accounts and unchanged for the others."""
    return replace_all([(df, target, spec)], scope)[0]
