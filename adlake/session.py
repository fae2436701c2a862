"""Where a run may write: the shared folder that the cluster names."""

from __future__ import annotations

import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

_LOCAL_BASE: dict[str, str] = {}
CALLS = 16  # of the file system at once


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, from ``spark.checkpoint.dir``.

    Only a local-mode session may do without the setting; it then gets one
    temporary folder per application. On a cluster a missing setting is an error,
    because a machine-local folder would lose data with its executor.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = context.applicationId
    if app not in _LOCAL_BASE:
        _LOCAL_BASE[app] = tempfile.mkdtemp(prefix="adlake-")
    return _LOCAL_BASE[app]


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared folder; nothing is created until written."""
    return f"{shared_dir(spark)}/adlake/{label}-{uuid.uuid4().hex}"


_SETTINGS: dict[str, object] = {}


def _file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it knows it. The settings are read
    once per application: a copy for each of many small calls would be most of their time."""
    app = spark.sparkContext.applicationId
    if app not in _SETTINGS:
        _SETTINGS[app] = spark._jsparkSession.sessionState().newHadoopConf()
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(_SETTINGS[app]), where


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _file_system(spark, path)
    return files.exists(where)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether the job that wrote a folder has committed."""
    return exists(spark, f"{path}/_SUCCESS")


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none if there is no folder. They come over as one text, as
    a call for each of thousands of days would take seconds; no name may hold a comma."""
    files, where = _file_system(spark, path)
    if not files.exists(where):
        return []
    found = spark._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(files.listStatus(where))
    text = spark._jvm.scala.runtime.ScalaRunTime.stringOf(found)  # Array(a, b)
    return sorted(one.rsplit("/", 1)[-1] for one in text[len("Array("):-1].split(", ") if one)


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Rename a file or folder within its file system; the new name must be free."""
    if exists(spark, new):
        raise OSError(f"cannot rename {old}: {new} is there")
    rename_all(spark, [(old, new)])


def rename_all(spark: SparkSession, pairs: list[tuple[str, str]]) -> None:
    """Rename several, some at a time; whoever calls has made sure that the new names are free,
    as a folder renamed onto another one would become its child."""
    if not pairs:
        return
    files, _ = _file_system(spark, pairs[0][0])
    path = spark._jvm.org.apache.hadoop.fs.Path
    for parent in {new.rsplit("/", 1)[0] for _, new in pairs}:
        files.mkdirs(path(parent))

    def one(pair):
        if not files.rename(path(pair[0]), path(pair[1])):
            raise OSError(f"cannot rename {pair[0]} to {pair[1]}")

    with ThreadPoolExecutor(CALLS) as pool:
        list(pool.map(one, pairs))


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or a whole folder, if it is there."""
    files, where = _file_system(spark, path)
    files.delete(where, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, under its name only when it is whole."""
    files, where = _file_system(spark, f"{path}.part")
    out = files.create(where, True)
    out.write(bytearray(text.encode()))
    out.close()
    rename(spark, f"{path}.part", path)


def read_text(spark: SparkSession, path: str) -> str:
    files, where = _file_system(spark, path)
    found = files.open(where)
    try:
        return bytes(found.readAllBytes()).decode()
    finally:
        found.close()


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder that ``run_dir`` has named."""
    if not path.startswith(f"{shared_dir(spark)}/adlake/"):
        raise ValueError(f"not a run folder: {path}")
    remove(spark, path)
