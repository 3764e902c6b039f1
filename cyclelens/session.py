"""Session settings and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


# Matches a salt where plans show it: in front of the column it is hashed with.
SALT_IN_PLAN = r"(?<=sha2\((?:cast\(|')?concat\().*?(?=, [\w'#]+\)(?: as binary\))?, 256)"


def session(app: str = "cyclelens", **settings: str) -> SparkSession:
    """A session with this project's settings. The master is left to spark-submit."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Keeps the salt of masked columns out of plans that are shown.
        .config("spark.sql.redaction.string.regex", SALT_IN_PLAN)
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder under `spark.checkpoint.dir`, which every executor can reach.

    That setting is taken as it is: whether its folder is shared cannot be seen from its
    name. Only a session whose executors are threads of the driver may go without it; it
    then uses a temporary folder.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="cyclelens-")
    folder = f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    for folders in _open_scopes[-1:]:
        folders.append(folder)
    return folder


_open_scopes: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes the work folders made inside the block when it ends.

    For jobs whose result is stored by then; a table handed on must not be read from a
    folder that goes."""
    folders: list[str] = []
    _open_scopes.append(folders)
    try:
        yield
    finally:
        _open_scopes.remove(folders)
        for folder in folders:
            delete_folder(spark, folder)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings that hold inside the block."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


# Settings that remove a shuffle's files as soon as the query that made them has ended, and not
# when the driver happens to collect its garbage. For queries whose result is stored.
FREE_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def file_system(spark: SparkSession, path: str):
    """Hadoop's handle on the file system that holds `path`, and the path itself."""
    base = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), base


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder, if it is there."""
    files, path = file_system(spark, folder)
    files.delete(path, True)


def folder_names(spark: SparkSession, pattern: str) -> list[str]:
    """Names of the folders that match a pattern; for `…/_SUCCESS`, of those that hold this
    mark of a complete write."""
    files, found = file_system(spark, pattern)
    paths = [s.getPath() for s in files.globStatus(found) or []]
    return sorted((p.getParent() if p.getName() == "_SUCCESS" else p).getName() for p in paths)


def written(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """`df` written to the shared work folder and read back.

    Cuts the lineage at a table that outlives any executor, so what is read twice is
    computed once.
    """
    path = work_folder(df.sparkSession, label)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


class Rounds:
    """A table that is written anew round by round. Only the newest one is kept."""

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark, self.label, self.folder = spark, label, None

    def put(self, df: DataFrame) -> DataFrame:
        """`df` written and read back. The table before it, which `df` may read, goes then."""
        path = work_folder(self.spark, self.label)
        df.write.parquet(path)
        if self.folder is not None:
            delete_folder(self.spark, self.folder)
        self.folder = path
        return self.spark.read.schema(df.schema).parquet(path).select(*df.columns)
