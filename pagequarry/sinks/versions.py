"""Tables that are replaced together.

A set of tables is written below a folder of its own, and a small file that
names the folder is moved into place last. A reader finds all tables of the old
set or all of the new one; a writer that fails in between changes nothing a
reader sees.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

POINTER = "CURRENT"
FOLDER = "versions"


def replace_tables(tables: dict[str, DataFrame], base: str, prefix: str = "") -> None:
    """Write ``tables`` as Parquet and make them the current ones at ``base``.

    The set before stays, for readers that have begun with it; older ones and
    what failed writers left are deleted.
    """
    spark = next(iter(tables.values())).sparkSession
    before = current(spark, base, prefix)
    version = uuid.uuid4().hex
    for name, rows in tables.items():
        rows.write.parquet(f"{base}/{prefix}{FOLDER}/{version}/{name}")
    _point(spark, f"{base}/{prefix}{POINTER}", version)
    _keep(spark, f"{base}/{prefix}{FOLDER}", {version, before})


def current(spark: SparkSession, base: str, prefix: str = "") -> str | None:
    """Name of the current set, if there is one."""
    files, path = _file(spark, f"{base}/{prefix}{POINTER}")
    if not files.exists(path):
        return None
    stream = files.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def table_paths(spark: SparkSession, base: str, names: list[str], prefix: str = "") -> dict[str, str]:
    """Folders of the tables, all of the current set; the plain one below
    ``base`` for a table that is not written with the others."""
    version = current(spark, base, prefix)
    paths = {}
    for name in names:
        path = f"{base}/{prefix}{FOLDER}/{version}/{name}"
        files, folder = _file(spark, path)
        paths[name] = path if version and files.exists(folder) else f"{base}/{prefix}{name}"
    return paths


def _file(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _point(spark: SparkSession, path: str, version: str) -> None:
    """The pointer is written under another name and moved over the old one."""
    files, made = _file(spark, f"{path}.{version}")
    stream = files.create(made)
    stream.writeBytes(version)
    stream.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    option = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(option, 1)
    options[0] = option.OVERWRITE
    context.rename(files.makeQualified(made), files.makeQualified(jvm.org.apache.hadoop.fs.Path(path)), options)


def _keep(spark: SparkSession, folder: str, versions: set[str | None]) -> None:
    files, path = _file(spark, folder)
    for status in files.listStatus(path):
        if status.getPath().getName() not in versions:
            files.delete(status.getPath(), True)
