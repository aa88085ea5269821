"""Versioned tables: new rows are written beside the old ones, then a manifest names them.

A table is a folder. Each write fills a ``version=...`` folder of its own; only when that is complete is a
numbered manifest put in place, by a rename that fails where the number is taken. Readers go by the newest manifest, so
they see the rows before a write or those after it, also when the write dies halfway or two writers race (the
second is told so). A table may consist of *parts*, the folders of one partition column: a write then replaces the
parts it names, the others stay where they are.

The rename must be atomic, as it is on HDFS and on a local disk.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

WHOLE = ""
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_PREFIX = "_manifest-"


class Conflict(RuntimeError):
    """Another writer committed first; nothing of this write is visible."""


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    fs = _files(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(_path(spark, path))] if fs.exists(_path(spark, path)) else []


def _numbers(spark: SparkSession, path: str) -> list[int]:
    found = (n.removeprefix(_PREFIX).removesuffix(".json") for n in _names(spark, path) if n.startswith(_PREFIX) and n.endswith(".json"))
    return sorted(int(n) for n in found if n.isdigit())


def _read_manifest(spark: SparkSession, path: str, number: int) -> dict[str, str]:
    stream = _files(spark, path).open(_path(spark, f"{path}/{_PREFIX}{number}.json"))
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def parts(spark: SparkSession, path: str) -> dict[str, str]:
    """Part -> folder, of the newest version; empty where there is none."""
    numbers = _numbers(spark, path)
    return _read_manifest(spark, path, numbers[-1]) if numbers else {}


def _commit(spark: SparkSession, path: str, number: int, content: dict[str, str]) -> None:
    jvm = spark.sparkContext._jvm
    draft = f"{path}/_draft-{uuid.uuid4().hex}"
    stream = _files(spark, path).create(_path(spark, draft))
    stream.write(json.dumps(content).encode())
    stream.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(_path(spark, path).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(_path(spark, draft), _path(spark, f"{path}/{_PREFIX}{number}.json"), options)
    except Exception as error:
        if number in _numbers(spark, path):
            raise Conflict(f"{path}: version {number} was committed by another writer") from error
        raise


def replace(df: DataFrame, path: str, column: str | None = None, only: Iterable[str | None] | None = None) -> dict[str, str]:
    """Write a new version and commit it; returns its parts.

    Without ``column`` the rows replace the whole table. With it, there is a part for each of its values, and ``only``
    names the parts to be replaced: those without rows go, parts not named stay, rows of such parts are an error.
    """
    spark = df.sparkSession
    number = (_numbers(spark, path) or [0])[-1]
    before = _read_manifest(spark, path, number) if number else {}
    version = f"version={uuid.uuid4().hex}"
    writer = df.write
    if column is None:
        writer.parquet(f"{path}/{version}")
        after = {WHOLE: version}
    else:
        writer.partitionBy(column).parquet(f"{path}/{version}")
        prefix = f"{column}="
        made = {n.removeprefix(prefix): f"{version}/{n}" for n in _names(spark, f"{path}/{version}") if n.startswith(prefix)}
        kept: dict[str, str] = {}
        if only is not None:
            named = {NO_VALUE if v is None else str(v) for v in only}
            if set(made) - named:
                raise ValueError(f"rows of parts that are not to be replaced: {sorted(set(made) - named)}")
            kept = {k: v for k, v in before.items() if k not in named}
        after = kept | made
    _commit(spark, path, number + 1, after)
    return after


def read(spark: SparkSession, path: str, schema: T.StructType, only: Iterable[str | None] | None = None) -> DataFrame:
    """The newest rows; with ``only``, of these parts alone, so that no other folder is even listed."""
    found = parts(spark, path)
    if only is not None:
        named = {NO_VALUE if v is None else str(v) for v in only}
        found = {k: v for k, v in found.items() if k in named}
    if not found:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema)
    if WHOLE in found:
        return reader.parquet(f"{path}/{found[WHOLE]}")
    return reader.option("basePath", path).parquet(*(f"{path}/{folder}" for folder in found.values())).select(*schema.names)


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete what none of the last ``keep`` versions names, uncommitted writes included; returns how many folders went.

    Not to be run while a write is under way.
    """
    numbers = _numbers(spark, path)
    named = {folder for n in numbers[-keep:] for folder in _read_manifest(spark, path, n).values()}
    fs, gone = _files(spark, path), 0
    for name in _names(spark, path):
        if name.startswith("version="):
            inside = {f for f in named if f.split("/")[0] == name}
            stale = [] if name in inside else [f"{name}/{n}" for n in _names(spark, f"{path}/{name}") if "=" in n and f"{name}/{n}" not in inside] if inside else [name]
            for folder in stale:
                gone += fs.delete(_path(spark, f"{path}/{folder}"), True)
        elif name.startswith("_draft-") or (name.startswith(_PREFIX) and name.removeprefix(_PREFIX).removesuffix(".json") in {str(n) for n in numbers[:-keep]}):
            fs.delete(_path(spark, f"{path}/{name}"), False)
    return gone
