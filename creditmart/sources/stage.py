"""Staged tables: cut a plan that several passes read, without pinning it to executors.

A staged table is written once as Parquet in a folder that the whole cluster shares and read back,
so later passes scan only the columns they need, Catalyst knows the size when it picks a join, and
a lost executor costs a re-read rather than a recomputation.

The folder is ``spark.checkpoint.dir``. Where that is unset and the session is a local one, it is
below the session's warehouse folder; on a cluster that may be a disk others do not see, so it is an error. Staged tables live until ``clear_stage``, or the end of a ``with staging(spark):`` block
for those made in it; within such a block, staging the same plan twice writes one table.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
WAREHOUSE_SETTING = "spark.sql.warehouse.dir"

_runs: list[dict] = []
_tables: list[str] = []


def stage_root(spark: SparkSession) -> str:
    """The folder the session names for checkpoints; for a local session without one, a folder in its warehouse."""
    configured = spark.conf.get(CHECKPOINT_SETTING, None)
    if configured:
        return configured
    return local_root(spark.sparkContext.master, spark.conf.get(WAREHOUSE_SETTING))


def local_root(master: str, warehouse: str) -> str:
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that the driver and all executors share")
    return f"{warehouse.rstrip('/')}/_stage"


def _application_folder(spark: SparkSession) -> str:
    return f"{stage_root(spark).rstrip('/')}/creditmart-{spark.sparkContext.applicationId}"


def stage_folder(spark: SparkSession, name: str) -> str:
    """A new path for a staged table, or for other files that live as long."""
    path = f"{_application_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if _runs:
        _runs[-1]["paths"].append(path)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    if _runs:
        for plan, staged in _runs[-1]["staged"]:
            if plan.schema == df.schema and plan.sameSemantics(df):
                return staged
    path = stage_folder(spark, name)
    df.write.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    if _runs:
        _runs[-1]["staged"].append((df, staged))
    return staged


def stage_table(df: DataFrame, name: str, buckets: int, key: str) -> DataFrame:
    """Staged, and bucketed by a key: later groupings by it read each bucket in one task, without a shuffle.

    The key should be one for all rows of a writing task, or few, so that a task writes few files.
    """
    spark = df.sparkSession
    writer = df.write.format("parquet").option("compression", "zstd").bucketBy(buckets, key)
    writer.option("path", stage_folder(spark, name)).saveAsTable(name)
    _tables.append(name)
    if _runs:
        _runs[-1]["tables"].append(name)
    return spark.table(name)


def _delete(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def unstage(spark: SparkSession, path: str) -> bool:
    """Remove one staged folder before its time; nothing may read it any more."""
    return _delete(spark, path)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are shared by equal plans and removed at the end.

    Results must be written or collected before the block ends.
    """
    run: dict = {"paths": [], "staged": [], "tables": []}
    _runs.append(run)
    try:
        yield
    finally:
        _runs.remove(run)
        for name in run["tables"]:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            _tables.remove(name)
        for path in run["paths"]:
            _delete(spark, path)


def clear_stage(spark: SparkSession) -> bool:
    """Remove this application's staged tables; call it after the last action."""
    while _tables:
        spark.sql(f"DROP TABLE IF EXISTS {_tables.pop()}")
    return _delete(spark, _application_folder(spark))
