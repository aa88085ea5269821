"""Publishing: a result conformed to its declared schema, in place of what was there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from creditmart import schemas
from creditmart.sources import files, versions


def conform(df: DataFrame, name: str) -> DataFrame:
    """Declared columns, order and types. A missing column or an unsafe cast is an error,
    and so is text longer than declared (checked while the rows stream through)."""
    schema = schemas.PUBLISHED[name]
    return df.select(*schema.names).to(schema).selectExpr(*(_within_length(name, c) for c in schema.names))


def _within_length(table: str, column: str) -> str:
    limit = schemas.TEXT_LENGTHS.get(column)
    if limit is None:
        return column
    complaint = f"CAST(raise_error('{table}.{column} is longer than {limit}') AS string)"
    return f"CASE WHEN length({column}) > {limit} THEN {complaint} ELSE {column} END AS {column}"


def publish_parquet(df: DataFrame, name: str, folder: str, order_by: dict[str, bool] | None = None) -> str:
    """A new version of ``folder/name``, and its folder. A write that fails leaves the rows before it in place."""
    path = f"{folder.rstrip('/')}/{name}"
    written = versions.replace(files.sorted_by(conform(df, name), order_by or {}), path)
    versions.vacuum(df.sparkSession, path)
    return f"{path}/{written[versions.WHOLE]}"


def read_published(spark: SparkSession, name: str, folder: str) -> DataFrame:
    """The newest version of a published table."""
    return versions.read(spark, f"{folder.rstrip('/')}/{name}", schemas.PUBLISHED[name])


def publish_table(df: DataFrame, name: str, database: str) -> str:
    target = f"{database}.{name}"
    conform(df, name).write.mode("overwrite").saveAsTable(target)
    return target


def publish_jdbc(df: DataFrame, name: str, url: str, properties: dict[str, str]) -> None:
    """Replace the rows of a serving table, keeping its definition (truncate, not drop)."""
    writer = conform(df, name).write.mode("overwrite").option("truncate", True)
    writer.jdbc(url, name, properties=properties)
