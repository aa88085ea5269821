"""File and database scans, and layer writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameReader, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditmart import schemas

# --- reading -------------------------------------------------------------------------


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename all columns by position; a different column count is an error, not a shift."""
    if len(df.columns) != len(names):
        raise ValueError(f"expected {len(names)} columns, the file has {len(df.columns)}")
    return df.toDF(*names)


def _csv(spark: SparkSession) -> DataFrameReader:
    return spark.read.option("header", True).option("inferSchema", False)


def read_rejected_csv(spark: SparkSession, path: str) -> DataFrame:
    """The nine-column rejected extract. Headers hold spaces, so names go by position."""
    return rename_positional(_csv(spark).csv(path), schemas.REJECTED_COLUMNS)


def read_accepted_csv(
    spark: SparkSession, path: str, columns: Sequence[str] = schemas.ACCEPTED_COLUMNS
) -> DataFrame:
    """The wide accepted extract cut to ``columns``; the parser skips all the others."""
    return _csv(spark).csv(path).select(*columns)


CORRUPT = "_corrupt_record"


def parsed_lines(spark: SparkSession, path: str, columns: Sequence[str], header: bool = True) -> DataFrame:
    """A CSV extract as text columns by position, with the whole line in ``_corrupt_record`` where it does not parse.

    A line has one record: a quote left open ends with its line and spoils no other.
    """
    schema = T.StructType([*(T.StructField(c, T.StringType()) for c in columns), T.StructField(CORRUPT, T.StringType())])
    return _csv(spark).option("header", header).schema(schema).option("enforceSchema", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(path)


def fault(line: str, columns: int) -> str:
    """Why a line does not parse, as expression text: an open quote, or the number of fields."""
    quotes = f"length({line}) - length(replace({line}, '\"', ''))"
    outside = f"size(split(regexp_replace({line}, '\"[^\"]*\"', ''), ',', -1))"
    return f"CASE WHEN ({quotes}) % 2 = 1 THEN 'open quote' WHEN {outside} < {columns} THEN 'too few fields' WHEN {outside} > {columns} THEN 'too many fields' ELSE 'unreadable' END"


def read_with_quarantine(spark: SparkSession, source: str, folder: str, columns: Sequence[str], header: bool = True) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """The rows of a CSV extract, the lines that are none (``file, line, reason``), and the counts ``lines, rows, quarantined``.

    The extract is parsed once and written to ``folder`` in two parts, rows and quarantine, counted on the way.
    """
    observed = Observation()
    counts = [F.count("*").alias("lines"), F.expr(f"count_if({CORRUPT} IS NULL) AS rows"), F.expr(f"count_if({CORRUPT} IS NOT NULL) AS quarantined")]
    # The file's name is asked for on every row, so that the parser is not asked for the corrupt column alone.
    lines = parsed_lines(spark, source, columns, header).select("*", F.input_file_name().alias("_file"), F.col(CORRUPT).isNotNull().alias("_bad"))
    lines.observe(observed, *counts).write.mode("overwrite").partitionBy("_bad").parquet(folder)
    held = spark.read.schema(lines.schema).parquet(folder)
    bad = held.where("_bad").selectExpr("_file AS file", f"{CORRUPT} AS line", f"{fault(CORRUPT, len(columns))} AS reason")
    return held.where("NOT _bad").select(*columns), bad, observed.get


def read_detail_csv(spark: SparkSession, path: str, schema: T.StructType = schemas.DETAIL) -> DataFrame:
    """An exported detail table with declared types: no inference pass, "012" stays text.

    A gzip file cannot be split, so one task reads it; its rows are spread right after.
    """
    df = spark.read.schema(schema).option("header", True).csv(path)
    return df.repartition(spark.sparkContext.defaultParallelism) if path.endswith(".gz") else df


def with_row_key(df: DataFrame, prefix: str = "", name: str = "row_key") -> DataFrame:
    """The rows with a stable key: a digest of all columns, and a number that tells full copies apart.

    Copies are counted and dealt out again, so a row delivered very often costs one row per task.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    text = F.to_json(F.struct(*(c.cast("string").alias(f"c{i}") for i, c in enumerate(columns))))
    counted = df.groupBy(*columns).agg(F.count("*").alias("_copies"))
    numbered = counted.select(*columns, F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))).alias("_copy"))
    return numbered.select(F.concat(F.lit(prefix), F.sha2(text, 256), F.lit("-"), F.col("_copy")).alias(name), *columns)


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def jdbc_options(url: str, query: str, properties: dict[str, str], fetch_rows: int = 10_000) -> dict[str, str]:
    """Reader options that push a whole query to the database."""
    return {**properties, "url": url, "dbtable": f"({query}) AS t", "fetchsize": str(fetch_rows)}


def partitioned_jdbc_options(
    options: dict[str, str], column: str, lower: int, upper: int, partitions: int
) -> dict[str, str]:
    """Split a JDBC scan into ranges of a numeric column, one connection per range."""
    return {
        **options,
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def jdbc_scan(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


# --- writing --------------------------------------------------------------------------


def sorted_by(df: DataFrame, order_by: dict[str, bool]) -> DataFrame:
    """Sort by column -> ascending. Only sinks sort: elsewhere it is a shuffle for nothing."""
    return df.orderBy(*order_by, ascending=list(order_by.values())) if order_by else df


def write_layer(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Overwrite a Parquet layer table and return its row count.

    The count is observed while writing: the plan runs once.
    """
    observed = Observation()
    writer = df.observe(observed, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return observed.get["rows"]


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> int:
    """Headered CSV export, a folder of parts; returns its row count, observed while writing.

    ``single_file`` is the caller's choice, whatever the size: one file means one task.
    """
    observed = Observation()
    counted = df.observe(observed, F.count(F.lit(1)).alias("rows"))
    (counted.coalesce(1) if single_file else counted).write.mode("overwrite").option("header", True).csv(path)
    return observed.get["rows"]
