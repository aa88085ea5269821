"""What the training-data operators share."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"
WHITE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
FOLDS = 5


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the Python workers, once a session: they need not find it by path."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parent.parent
        archive = f"{tempfile.mkdtemp(prefix='creditmart-code-')}/{package.name}-code"
        context.addPyFile(shutil.make_archive(archive, "zip", package.parent, package.name))
        _shipped.add(context.applicationId)


def whole_text(text: str) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))


def without(text: Column, characters: str) -> Column:
    """The text without any of a few characters; plain searches are several times faster than a pattern."""
    for character in characters:
        text = F.replace(text, F.lit(character), F.lit(""))
    return text


def held_out(key: str = "doc_id") -> Column:
    """Whether a row belongs to the test fold. A null key is never held out."""
    return F.coalesce(F.crc32(F.col(f"`{key}`").cast("string")) % FOLDS == 0, F.lit(False))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until no column of the frame has it (compared without case)."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def let(value: Column, body) -> Column:
    """body(value) with the value computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)
