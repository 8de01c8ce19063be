"""Reading, storing and measuring tables; shipping the package to the tasks."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import guestlens
from guestlens.sources.shared import shared_folder

#: What separates words everywhere in this package.
GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

_shipped: set[str] = set()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """The same rows, written once to the shared folder and read from there.

    Cuts the lineage: what follows survives the loss of any executor, and values
    such as row numbers stay as they were written.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """Bytes of text in all rows, which sizes the partitions of later steps."""
    return docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0


def split_words(text: Column) -> Column:
    """The words of a text as an array, empty for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def only(rows: DataFrame, condition: Column, *columns: str) -> DataFrame:
    """The columns of the rows that meet the condition.

    A plain filter would be moved below the steps that work the condition out,
    and so repeat them, once more for each use of each of their results. A
    generator stays where it is.
    """
    return rows.select(F.inline(F.filter(F.array(F.struct(*columns)), lambda _: condition)))


#: Rows per batch sent to Python, where the session has no value of its own. A
#: row is a whole text, so Spark's 10,000 would hold gigabytes of long ones.
BATCH_ROWS = "1000"


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the driver found it, and
    send them texts in batches of bounded size."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows) == "10000":
        spark.conf.set(rows, BATCH_ROWS)
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.abspath(guestlens.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="guestlens-package-"), "guestlens.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(top)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)
