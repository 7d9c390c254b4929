"""Helpers the operators share: written intermediate tables and byte-exact text functions."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition.session import shared_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The six ASCII white-space characters, U+0020 and U+0009 to U+000D.
BLANKS = " \t\n\x0b\f\r"

TEXT_ROWS, _BATCH = 500, "spark.sql.execution.arrow.maxRecordsPerBatch"


def folder(spark: SparkSession) -> str:
    """Where this application's intermediate tables are written; see ``release``."""
    return f"{shared_dir(spark)}/attrition-llm/{spark.sparkContext.applicationId}"


def store(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as a table every executor can read, and read back.

    That computes it once, cuts its lineage and survives lost executors.
    """
    spark = df.sparkSession
    path = f"{folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Remove this application's intermediate tables; call it when their results are written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_rows(spark: SparkSession) -> None:
    """Send at most TEXT_ROWS rows to Python at once from now on, if the session allows more.

    Rows here are whole documents, and a batch is held by the JVM, by Arrow and by
    Python at the same time.
    """
    if not 0 < int(spark.conf.get(_BATCH)) <= TEXT_ROWS:
        spark.conf.set(_BATCH, str(TEXT_ROWS))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


# Columns that tell rows apart beside their id: two hashes of the text, so exact copies under one id share them.
VERSION = ["__version1", "__version2"]


def versioned(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns of VERSION."""
    return docs.withColumns({VERSION[0]: F.xxhash64("text"), VERSION[1]: F.xxhash64(F.lit(7), "text")})


def held_out(doc_id: Column) -> Column:
    """Documents kept from training: crc32 of the id as text, divisible by 5. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
