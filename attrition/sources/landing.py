"""Raw landing: header clean-up, text columns, width profile, table writes."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from attrition.functions.cleansing import utf16_length
from attrition.functions.sql import aggregate, named
from attrition.session import kept


MALFORMED = "_malformed"


def read_raw(
    spark: SparkSession, path: str, kind: str = "csv", multiline: bool = True, names: list[str] | None = None, rejects: str | None = None
) -> DataFrame:
    """One header row plus data rows, every column text and blank cells NULL; or a parquet table as is.

    A quote inside a quoted cell is doubled, as spreadsheets write it. A record with more or fewer cells than the header
    stops the load and is named in the error; with ``rejects`` such records go, as text, to a table there and the others are returned.
    Files that name their columns otherwise than the first stop the load too. ``names`` stand for the header of files without one.
    With ``multiline`` a cell may hold line ends; such a file is read by one task, so a large landing should
    be many files, or be read with ``multiline=False`` where no cell holds one.
    """
    if kind != "csv":
        return spark.read.format(kind).load(path)
    # Cells are counted in the whole record, also where only some columns are asked for.
    options = {"header": str(names is None).lower(), "quote": '"', "escape": '"', "multiLine": str(multiline).lower(), "columnPruning": "false"}
    if names is None:
        names = spark.read.options(**options).option("inferSchema", "false").csv(path).columns
    text = StructType([StructField(name, StringType()) for name in names])
    reader = spark.read.options(**options).option("enforceSchema", "false")
    if rejects is None:
        return reader.option("mode", "FAILFAST").schema(text).csv(path)
    marked = reader.option("columnNameOfCorruptRecord", MALFORMED).schema(text.add(MALFORMED, "string")).csv(path)
    # Read once: a record's text is only there next to all its cells.
    staged = kept(marked.withColumn("_file", F.col("_metadata.file_path")), "landed")
    staged.filter(F.col(MALFORMED).isNotNull()).select("_file", F.col(MALFORMED).alias("record")).write.mode("overwrite").parquet(rejects)
    return staged.filter(F.col(MALFORMED).isNull()).drop(MALFORMED, "_file")


def snake_name(header: str, position: int) -> str:
    """One header as a lower-case identifier; ``position`` counts from 1."""
    unnamed = header.strip() == "" or header == f"_c{position - 1}"
    words = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", "" if unnamed else header)
    name = re.sub(r"[().%]", "", re.sub(r"\s+", "_", words))
    name = re.sub(r"_{2,}", "_", name).strip("_").lower()
    return name or f"col_{position}"


def snake_headers(df: DataFrame) -> DataFrame:
    names = [snake_name(header, position) for position, header in enumerate(df.columns, start=1)]
    twice = sorted({name for name in names if names.count(name) > 1})
    if twice:
        raise ValueError(f"headers collide after clean-up: {', '.join(twice)}")
    return df.toDF(*names)


def stringify(df: DataFrame) -> DataFrame:
    return df.selectExpr(*[f"CAST(`{name}` AS STRING) AS `{name}`" for name in df.columns])


def width_profile(df: DataFrame) -> DataFrame:
    """Longest text per column, at least 1, from a single aggregation."""
    longest = {name: f"CAST(greatest(max({utf16_length(f'`{name}`')}), 1) AS BIGINT)" for name in df.columns}
    widths = df.agg(*named(longest))
    return widths.unpivot([], [f"`{name}`" for name in df.columns], "column", "max_len")


def landing_check(bronze: DataFrame) -> DataFrame:
    """Row and customer counts. Grouping by id first lets a hot id collapse before the shuffle."""
    per_id = aggregate(bronze, ["customer_id"], n="count(1)")
    return aggregate(per_id, [], total_rows="coalesce(sum(n), 0)", distinct_customers="count(customer_id)")


def write_table(df: DataFrame, path: str, mode: str = "overwrite", by: str | None = None) -> bool:
    """Write parquet. ``overwrite`` replaces, ``if_empty`` writes only where nothing is yet.

    ``by`` makes a folder for each value of a column; rows are dealt so that a frequent value
    is written by several tasks. Returns whether anything was written; errors are raised,
    never only reported.
    """
    if mode == "if_empty":
        try:
            if not df.sparkSession.read.parquet(path).isEmpty():
                return False
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
    elif mode != "overwrite":
        raise ValueError(f"unknown mode {mode!r}")
    if by:
        df.hint("rebalance", by).write.mode("overwrite").partitionBy(by).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)
    return True
