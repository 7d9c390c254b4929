"""From raw documents to token files: each stage works on all rows the one before kept.

Stages take the table before them and return its columns; the last returns the
tokens' place of every document it wrote. A verdict is on a row, named by ``doc_id``
and two hashes of its text: different texts that share an id, or have none, are
judged apart, and only near duplicates and exact copies are dropped as such. Empty
tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition.llm import decontaminate, quality, simhash, token_store
from attrition.llm.queries import TOKENIZER, mixed
from attrition.llm.scratch import VERSION, store, versioned


# A hash of all columns, for rows that differ in others than id and text.
ROW = "__row"


def _by_row(docs: DataFrame, marks: DataFrame, keys: list[str], how: str) -> DataFrame:
    """``docs`` joined with ``marks`` on equal, or both null, ids and equal ``keys``."""
    others = [c for c in marks.columns if c.startswith("__") and c not in keys]
    marks = marks.select(F.col("doc_id").alias("__mark_id"), *[F.col(k).alias(f"__mark{k}") for k in keys], *others)
    same = docs["doc_id"].eqNullSafe(marks["__mark_id"])
    for key in keys:
        same = same & (docs[key] == marks[f"__mark{key}"])
    return docs.join(marks, same, how)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier accepts."""
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, model, "__score").where(F.col("__score") >= quality.THRESHOLD).drop("__score")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: the smallest id, nulls last, then the smallest hashes of its text and its columns."""
    named = versioned(docs).withColumn(ROW, F.xxhash64(*docs.columns))
    rows = _by_row(named, simhash.first_rows(named, [*VERSION, ROW]), [*VERSION, ROW], "left_semi")
    return rows.dropDuplicates(["doc_id", *VERSION, ROW]).select(docs.columns)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the contamination rule clears."""
    named = versioned(docs)
    found = decontaminate.find_matches(named, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keys=VERSION)
    return _by_row(named, decontaminate.judged(found).where("contaminated"), VERSION, "left_anti").select(docs.columns)


def to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many rows of a document as epochs take it; one that a last epoch takes only in part is taken whole."""
    named = versioned(docs).withColumn(ROW, F.xxhash64(*docs.columns))
    keys = [*VERSION, ROW]
    taken = mixed(named, keys).withColumn("__times", F.col("copies") + (F.col("prefix_tokens") > 0).cast("long"))
    times = taken.groupBy("doc_id", *keys).agg(F.max("__times").alias("__times")).where("__times > 0")
    rows = _by_row(named, times, keys, "inner").withColumn("__epoch", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__times"))))
    return rows.select(docs.columns)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' ids in bit-plane files, and where each document's are."""
    target = token_store.new_target(spark)
    token_store.write_tokens(docs, target, TOKENIZER)
    return token_store.read_tokens(spark, target)


STAGES = [
    ("quality classifier", good_quality),
    ("simhash near-dedup", one_of_each),
    ("benchmark decontamination", clean_of_benchmark),
    ("mixing to target weights", to_weights),
    ("token files", token_files),
]
# Neither a classifier, nor XXH64, nor a tokenizer can be had in SQL: tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
