"""The dealt queries: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Sequence

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition.llm import (
    decontaminate,
    imatch,
    language_id,
    line_dedup,
    mixing,
    oracle_text,
    prefix_trie,
    quality,
    secret_scan,
    simhash,
    token_store,
    url_filter,
    vector_dedup,
    whitening,
)

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _digest(spans: Column) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_documents(_table(spark, sf_dir, "documents"))

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(secret_scan.BASE_KINDS))
    return found.select(
        "doc_id",
        *[number(kind) for kind in secret_scan.BASE_KINDS],
        F.sha2(_digest(base), 256).alias("base_sha256"),
        _digest(F.col("spans")).alias("spans"),
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    applied = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    return applied.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    hexed = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", hexed.alias("fingerprint"), "component_id")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return decontaminate.judged(found).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
        F.size("near_items").cast("long").alias("n_near_items"),
    )


# The mix that the query and the pipeline ask for: one crawl and two groups of smaller sources.
DOMAIN = (
    "CASE WHEN source = 'src0' THEN 'crawl' WHEN source IN ('src1', 'src2', 'src3', 'src4', 'src5') THEN 'reference'"
    " WHEN source IS NOT NULL THEN 'forum' END"
)
WEIGHTS = {
    ("crawl",): 3,
    ("reference",): 4,
    ("forum",): 5,
    ("crawl", "en"): 5,
    ("crawl", "de"): 2,
    ("crawl", "fr"): 2,
    ("reference", "en"): 4,
    ("forum", "en"): 6,
    ("forum", "fr"): 2,
    ("reference", "en", "src1"): 3,
    ("forum", "en", "src6"): 2,
}


def mixed(docs: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return mixing.mix(docs, WEIGHTS, F.expr(DOMAIN), share=1.0, epochs=2, seed=42, keys=keys)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(_table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = token_store.new_target(spark)
    token_store.write_tokens(_table(spark, sf_dir, "documents"), target, TOKENIZER)
    return token_store.read_tokens(spark, target)


def op9_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"))


def op11_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.edited_prints(_table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.build(_table(spark, sf_dir, "conversations"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_secret_scan,
        op2_line_dedup,
        op3_simhash,
        op4_language_id,
        op5_decontaminate,
        op6_mixing,
        op7_quality,
        op8_token_store,
        op9_vector_dedup,
        op10_url_filter,
        op11_imatch,
        op12_whitening,
        op13_prefix_trie,
    )
}
ORACLES = oracle_text.TEXTS
