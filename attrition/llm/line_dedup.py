"""Exact line deduplication that moves hashes, never text.

Lines become 128-bit hashes that are range-partitioned and sorted by document
and position inside; a window then streams each hash and takes its first
document. What comes back is one run-length keep bitmap per document that
loses lines. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attrition.llm.scratch import BLANKS, ascii_lower, store

# Lines are counted in this many hash buckets to find hot ones. A bucket is hot above HOT_ROWS
# lines and HOT_TIMES the average bucket, so at most BUCKETS / HOT_TIMES are; it is dealt by
# document into as many parts as it holds that number of lines.
BUCKETS, HOT_ROWS, HOT_TIMES = 65536, 256, 4


def split_lines(text: Column) -> Column:
    """Lines of a text; null and empty texts are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """One row per document that loses lines: ``doc_id, version, n_lines, n_dropped, keep``.

    A key (line trimmed, A-Z lower-cased) of ``min_chars`` code points or more that is
    in two or more documents keeps its lines only in the smallest id. ``keep`` is the
    document's bitmap as runs of kept lines, ``array<struct<start, len>>`` counted from 0.
    Documents without a row keep every line. ``version`` is a hash of the text: rows
    that repeat an id with another text are one document with a bitmap each. A null id
    counts as the smallest. An empty table gives no rows.
    """
    text = F.col(text_col)
    whole = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("version"), split_lines(text).alias("lines"))
    lines = whole.select("doc_id", "version", F.size("lines").alias("n_lines"), F.posexplode("lines").alias("pos", "line"))
    lines = lines.withColumn("key", line_key(F.col("line"))).where(F.char_length("key") >= min_chars)
    hashed = store(
        lines.select("doc_id", "version", "n_lines", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2")),
        "lines",
    )

    bucket = F.pmod("h1", F.lit(BUCKETS))
    sizes = store(hashed.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n")), "line-sizes")
    most = sizes.agg(F.greatest(F.lit(HOT_ROWS), F.coalesce(F.ceil(F.sum("n") * HOT_TIMES / BUCKETS), F.lit(0))))
    hot = sizes.withColumn("most", most.scalar()).where("n > most").select("bucket", F.ceil(F.col("n") / F.col("most")).alias("parts"))
    hot = store(hot, "line-hot")  # BUCKETS / HOT_TIMES rows at most
    dealt = hashed.withColumn("bucket", bucket).join(F.broadcast(hot), "bucket", "left").drop("bucket")
    part = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("parts")), F.lit(-1))

    ranged = dealt.withColumn("part", part.cast("long")).drop("parts").repartitionByRange("h1", "h2", "part")
    stream = Window.partitionBy("h1", "h2", "part").orderBy("doc_id", "pos")
    first = ranged.withColumn("first_doc", F.first("doc_id").over(stream))
    later = ~F.col("doc_id").eqNullSafe(F.col("first_doc"))
    # Later lines go; the first document of each part of a hot hash still has to meet the other parts.
    seen = store(first.where(later | (F.col("part") >= 0)).withColumn("later", later).drop("first_doc"), "line-firsts")
    meet = Window.partitionBy("h1", "h2").orderBy("doc_id", "pos")
    heads = seen.where(~F.col("later")).withColumn("first_doc", F.first("doc_id").over(meet))
    columns = ["doc_id", "version", "n_lines", "pos"]
    gone = seen.where("later").select(columns).union(heads.where(later).select(columns)).distinct()
    return _runs(gone)


def _runs(gone: DataFrame) -> DataFrame:
    """Runs of kept lines between the dropped positions of each document."""
    doc = gone.groupBy("doc_id", "version").agg(F.max("n_lines").alias("n_lines"), F.sort_array(F.collect_list("pos")).alias("gone"))
    edges = doc.withColumn("edges", F.concat(F.array(F.lit(-1)), "gone", F.array("n_lines")))
    runs = F.transform(
        F.sequence(F.lit(0), F.size("gone")),
        lambda i: F.struct(
            (F.col("edges")[i] + 1).alias("start"),
            (F.col("edges")[i + 1] - F.col("edges")[i] - 1).alias("len"),
        ),
    )
    return edges.select(
        "doc_id", "version", "n_lines", F.size("gone").alias("n_dropped"), F.filter(runs, lambda r: r["len"] > 0).alias("keep")
    )


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped`` and ``kept_text``; other columns stay, unless they have these names."""
    marks = bitmaps.select(
        F.col("doc_id").alias("_id"), F.col("version").alias("_version"), F.col("n_dropped").alias("_gone"), F.col("keep").alias("_keep")
    )
    text = docs[text_col]
    joined = docs.drop("n_lines", "n_dropped", "kept_text", "_id", "_version", "_gone", "_keep").join(
        marks, docs[id_col].eqNullSafe(marks["_id"]) & (F.xxhash64(text) == marks["_version"]), "left"
    )
    lines = split_lines(F.col(text_col))
    kept = F.flatten(F.transform("_keep", lambda r: F.slice(lines, r["start"] + 1, r["len"])))
    return joined.select(
        *[F.col(c) for c in docs.columns if c not in ("n_lines", "n_dropped", "kept_text", "_id", "_version", "_gone", "_keep")],
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce("_gone", F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("_keep").isNull(), F.coalesce(F.col(text_col), F.lit(""))).otherwise(F.array_join(kept, "\n")).alias("kept_text"),
    )
