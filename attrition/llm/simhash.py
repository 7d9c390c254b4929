"""SimHash near-duplicates by ball hashing that meets in the middle.

Two fingerprints within r bits share a variant that is within r // 2 bits of
one and r - r // 2 of the other. Each distinct fingerprint emits all its
variants; those that meet in one are linked. A variant's group is bounded by the
size of the ball, whatever the corpus holds, and copies were collapsed before.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attrition.llm.components import components
from attrition.llm.scratch import store, text_rows

# Shingles hashed at once, so that a very long text needs no more memory than a short one's.
BLOCK = 1 << 16


def fingerprint(text: bytes | None, words_in: int, seed: int) -> int:
    """The signed 64-bit SimHash of a text's word shingles; 0 without words."""
    words = text.lower().split() if text else []  # on bytes: A-Z and ASCII white space only
    if not words:
        return 0
    if len(words) < words_in:
        words_in = len(words)
    ones, total = np.zeros(64, np.int64), len(words) - words_in + 1
    for at in range(0, total, BLOCK):
        part = words[at : at + BLOCK + words_in - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(words_in))))
        digests = b"".join(map(xxhash.xxh64_digest, shingles, repeat(seed)))
        ones += np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big", signed=True)


def fingerprints(
    docs: DataFrame, shingle: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", keys: Sequence[str] = ()
) -> DataFrame:
    """``doc_id, fingerprint`` (a signed long) of every row's whole text, and its ``keys`` (long columns); null texts have no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t.as_py(), shingle, seed) for t in batch.column(1)]
            columns = [batch.column(0), pa.array(prints, pa.int64()), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "fingerprint", *keys])

    picked = docs.selectExpr(f"CAST(`{id_col}` AS BIGINT) AS doc_id", f"CAST(`{text_col}` AS BINARY) AS text", *[f"`{k}`" for k in keys])
    text_rows(docs.sparkSession)
    return picked.mapInArrow(run, ", ".join(["doc_id long", "fingerprint long", *(f"`{k}` long" for k in keys)]))


def masks(radius: int) -> list[int]:
    """All signed 64-bit numbers with at most ``radius`` bits set."""
    found = [sum(1 << b for b in bits) for n in range(radius + 1) for bits in combinations(range(64), n)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in found]


def links(distinct: DataFrame, radius: int) -> DataFrame:
    """``a, b``: enough links between distinct ``fingerprint``s within ``radius`` bits to connect all that are linked.

    In a variant's group everything within ``radius // 2`` bits of the variant is within
    ``radius`` of every member, so one such member stands for the group: no pairs are listed.
    """
    inner, outer = radius // 2, radius - radius // 2
    ball = F.array(*[F.lit(m) for m in masks(outer)])
    mask = F.explode(ball).alias("mask")
    emitted = distinct.select("fingerprint", mask).select(
        "fingerprint",
        F.col("fingerprint").bitwiseXOR(F.col("mask")).alias("variant"),
        *([] if inner == outer else [(F.bit_count("mask") <= inner).alias("inner")]),
    )
    member = F.col("fingerprint") if inner == outer else F.when(F.col("inner"), F.col("fingerprint"))
    hub = F.min(member).over(Window.partitionBy("variant"))
    met = emitted.select("fingerprint", hub.alias("hub")).where("hub <> fingerprint")
    pairs = met.select(F.greatest("hub", "fingerprint").alias("a"), F.least("hub", "fingerprint").alias("b")).distinct()
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def _rooted(distinct: DataFrame, radius: int) -> DataFrame:
    """``fingerprint, first_doc, root`` of ``distinct(fingerprint, first_doc)``; a component's fingerprints have one root."""
    found = components(links(distinct, radius))
    joined = distinct.join(found.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    return store(joined.select("fingerprint", "first_doc", F.coalesce("root", "fingerprint").alias("root")), "rooted")


def first_rows(docs: DataFrame, keys: Sequence[str], shingle: int = 3, radius: int = 2, seed: int = 42) -> DataFrame:
    """``doc_id`` and ``keys`` of one row of each component: the smallest id, nulls last, then the smallest keys.

    A minimum for each fingerprint, then one for each root: both combine map-side, so no group meets in one task.
    """
    prints = store(fingerprints(docs, shingle, seed, keys=keys), "fingerprints")
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *keys)
    distinct = store(prints.groupBy("fingerprint").agg(F.min(row).alias("first_doc")), "distinct")
    return _rooted(distinct, radius).groupBy("root").agg(F.min("first_doc").alias("first")).select("first.doc_id", *[f"first.{k}" for k in keys])


def near_duplicates(
    docs: DataFrame, shingle: int = 3, radius: int = 2, seed: int = 42, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row.

    ``fingerprint`` is a signed long; documents are linked at ``radius`` or fewer
    differing bits, and ``component_id`` is the smallest id reachable. Texts without words
    have fingerprint 0 and are linked like others. Rows with a null id belong to a
    component but never name it unless it has no other; an empty table gives no rows.
    """
    prints = store(fingerprints(docs, shingle, seed, id_col, text_col), "fingerprints")
    distinct = store(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_doc")), "distinct")
    rooted = _rooted(distinct, radius)
    named = store(rooted.groupBy("root").agg(F.min("first_doc").alias("component_id")), "named")
    classes = store(rooted.join(named, "root").select("fingerprint", "component_id"), "classes")
    return prints.join(classes, "fingerprint").select("doc_id", "fingerprint", "component_id")
