"""Quality classifier: similarity-weighted votes of the nearest labelled documents in a latent space.

A text is described by how it is written, not by what it says: runs of character
classes, and how soon words come back. Counts of those features are weighted
and projected on the main directions of the labelled sample. Every document is
compared with every labelled vector, in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrition.llm.scratch import held_out, text_rows

# Labelled rows the classifier is fitted on, for each label; its vectors are broadcast.
SAMPLE = 2000
FEATURES, LATENT, NEIGHBOURS, SHARPNESS = 2048, 48, 15, 8.0
# Documents in one block of cosine products; bytes of a text described at once.
BLOCK, PIECE = 1024, 1 << 22
THRESHOLD = 0.3

# Character classes of UTF-8 bytes: space, line end, digit, lower, upper, other bytes of letters, and each ASCII mark by itself.
_CLASS = np.array(
    [0 if b in (9, 11, 12, 13, 32) else 1 if b == 10 else 2 if 48 <= b <= 57 else 3 if 97 <= b <= 122 else 4 if 65 <= b <= 90
     else 5 if b >= 128 else 6 + b % 32 for b in range(256)],
    np.int64,
)
_FOLD = np.frombuffer(bytes(range(256)).lower(), np.uint8).astype(np.uint64)
_WEIGHTS = np.random.default_rng(7).integers(1, 1 << 63, 64, dtype=np.uint64)


def describe(text: bytes) -> np.ndarray:
    """Counts of the features of a text, in ``FEATURES`` hash buckets."""
    total = np.zeros(FEATURES, np.float32)
    for at in range(0, len(text), PIECE):
        data = np.frombuffer(text[at : at + PIECE], np.uint8)
        total += _describe(data)
    return total


def _describe(data: np.ndarray) -> np.ndarray:
    kind = _CLASS[data]
    # Accented letters are written like others; the capitals of Latin-1 are C3 80 to C3 9E.
    lead = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] <= 0x9E)) if len(data) else np.zeros(0, np.int64)
    kind[kind == 5] = 3
    kind[lead] = 4
    kind[lead + 1] = 4
    starts = np.flatnonzero(np.diff(kind, prepend=-1))
    sizes = np.diff(starts, append=len(kind))
    run = kind[starts] * 4 + np.minimum(np.log2(sizes).astype(np.int64), 3)
    found = [run, 1000 + run[:-1] * 256 + run[1:], 100_000 + (run[:-2] * 256 + run[1:-1]) * 256 + run[2:]]
    inside = kind > 1
    word_at = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
    if len(word_at):
        offset = np.arange(len(data)) - np.repeat(word_at, np.diff(word_at, append=len(data)))[: len(data)] if word_at[0] == 0 else None
        if offset is None:
            filled = np.concatenate([np.zeros(word_at[0], np.int64), np.repeat(word_at, np.diff(word_at, append=len(data)))])
            offset = np.arange(len(data)) - filled
        mixed = np.where(inside, (_FOLD[data] + np.uint64(1)) * _WEIGHTS[offset & 63], np.uint64(0))
        words = np.add.reduceat(mixed, word_at)
        order = np.argsort(words, kind="stable")
        again = np.flatnonzero(words[order][1:] == words[order][:-1])
        gaps = order[again + 1] - order[again]
        back = np.minimum(np.log2(gaps).astype(np.int64), 9)
        found += [1 << 30 | back, np.full(len(words) - len(again), 1 << 30 | 15)]
        lines = np.diff(np.searchsorted(word_at, np.flatnonzero(kind == 1)), prepend=0)
        found.append(1 << 29 | np.minimum(np.log2(lines + 1).astype(np.int64), 9))
    codes = np.concatenate(found).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return np.bincount((codes >> np.uint64(40)).astype(np.int64) % FEATURES, minlength=FEATURES).astype(np.float32)


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    rows = np.log1p(counts) * idf
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def _directions(rows: np.ndarray, wanted: int) -> np.ndarray:
    """The leading right singular vectors, by power iterations on a random start."""
    start = np.random.default_rng(11).standard_normal((rows.shape[1], wanted + 8)).astype(np.float32)
    basis = np.linalg.qr(start)[0]
    for _ in range(4):
        basis = np.linalg.qr(rows.T @ (rows @ basis))[0]
    _, _, turn = np.linalg.svd(rows @ basis, full_matrices=False)
    return basis @ turn.T[:, :wanted]


def _project(counts: np.ndarray, idf: np.ndarray, basis: np.ndarray) -> np.ndarray:
    latent = _weighted(counts, idf) @ basis
    return (latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [describe(t.as_py() or b"") for t in batch.column(1)]
        known = [np.flatnonzero(r) for r in rows]
        columns = [
            batch.column(0),
            pa.array([k.tolist() for k in known], pa.list_(pa.int32())),
            pa.array([r[k].tolist() for r, k in zip(rows, known)], pa.list_(pa.float32())),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["label", "places", "counts"])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict | None:
    """The classifier from at most ``sample`` labelled rows of each label, those with the smallest hashes of their ids.

    Held-out ids and null ids, labels or texts are never learned from. An id labelled both
    ways counts as 0. Without both labels there is nothing to learn: None.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("quality").cast("int").alias("label"))
    known = known.join(docs.where("text IS NOT NULL").select("doc_id"), "doc_id", "left_semi")
    numbers = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(numbers) < 2:
        return None
    rank = F.xxhash64("doc_id")
    chosen = known.where("label = 0").orderBy(rank, "doc_id").limit(sample).union(known.where("label = 1").orderBy(rank, "doc_id").limit(sample))
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(F.broadcast(chosen), "doc_id")
    first = texts.dropDuplicates(["doc_id"]).select("label", "text")
    rows = first.mapInArrow(_described, "label int, places array<int>, counts array<float>").collect()  # at most two samples
    counts = np.zeros((len(rows), FEATURES), np.float32)
    for row, out in zip(rows, counts):
        out[row["places"]] = row["counts"]
    label = np.array([r["label"] for r in rows], np.int64)
    order = np.lexsort((counts.sum(axis=1), label))  # the result must not depend on the order rows arrive in
    counts, label = counts[order], label[order]
    idf = (np.log((1 + len(rows)) / (1 + (counts > 0).sum(axis=0))) + 0.1).astype(np.float32)
    basis = _directions(_weighted(counts, idf), LATENT).astype(np.float32)
    # Each sampled row stands for as many labelled rows as its label has for each sampled one.
    stands = np.array([numbers[i] / max(1, (label == i).sum()) for i in (0, 1)])
    return {
        "idf": idf,
        "basis": basis,
        "vectors": _project(counts, idf, basis),
        "label": label.astype(np.float64),
        "stands": stands[label],
        "prior": numbers[1] / (numbers[0] + numbers[1]),
    }


def votes(counts: np.ndarray, model: dict) -> np.ndarray:
    """Share of label 1 among the nearest labelled vectors, weighted by similarity."""
    near = _project(counts, model["idf"], model["basis"]) @ model["vectors"].T
    k = min(NEIGHBOURS, near.shape[1])
    top = np.argpartition(-near, k - 1, axis=1)[:, :k]
    weight = np.maximum(np.take_along_axis(near, top, axis=1), 0).astype(np.float64) ** SHARPNESS * model["stands"][top]
    whole = weight.sum(axis=1)
    share = (weight * model["label"][top]).sum(axis=1) / np.where(whole > 0, whole, 1)
    return np.clip(np.where((whole > 0) & counts.any(axis=1), share, model["prior"]), 0, 1)


def score(docs: DataFrame, model: dict | None, name: str = "score") -> DataFrame:
    """``docs`` with a column ``name``, the score of each row's whole text; a column of that name is replaced.

    A text without features has the labels' share of 1, every text 0.5 without a model.
    Rows are scored where they are: nothing is shuffled.
    """
    docs = docs.drop(name)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                if fitted is None:
                    found = np.full(part.num_rows, 0.5)
                else:
                    texts = part.column(part.schema.get_field_index("text")).cast(pa.binary())
                    found = votes(np.stack([describe(t.as_py() or b"") for t in texts]), fitted)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found)], [*part.schema.names, name])

    text_rows(docs.sparkSession)
    return docs.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs(doc_id, text)``.

    Null and empty texts are scored too, repeated rows alike; an empty table gives no rows.
    """
    found = score(docs.select("doc_id", "text"), fit(docs, labels))
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
