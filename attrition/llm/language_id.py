"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams by language in each partition before anything is
shuffled. The matrix of log probabilities has a fixed number of columns and one
row per language, so its size is known before it is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.llm.scratch import held_out, text_rows

# Hash buckets of n-grams; with MAX_LANGUAGES rows of float32 the model stays under 128 MB.
BITS, MAX_LANGUAGES = 15, 1024
ORDERS = (2, 3)
SMOOTHING = 0.5
# Languages a training task counts before it hands the counts on; matrix cells gathered at once.
OPEN_LANGUAGES, CELLS = 64, 4_000_000
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)
PIECE = 1 << 20
UNKNOWN = "und"


def grams(text: str) -> Iterator[np.ndarray]:
    """Buckets of a text's n-grams, lower-cased and between blanks, in arrays of bounded size."""
    for at in range(0, len(text), PIECE):
        part = f" {text[at : at + PIECE + 2] if at + PIECE < len(text) else text[at:] + ' '}".lower()
        codes = np.frombuffer(part.encode("utf-32-le", "replace"), np.uint32)
        found = []
        for order in ORDERS:
            n = len(codes) - order + 1
            if n > 0:
                mixed = np.full(n, order, np.uint32)
                for i in range(order):
                    mixed = (mixed ^ codes[i : i + n]) * _MULTIPLIERS[i]
                    mixed ^= mixed >> np.uint32(15)
                found.append(mixed >> np.uint32(32 - BITS))
        yield np.concatenate(found).astype(np.int32)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``lang, bucket, n`` of a partition; bucket -1 counts documents."""
    counts: dict[str, np.ndarray] = {}

    def rows() -> pa.RecordBatch:
        langs, buckets, numbers = [], [], []
        for lang, vector in counts.items():
            known = np.flatnonzero(vector)
            langs += [lang] * len(known)
            buckets.append(known - 1)
            numbers.append(vector[known])
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(np.concatenate(buckets), pa.int32()), pa.array(np.concatenate(numbers), pa.int64())],
            ["lang", "bucket", "n"],
        )

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            if lang not in counts and len(counts) == OPEN_LANGUAGES:
                yield rows()
                counts.clear()
            vector = counts.setdefault(lang, np.zeros((1 << BITS) + 1, np.int64))
            vector[0] += 1
            for piece in grams(text.as_py()):
                vector[1:] += np.bincount(piece, minlength=1 << BITS)
    if counts:
        yield rows()


def train(docs: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, log priors and log probabilities from all rows with id, text and language that are not held out.

    More than MAX_LANGUAGES are refused with a ValueError before anything is counted, so what
    comes to the driver is bounded by the matrix.
    """
    known = docs.where("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL").where(~held_out(F.col("doc_id")))
    languages = known.agg(F.count_distinct("lang")).first()[0]
    if languages > MAX_LANGUAGES:
        raise ValueError(f"{languages} languages; the model is meant for {MAX_LANGUAGES} at most")
    text_rows(docs.sparkSession)
    counted = known.select("lang", "text").mapInArrow(_count, "lang string, bucket int, n long")
    summed = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = summed.toArrow()  # at most one row for each cell of the matrix
    langs = sorted(set(table["lang"].to_pylist()))
    cells = np.zeros((len(langs), (1 << BITS) + 1))
    place = {lang: i for i, lang in enumerate(langs)}
    rows = np.array([place[x] for x in table["lang"].to_pylist()], np.int64)
    cells[rows, table["bucket"].to_numpy() + 1] = table["n"].to_numpy()
    counts = cells[:, 1:] + SMOOTHING
    prior = np.log(cells[:, 0] / max(cells[:, 0].sum(), 1))
    return langs, prior, np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)


def score_texts(texts: list[str], prior: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """Log scores, one row per text: gathered columns of the matrix, summed text by text."""
    out = np.tile(prior, (len(texts), 1))
    room = max(1024, CELLS // max(1, len(prior)))
    pieces, owners, size = [], [], 0

    def add() -> None:
        nonlocal pieces, owners, size
        if pieces:
            starts = np.cumsum([0] + [len(p) for p in pieces[:-1]])
            sums = np.add.reduceat(logs[:, np.concatenate(pieces)], starts, axis=1, dtype=np.float64)
            np.add.at(out, owners, sums.T)
        pieces, owners, size = [], [], 0

    for i, text in enumerate(texts):
        for found in grams(text):
            for at in range(0, len(found), room):
                pieces.append(found[at : at + room])
                owners.append(i)
                size += len(pieces[-1])
                if size >= room:
                    add()
    add()
    return out


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray]) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row; ``und`` with score 0 without letters, or when nothing was learned."""
    langs = model[0]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, prior, logs = shared.value
        for batch in batches:
            names, sure = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            texts = batch.column(1).to_pylist()
            at = [i for i, t in enumerate(texts) if langs and t and any(map(str.isalpha, t))]
            if at:
                logged = score_texts([texts[i] for i in at], prior, logs)
                best = logged.argmax(axis=1)
                sure[at] = 1 / np.exp(logged - logged.max(axis=1, keepdims=True)).sum(axis=1)
                for i, b in zip(at, best.tolist()):
                    names[i] = langs[b]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names), pa.array(sure)], ["doc_id", "lang_pred", "score"])

    picked = docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text")
    text_rows(docs.sparkSession)
    return picked.mapInArrow(run, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row of ``docs(doc_id, text, lang)``.

    Repeated rows get the same result; rows with a null id are predicted but never learned
    from; an empty table gives no rows. Ties go to the first language by name.
    """
    found = predict(docs, train(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
