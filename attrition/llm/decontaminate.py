"""Benchmark decontamination over a positional inverted index of the corpus.

Documents are tokenised once into index segments: for each benchmark term its
sorted positions, document after document. A phrase is found by taking the
posting list of its rarest term, shifting it to the phrase's start, and
intersecting it with the shifted lists of the other terms, rarest first. The
same lists give proximity matches. The benchmark is the stated query set; it is
sent to the segments in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.llm.scratch import store, text_rows

# Characters of benchmark text in one broadcast block.
BLOCK_CHARS = 8_000_000
# A segment is closed at this many postings or word positions.
SEGMENT_POSTINGS, SEGMENT_WORDS = 1_000_000, 2_000_000

# Bytes that separate words: 00-2F, 3A-60 and 7B-7F without A-Z, which are lower-cased.
_WORDS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)

INDEX = (
    "segment string, terms array<int>, sizes array<int>, postings binary, "
    "doc_ids array<long>, starts array<long>, words array<long>"
)
MATCHES = "doc_id long, n_words long, hits array<struct<start: long, end: long>>, items array<string>, near_items array<string>"


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased words of a text's UTF-8 bytes; none for null."""
    return text.translate(_WORDS).split() if text else []


def build_index(
    docs: DataFrame, vocabulary: dict[bytes, int], gap: int, id_col: str = "doc_id", text_col: str = "text", keys: Sequence[str] = ()
) -> DataFrame:
    """Index segments of ``docs``; only terms of ``vocabulary`` get postings.

    Positions run on over a segment's documents, with ``gap`` unused ones between two,
    so no match reaches from one document into the next. ``keys`` are long columns kept for each document.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        term_of = shared.value.get
        part, number = TaskContext.get().partitionId(), 0
        terms, places, docs_in, at, count = [], [], [], 0, 0
        for batch in batches:
            for doc, text, *own in zip(batch.column(0).to_pylist(), batch.column(1), *(c.to_pylist() for c in batch.columns[2:])):
                words = words_of(text.as_py())
                ids = np.fromiter((term_of(w, -1) for w in words), np.int32, len(words))
                known = np.flatnonzero(ids >= 0)
                terms.append(ids[known])
                places.append(known + at)
                docs_in.append((doc, at, len(words), *own))
                at, count = at + len(words) + gap, count + len(known)
                if count >= SEGMENT_POSTINGS or at >= SEGMENT_WORDS:
                    yield _segment(f"{part}-{number}", terms, places, docs_in, keys)
                    terms, places, docs_in, at, count, number = [], [], [], 0, 0, number + 1
        if docs_in:
            yield _segment(f"{part}-{number}", terms, places, docs_in, keys)

    picked = docs.selectExpr(f"CAST(`{id_col}` AS BIGINT) AS doc_id", f"CAST(`{text_col}` AS BINARY) AS text", *[f"`{k}`" for k in keys])
    text_rows(docs.sparkSession)
    return picked.mapInArrow(index, ", ".join([INDEX, *(f"`{k}` array<long>" for k in keys)]))


def _segment(name: str, terms: list, places: list, docs_in: list, keys: Sequence[str] = ()) -> pa.RecordBatch:
    term, place = np.concatenate(terms), np.concatenate(places).astype(np.int32)
    order = np.argsort(term, kind="stable")
    distinct, sizes = np.unique(term, return_counts=True)
    by_doc = zip(*docs_in)  # ids, starts, words, keys
    columns = [
        pa.array([name]),
        pa.array([distinct.tolist()], pa.list_(pa.int32())),
        pa.array([sizes.tolist()], pa.list_(pa.int32())),
        pa.array([place[order].tobytes()], pa.binary()),
        *(pa.array([list(x)], pa.list_(pa.int64())) for x in by_doc),
    ]
    return pa.RecordBatch.from_arrays(columns, ["segment", "terms", "sizes", "postings", "doc_ids", "starts", "words", *keys])


def windows_of(items: list[tuple[str, np.ndarray]], width: int) -> dict[tuple[int, ...], list[str]]:
    """Windows of ``width`` terms with the items that hold them; an item of fewer terms is one window."""
    found: dict[tuple[int, ...], list[str]] = {}
    for name, terms in items:
        row = terms.tolist()
        for i in range(max(1, len(row) - width + 1) if row else 0):
            holders = found.setdefault(tuple(row[i : i + width]), [])
            if name not in holders[-1:]:
                holders.append(name)
    return found


def phrase_starts(window: list[tuple[int, int]], lists: dict[int, np.ndarray]) -> np.ndarray:
    """Where a phrase begins; ``window`` has (term, offset) pairs, rarest first."""
    term, offset = window[0]
    starts = lists[term] - offset
    for term, offset in window[1:]:
        if not len(starts):
            break
        other = lists[term]
        at = np.searchsorted(other, starts + offset)
        starts = starts[(at < len(other)) & (other[np.minimum(at, len(other) - 1)] == starts + offset)]
    return starts


def near_places(window: list[tuple[int, int]], lists: dict[int, np.ndarray], reach: int) -> np.ndarray:
    """Places of the rarest term that have every other term within ``reach`` words."""
    places = lists[window[0][0]]
    for term in dict.fromkeys(t for t, _ in window[1:]):
        if not len(places):
            break
        other = lists[term]
        at = np.searchsorted(other, places - reach)
        places = places[(at < len(other)) & (other[np.minimum(at, len(other) - 1)] <= places + reach)]
    return places


def find_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = 13,
    slop: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
    keys: Sequence[str] = (),
) -> DataFrame:
    """``doc_id, n_words, hits, items, near_items`` and ``keys`` (long columns) for every row of ``docs``.

    ``hits`` are the runs of word positions inside an occurrence of a benchmark window,
    ``items`` the ids (as text, sorted) of benchmark items with an occurring window, and
    ``near_items`` those with all words of a window within ``width - 1 + slop`` words of
    its rarest one, in any order. A null text has no words; an item without words has no
    windows; repeated rows of either table change nothing for others. Empty tables give
    no rows, or no matches.
    """
    spark = docs.sparkSession
    asked = benchmark.selectExpr("CAST(item_id AS STRING) AS item_id", "CAST(text AS BINARY) AS text").where("text IS NOT NULL AND item_id IS NOT NULL")
    chars = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-chars // BLOCK_CHARS)
    vocabulary: dict[bytes, int] = {}
    parts = []
    for block in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).distinct()
        items = []
        for row in mine.toLocalIterator():
            words = words_of(bytes(row["text"]))
            items.append((row["item_id"], np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words], np.int32)))
        parts.append(items)

    reach = width - 1 + slop
    index = store(build_index(docs, vocabulary, reach + 1, id_col, text_col, keys), "postings")
    sizes = index.select(F.explode(F.arrays_zip("terms", "sizes")).alias("x")).groupBy("x.terms").agg(F.sum("x.sizes").alias("n"))
    total = np.zeros(len(vocabulary), np.int64)
    for row in sizes.toLocalIterator():  # at most one row for each benchmark term
        total[row["terms"]] = row["n"]
    sent = []
    for items in parts:
        rows = [
            (sorted(((t, i) for i, t in enumerate(w)), key=lambda x: (total[x[0]], x[1])), len(w), names)
            for w, names in windows_of(items, width).items()
            if all(total[t] for t in w)
        ]
        sent.append(spark.sparkContext.broadcast(rows))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                yield _search_segment(batch.slice(at, 1).to_pylist()[0], sent, reach, keys)

    return index.mapInArrow(search, ", ".join([MATCHES, *(f"`{k}` long" for k in keys)]))


def _search_segment(row: dict, sent: list, reach: int, keys: Sequence[str] = ()) -> pa.RecordBatch:
    starts, words = np.array(row["starts"], np.int64), np.array(row["words"], np.int64)
    flat = np.frombuffer(row["postings"], np.int32).astype(np.int64)
    lists = dict(zip(row["terms"], np.split(flat, np.cumsum(row["sizes"])[:-1]) if row["sizes"] else []))
    marks = np.zeros(int(starts[-1] + words[-1]) + 2, np.int32)
    exact: dict[int, set[str]] = {}
    near: dict[int, set[str]] = {}
    for block in sent:
        for window, width, names in block.value:
            if any(term not in lists for term, _ in window):
                continue
            for found, places in ((near, near_places(window, lists, reach)), (exact, phrase_starts(window, lists))):
                if not len(places):
                    break
                for doc in np.unique(np.searchsorted(starts, places, "right") - 1).tolist():
                    found.setdefault(doc, set()).update(names)
                if found is exact:
                    np.add.at(marks, places, 1)
                    np.add.at(marks, places + width, -1)
    edges = np.diff((np.cumsum(marks) > 0).astype(np.int8), prepend=0)
    opens, closes = np.flatnonzero(edges > 0), np.flatnonzero(edges < 0)
    owner = np.searchsorted(starts, opens, "right") - 1
    hits: list[list] = [[] for _ in starts]
    for doc, a, b in zip(owner.tolist(), opens.tolist(), closes.tolist()):
        hits[doc].append({"start": a - int(starts[doc]), "end": b - int(starts[doc])})
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    columns = [
        pa.array(row["doc_ids"], pa.int64()),
        pa.array(words),
        pa.array(hits, pa.list_(span)),
        *(pa.array([sorted(found.get(i, ())) for i in range(len(starts))], pa.list_(pa.string())) for found in (exact, near)),
        *(pa.array(row[k], pa.int64()) for k in keys),
    ]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "hits", "items", "near_items", *keys])


def judged(matches: DataFrame) -> DataFrame:
    """``matches`` with ``n_hit`` and the contract's rule: a twentieth of the words, or more, inside hits."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + h["end"] - h["start"])
    hit = matches.withColumn("n_hit", n_hit)
    return hit.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
