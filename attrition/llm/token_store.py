"""Token ids in a bit-plane file format.

Ids run on over the documents in ascending id order. They are cut into blocks
of a fixed number of ids; each block is transposed into byte or bit planes and
every plane compressed with zstandard. Blocks are gathered into segments that
hold whole documents. A segment is one binary value of a table that Spark
writes, so writing is atomic and works on any store Spark can reach.

Segment, little-endian: ``PLN1``; kind of plane (u8, 8 bytes or 1 bit); planes
(u8); zero (u16); ids in a block (u32); ids (u64); then the chunk index, one
u32 per block and plane with its compressed length; then the planes in that
order. A bit plane is packed, first id in the highest bit.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count, islice

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attrition.llm.scratch import folder, text_rows

MAGIC, HEAD = b"PLN1", struct.Struct("<4sBBHIQ")
BLOCK_IDS = 65536
# A segment is closed at the end of the document that brings it to this many ids.
SEGMENT_IDS = 1 << 19
# Entries of a worker's word memo, of which the earlier half, with the frequent words, stays when
# it is full; bytes of text looked up at once.
MEMO_WORDS, GROUP_BYTES = 700_000, 2_000_000

SEGMENTS = "part int, segment int, before long, n_ids long, doc_ids array<long>, lengths array<long>, payload binary"


def to_planes(block: np.ndarray, plane: int) -> list[bytes]:
    """Byte (8) or bit (1) planes of uint32 ids, least significant byte first."""
    by_byte = block.astype("<u4").view(np.uint8).reshape(-1, 4).T
    if plane == 8:
        return [row.tobytes() for row in by_byte]
    return [np.packbits((row >> bit) & 1).tobytes() for row in by_byte for bit in range(8)]


def from_planes(planes: list[bytes], n: int, plane: int) -> np.ndarray:
    if plane == 8:
        return np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1).copy().view("<u4").reshape(-1)
    bits = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n) for p in planes], axis=1)
    return np.packbits(bits, axis=1, bitorder="little").view("<u4").reshape(-1)


def write_segment(ids: np.ndarray, plane: int = 8, block_ids: int = BLOCK_IDS, level: int = 3) -> bytes:
    packer = zstandard.ZstdCompressor(level=level)
    planes = [packer.compress(p) for i in range(0, len(ids), block_ids) for p in to_planes(ids[i : i + block_ids], plane)]
    head = HEAD.pack(MAGIC, plane, 32 // plane, 0, block_ids, len(ids))
    return b"".join([head, np.array([len(p) for p in planes], "<u4").tobytes(), *planes])


def read_segment(data: bytes) -> np.ndarray:
    magic, plane, count, _, block_ids, n = HEAD.unpack_from(data)
    if magic != MAGIC or count * plane != 32:
        raise ValueError("not a token segment")
    blocks = -(-n // block_ids)
    sizes = np.frombuffer(data, "<u4", blocks * count, HEAD.size)
    ends = HEAD.size + sizes.nbytes + np.cumsum(sizes.astype(np.int64))
    unpack, view, out = zstandard.ZstdDecompressor(), memoryview(data), []
    for b in range(blocks):
        width = min(block_ids, n - b * block_ids)
        k = range(b * count, (b + 1) * count)
        out.append(from_planes([unpack.decompress(view[ends[i] - sizes[i] : ends[i]]) for i in k], width, plane))
    return np.concatenate(out) if out else np.zeros(0, "<u4")


def _splitter(spec: dict) -> dict:
    splitters = spec.get("pre_tokenizer") or {}
    return splitters.get("pretokenizers", [splitters])[0]


def splits_at_blanks(spec: dict) -> bool:
    """Whether a tokenizer lower-cases and treats the stretches between white space apart.

    Then the ids of a text are those of its stretches, one after the other.
    """
    normalizers = spec.get("normalizer") or {}
    steps = normalizers.get("normalizers", [normalizers])
    first = _splitter(spec)
    if not any(s.get("type") == "Lowercase" for s in steps) or any(s.get("type") not in ("NFC", "Replace", "Lowercase") for s in steps):
        return False
    if any(s["type"] == "Replace" and (s["pattern"], s["content"]) != ({"Regex": "\\s+"}, " ") for s in steps):
        return False
    if first.get("type") != "Split" or first.get("behavior") != "Removed" or not first.get("invert"):
        return False
    pattern = regex.compile(first["pattern"].get("Regex", "."))
    return not any(pattern.search(blank) for blank in " \t\n\r\v\f")


class Encoder:
    """A tokenizer with a memo of the words this worker has met.

    Each new word gets the next number; ``starts`` and ``sizes`` give its ids' place in ``flat``.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t["content"].lower().encode() for t in spec.get("added_tokens") or []]
        mark = self._plain("|")
        self.mark = mark[0] if len(mark) == 1 else None
        self.by_word = self.mark is not None and splits_at_blanks(spec)
        self.pattern = regex.compile(_splitter(spec)["pattern"].get("Regex", ".")) if self.by_word else None
        # Ids that end a word, where the model marks them.
        suffix = spec["model"].get("end_of_word_suffix")
        self.ends = None
        if suffix:
            names = self.tokenizer.get_vocab()
            self.ends = np.zeros(max(names.values()) + 1, bool)
            self.ends[[i for name, i in names.items() if name.endswith(suffix)]] = True
        self.number: dict[bytes, int] = defaultdict(count().__next__)
        self.starts, self.sizes, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u4")

    def _forget(self) -> None:
        """Keep the words met first."""
        n = len(self.number) // 2
        self.number = defaultdict(count(n).__next__, islice(self.number.items(), n))
        self.flat = self.flat[: self.starts[n]].copy()
        self.starts, self.sizes = self.starts[:n].copy(), self.sizes[:n].copy()

    def _plain(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _whole(self, text: bytes) -> bytes:
        return np.array(self._plain(text.decode("utf-8", "replace")), "<u4").tobytes()

    def encode(self, texts: list[bytes], end: bytes) -> list[bytes]:
        """Ids of each text as little-endian uint32 bytes, with ``end`` after them."""
        if not self.by_word:
            return [self._whole(t) + end for t in texts]
        if len(self.number) > MEMO_WORDS:
            self._forget()
        known, lookup, rows, apart = len(self.number), self.number.__getitem__, [], {}
        for i, text in enumerate(texts):
            low = text.lower()
            if any(a in low for a in self.added):
                apart[i] = self._whole(text)  # an added token counts only as it is written: no lower-casing
                low = b""
            words = low.split()
            rows.append(np.fromiter(map(lookup, words), np.int64, len(words)))
        self._learn(known)
        words = np.concatenate(rows)
        sizes = self.sizes[words]
        ends = np.cumsum(sizes)
        places = np.repeat(self.starts[words] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)
        data = memoryview(self.flat[places].tobytes())
        cuts = np.concatenate([[0], ends])[np.cumsum([0] + [len(r) for r in rows])].tolist()
        return [apart.get(i, b"") + bytes(data[4 * cuts[i] : 4 * cuts[i + 1]]) + end for i in range(len(texts))]

    def _fresh(self, known: int) -> list[bytes]:
        """Words numbered from ``known`` on, in that order."""
        return list(islice(reversed(self.number), len(self.number) - known))[::-1]

    def _apart(self, core: bytes, stops: bytes) -> bool:
        """Whether the tokenizer cuts a word of ASCII letters and stops between them, and both parts as if alone."""
        letters, marks = core.decode(), stops.decode()
        alone = [m.group() for part in (letters, marks) for m in self.pattern.finditer(part)]
        return alone == [m.group() for m in self.pattern.finditer(letters + marks)]

    def _learn(self, known: int) -> None:
        """Encode the words numbered from ``known`` on, many to a call."""
        tails = {}
        for word in self._fresh(known):
            core = word.rstrip(b".,")
            if core != word and core.isalpha() and self._apart(core, word[len(core) :]):  # letters, then stops
                tails[word] = self.number[core], self.number[word[len(core) :]]
        fresh = self._fresh(known)
        new = [w for w in fresh if w not in tails]
        found: dict[bytes, bytes] = {}
        letters = {w for w in new if w.decode("utf-8", "replace").isalpha()} if self.ends is not None else set()
        self._together([w for w in new if w in letters], b" ", found)
        self._together([w for w in new if w not in letters and b"|" not in w], b" | ", found)
        for word in new:
            if word not in found:
                found[word] = self._whole(word)
        for word, parts in tails.items():
            found[word] = b"".join(
                found[fresh[p - known]] if p >= known else self.flat[self.starts[p] : self.starts[p] + self.sizes[p]].tobytes()
                for p in parts
            )
        pieces = [found[w] for w in fresh]
        sizes = np.array([len(p) // 4 for p in pieces], np.int64)
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(pieces), "<u4")])

    def _together(self, words: list[bytes], between: bytes, found: dict[bytes, bytes]) -> None:
        """Encode words joined by blanks, cut after the ids that end a word, or by marks, cut at the marks' id."""
        groups = [words[i : i + 256] for i in range(0, len(words), 256)]
        joined = [between.join(g).decode("utf-8", "replace") for g in groups]
        by_end = between == b" "
        for group, encoded in zip(groups, self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)):
            ids = np.array(encoded.ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1 if by_end else np.append(np.flatnonzero(ids == self.mark), len(ids))
            if len(cuts) != len(group):  # a word that is more than one piece after all; each is encoded alone
                continue
            data, start = ids.tobytes(), 0
            for word, cut in zip(group, cuts.tolist()):
                found[word] = data[4 * start : 4 * cut]
                start = cut if by_end else cut + 1


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker and file, as loading takes long and the memo is worth keeping."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
    """Ids and texts in groups of bounded size; a longer text is a group of its own."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids.append(doc)
            texts.append(text.as_py() or b"")
            size += len(texts[-1])
            if size >= GROUP_BYTES:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _segments(path: str, end_id: int, plane: int) -> Callable:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, before = TaskContext.get().partitionId(), 0, 0
        end = np.array([end_id], "<u4").tobytes()
        doc_ids, pieces, size = [], [], 0

        def close() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(pieces), "<u4")
            columns = [[part], [number], [before], [len(ids)], [doc_ids], [[len(p) // 4 for p in pieces]], [write_segment(ids, plane)]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            names = ["part", "segment", "before", "n_ids", "doc_ids", "lengths", "payload"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for ids, texts in _texts(batches):
            for doc, piece in zip(ids, encoder(path).encode(texts, end)):
                doc_ids.append(doc)
                pieces.append(piece)
                size += len(piece) // 4
                if size >= SEGMENT_IDS:
                    yield close()
                    doc_ids, pieces, before, size, number = [], [], before + size, 0, number + 1
        if doc_ids:
            yield close()

    return write


def write_tokens(
    docs: DataFrame, target: str, tokenizer: str, end_id: int = 1, plane: int = 8, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Encode whole texts and write them under ``target``: ``tokens`` (segments) and ``index`` (the chunk index).

    Documents are range-partitioned by id; a null text counts as empty, and each document
    ends with ``end_id``. Rows with one id follow each other, ordered by text; a null id
    comes first. ``tokenizer`` is a file each executor has. An empty table writes no segments.
    """
    picked = docs.selectExpr(f"CAST(`{id_col}` AS BIGINT) AS doc_id", f"CAST(`{text_col}` AS BINARY) AS text", f"xxhash64(`{text_col}`) AS tie")
    ordered = picked.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").select("doc_id", "text")
    text_rows(docs.sparkSession)
    # The segments are compressed already.
    ordered.mapInArrow(_segments(tokenizer, end_id, plane), SEGMENTS).write.option("compression", "none").parquet(f"{target}/tokens")
    spark = docs.sparkSession
    segments = spark.read.schema(SEGMENTS).parquet(f"{target}/tokens")
    # One row for each partition of the write.
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("in_part"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("part", F.coalesce(F.sum("in_part").over(order), F.lit(0)).alias("base"))
    index = segments.join(F.broadcast(bases), "part").select(
        "part",
        "segment",
        (F.col("base") + F.col("before")).alias("start"),
        "n_ids",
        F.size("doc_ids").alias("n_docs"),
        F.col("doc_ids")[0].alias("first_doc"),
    )
    index.write.parquet(f"{target}/index")


def read_tokens(spark, source: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, decoded from the files under ``source``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                data = memoryview(read_segment(row["payload"]).astype("<u4").tobytes())
                ends = np.cumsum(row["lengths"])
                if 4 * (int(ends[-1]) if len(ends) else 0) != len(data):
                    raise ValueError("a segment does not hold its documents")
                starts = ends - row["lengths"]
                crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                n = len(starts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["part"]] * n, pa.int32()),
                        pa.array([row["segment"]] * n, pa.int32()),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(starts, pa.int64()),
                        pa.array(row["lengths"], pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    ["part", "segment", "doc_id", "offset", "n_tokens", "ids_crc32"],
                )

    segments = spark.read.schema(SEGMENTS).parquet(f"{source}/tokens").select("part", "segment", "doc_ids", "lengths", "payload")
    docs = segments.mapInArrow(read, "part int, segment int, doc_id long, offset long, n_tokens long, ids_crc32 long")
    index = spark.read.parquet(f"{source}/index").select("part", "segment", "start")
    return docs.join(index, ["part", "segment"]).select(
        "doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )


def new_target(spark) -> str:
    """A folder of its own under the shared one."""
    import uuid

    return f"{folder(spark)}/tokens-{uuid.uuid4().hex}"
