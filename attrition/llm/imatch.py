"""I-Match fingerprints over randomised subsets of a lexicon.

Terms whose inverse document frequency lies in a band form the lexicon, which is
dealt at random into subsets. A text keeps its terms in the lexicon, distinct and
sorted, and has one hash for each subset, of the kept terms in it. Subsets have
several sizes: large ones agree only for copies, small ones still agree for
texts that share a part, so the share of agreeing hashes grows with what two
texts share. Only DataFrame functions are used.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attrition.llm.scratch import ascii_lower, store

BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The band: terms in at least 1 of RAREST and at most 1 of COMMONEST documents.
RAREST, COMMONEST = 200, 5
# A lexicon of up to this many terms is one array that each row meets; a larger one is joined.
LEXICON_TERMS = 100_000
# The lowest byte of a term's number deals it to a subset: first byte of a range, subsets that cut the
# range, bytes in each. That makes 2 subsets of an eighth, 8 of 1/32, 16 of 1/64 and 32 of 1/128 of the terms.
RANGES = [(0, 2, 32), (64, 8, 8), (128, 16, 4), (192, 32, 2)]
SUBSETS = sum(n for _, n, _ in RANGES)
# What a subset without kept terms has in place of its hash, which is the hash of no text.
EMPTY, NO_TERMS = "-", hashlib.md5(b"").hexdigest()[:8]
# Two hashes of id and text, never null: they name a row, and exact repeats share them.
KEY = ["row1", "row2"]


def words(text: Column) -> Column:
    """Runs of ASCII letters, digits and all other than ASCII characters, A-Z lower-cased; may hold an empty word."""
    return F.split(ascii_lower(text), BREAKS)


def number(word: Column) -> Column:
    """A term's number: the first 60 bits of its MD5."""
    return F.conv(F.substring(F.md5(word), 1, 15), 16, 10).cast("long")


def numbers(text: Column) -> Column:
    """Numbers of a text's distinct terms."""
    return F.transform(F.array_remove(F.array_distinct(words(text)), ""), number)


def subset(term: Column) -> Column:
    byte = F.pmod(term, F.lit(256))
    found, first = F.lit(None).cast("int"), 0
    for start, n, width in RANGES:  # each condition is asked before those of lower bytes
        found = F.when(byte >= start, F.floor((byte - start) / width).cast("int") + first).otherwise(found)
        first += n
    return found


def marks() -> list[int]:
    """A number below 0 opens each subset in an ordered list of terms."""
    return [-1 - k for k in range(SUBSETS)]


def build_lexicon(docs: DataFrame, rarest: int = RAREST, commonest: int = COMMONEST) -> DataFrame:
    """``subset, term`` of every term in the band, and each subset's mark, written; frequencies count all rows of ``docs(text)``.

    A row has ``w`` distinct terms on average, so there are at most ``rarest * w`` terms, whatever the corpus holds.
    """
    total = docs.count()
    terms = docs.select(F.explode(numbers(F.col("text"))).alias("term"))
    counted = terms.groupBy("term").agg(F.count("*").alias("n"))
    band = counted.where(f"n * {rarest}L >= {total}L AND n * {commonest}L <= {total}L")
    opened = docs.sparkSession.range(SUBSETS).selectExpr("CAST(id AS INT) AS subset", "-1 - id AS term")
    return store(band.select(subset(F.col("term")).alias("subset"), "term").union(opened), "lexicon")


def with_kept(rows: DataFrame, lexicon: DataFrame, text: str, name: str, keys: list[str], limit: int = LEXICON_TERMS) -> DataFrame:
    """``rows`` with the terms of ``text`` that the lexicon holds, in order behind the mark of their subset; ``keys`` name a row."""
    if lexicon.count() <= limit:
        # One array, in order: what a row keeps of it is sorted and distinct.
        ordered = lexicon.agg(F.sort_array(F.collect_list(F.struct("subset", "term")))["term"].alias("terms")).scalar()
        marked = F.concat(numbers(F.col(text)), F.array(*[F.lit(m).cast("long") for m in marks()]))
        return rows.withColumn(name, F.array_intersect(ordered, marked))
    opened = F.array(*[F.struct(F.lit(k).alias("subset"), F.lit(m).cast("long").alias("term")) for k, m in enumerate(marks())])
    terms = rows.select(*keys, F.explode(numbers(F.col(text))).alias("term")).join(lexicon, "term")
    found = terms.groupBy(*keys).agg(F.collect_set(F.struct("subset", "term")).alias("found"))
    joined = rows.join(found, keys, "left")
    return joined.withColumn(name, F.sort_array(F.concat(F.coalesce("found", F.slice(opened, 1, 0)), opened))["term"]).drop("found")


def fingerprint(kept: Column, text: Column) -> Column:
    """One hash of eight hex digits for each subset, ``-`` where it holds no kept term.

    A text without any kept term is named by a hash of all its distinct terms instead.
    """
    every = F.sort_array(numbers(text)).cast("array<string>")
    whole = F.concat(F.lit("all:"), F.md5(F.array_join(every, ",")))
    # The first piece is what stands before the first mark: nothing.
    parts = F.split(F.array_join(kept.cast("array<string>"), ","), ",?-[0-9]+,?")
    prints = F.array_join(F.transform(F.slice(parts, 2, SUBSETS), lambda p: F.substring(F.md5(p), 1, 8)), ".")
    return F.when(F.size(kept) == SUBSETS, whole).otherwise(F.replace(prints, F.lit(NO_TERMS), F.lit(EMPTY)))


def likeness(a: Column, b: Column) -> Column:
    """Share of subsets on which two fingerprints agree, of those that hold terms of either: 1 for equal ones."""
    pairs = F.arrays_zip(F.split(a, r"\.").alias("a"), F.split(b, r"\.").alias("b"))
    some = F.filter(pairs, lambda p: (p["a"] != EMPTY) | (p["b"] != EMPTY))
    agree = F.filter(some, lambda p: p["a"] == p["b"])
    apart = a.startswith("all:") | b.startswith("all:")
    return F.when(a == b, 1.0).when(apart, 0.0).otherwise(F.size(agree).cast("double") / F.size(some))


def next_rows(rows: DataFrame) -> DataFrame:
    """The key of each of ``rows(doc_id, row1, row2, n_chars, copies)`` with ``before``, the row that has it as its next.

    Rows go by falling id, nulls last, then by their hashes; the first follows the last.
    Ranges are numbered apart, and only the first and last row of each meets the others.
    """
    order, row = [F.col("doc_id").desc_nulls_last(), *KEY], F.struct("doc_id", *KEY, "n_chars", "copies")
    ranged = store(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ranged")
    inside = ranged.withColumn("before", F.lag(row).over(Window.partitionBy("part").orderBy(*order)))
    # One row for each range; null ids come last in a range.
    last = ranged.groupBy("part").agg(F.max_by(row, F.struct(F.col("doc_id").isNull(), -F.col("doc_id"), *KEY)).alias("last"))
    ends = F.coalesce(F.lag("last").over(Window.orderBy("part")), F.max_by("last", "part").over(Window.partitionBy()))
    return inside.join(last.select("part", ends.alias("end")), "part").select(*KEY, F.coalesce("before", "end").alias("before"))


def edited_prints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LEXICON_TERMS) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` of every row.

    The edited text has the last ``floor(n_chars / 2)`` code points replaced by the first as many, or all, of the
    next row's text by falling id (after the last: the first; a single row is its own next). Null texts are empty,
    and all texts without a word are alike. Rows that repeat an id with another text come one after the other, by
    hash of the text; null ids come last; rows that repeat id and text are one row to their neighbours and each get
    its results. Texts are whole, however long. An empty table gives no rows.
    """
    given = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    lexicon = build_lexicon(given)
    no_id = F.col("doc_id").isNull()
    named = given.withColumns({"row1": F.xxhash64(no_id, "doc_id", "text"), "row2": F.xxhash64(F.lit(7), "text", no_id, "doc_id")})
    sizes = named.groupBy("doc_id", *KEY, F.char_length("text").alias("n_chars")).agg(F.count("*").alias("copies"))
    follow = store(next_rows(sizes), "followers")

    # Copies of a row meet before texts are compared. Whole texts are shuffled once, by row, and what an edit takes of them once more.
    texts = named.groupBy(*KEY).agg(F.first("text").alias("text"))
    theirs = with_kept(texts.join(follow, KEY), lexicon, "text", "kept", KEY, limit)
    heads = theirs.select(
        "before.*",
        F.expr("substring(text, 1, CAST(before.n_chars div 2 AS INT))").alias("head"),
        fingerprint(F.col("kept"), F.col("text")).alias("next_fingerprint"),
    )
    met = with_kept(texts.join(heads, KEY), lexicon, "text", "kept", KEY, limit)
    met = met.withColumn("fingerprint", fingerprint(F.col("kept"), F.col("text")))
    met = met.withColumn("edited", F.concat(F.expr("substring(text, 1, CAST(n_chars - n_chars div 2 AS INT))"), "head")).drop("text", "head", "kept")
    met = with_kept(met, lexicon, "edited", "kept", KEY, limit)
    done = met.select(
        "doc_id",
        "copies",
        F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        fingerprint(F.col("kept"), F.col("edited")).alias("edited_fingerprint"),
        "next_fingerprint",
    )
    scored = done.select(
        "*",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
    # Copies are listed in two steps, so that no array grows with their number.
    lots = scored.withColumn("lot", F.explode(F.expr("sequence(0L, (copies - 1) div 10000)")))
    each = lots.withColumn("copy", F.explode(F.expr("sequence(lot * 10000, least((lot + 1) * 10000, copies) - 1)")))
    return each.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
