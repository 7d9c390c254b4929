"""I-Match fingerprints, exact whitening and the conversation trie against plain versions."""

import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import plain
import pytest
from attrition.llm import imatch, prefix_trie, queries, whitening
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(plain.odd_documents(), plain.DOCS).repartition(3)


# I-Match


def prints(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_edits_go_down_the_ids_and_round(spark):
    rows = [(5, "abcdef gh"), (3, "xy"), (9, None), (1, "\U0001f600é中" * 3), (None, "0123456789")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r.doc_id: r for r in imatch.edited_prints(docs).collect()}
    edited = {9: "", 5: "abcdexy", 3: "x\U0001f600", 1: "\U0001f600é中\U0001f600é0123", None: "01234"}
    assert {i: r.edited_sha256 for i, r in found.items()} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in edited.items()}
    assert {i: r.n_chars for i, r in found.items()} == {9: 0, 5: 9, 3: 2, 1: 9, None: 10}
    assert found[9].near_edited == 1.0 and found[9].fingerprint.startswith("all:")


def test_a_document_alone_is_its_own_next(spark):
    (row,) = imatch.edited_prints(spark.createDataFrame([(1, "one two three four")], "doc_id long, text string")).collect()
    assert row.edited_sha256 == hashlib.sha256(b"one two tone two t").hexdigest() and row.near_next == 1.0


def test_prints_of_odd_rows(spark, odd):
    found = imatch.edited_prints(odd).collect()
    assert len(found) == odd.count() and set(found[0].asDict()) & set(odd.columns) == {"doc_id", "n_chars"}
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    text = {r.doc_id: r.text for r in odd.collect()}
    by_text = {}
    for row in found:
        by_text.setdefault(text[row.doc_id] or "", set()).add(row.fingerprint)
    assert all(len(p) == 1 for p in by_text.values())
    assert imatch.edited_prints(odd.limit(0)).collect() == []


def test_a_joined_lexicon_gives_the_same_prints(spark, odd, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").union(odd.select("doc_id", "text"))
    assert prints(imatch.edited_prints(docs, limit=0)) == prints(imatch.edited_prints(docs))


def test_copies_of_a_row_are_one_row_to_their_neighbours(spark):
    rows = [(i, f"text number {i} of a few") for i in range(6)]
    once = imatch.edited_prints(spark.createDataFrame(rows, "doc_id long, text string"))
    more = imatch.edited_prints(spark.createDataFrame(rows + [rows[2]] * 40, "doc_id long, text string").repartition(5))
    edits = {r.doc_id: r.edited_sha256 for r in once.collect()}
    assert [edits[r.doc_id] == r.edited_sha256 for r in more.collect()] == [True] * 46


def test_subsets_cover_the_lexicon_in_their_sizes(spark):
    counts = dict(spark.range(256).groupBy(imatch.subset(F.col("id"))).count().collect())
    assert sorted(counts.values(), reverse=True) == [32] * 2 + [8] * 8 + [4] * 16 + [2] * 32 and set(counts) == set(range(58))


def test_likeness_falls_with_what_is_edited(spark, sf_dir):
    found = queries.op11_imatch(spark, sf_dir).agg(F.avg("near_edited"), F.avg("near_next")).first()
    assert found[0] > 5 * found[1]


# Whitening


def placed(df):
    by_id: dict = {}
    for r in df.orderBy("component").collect():
        by_id.setdefault(r.vec_id, []).append(r)
    return by_id


def same_but_signs(found: np.ndarray, want: np.ndarray, close: float = 1e-9) -> bool:
    return all(min(np.abs(f - w).max(), np.abs(f + w).max()) < close for f, w in zip(found.T, want.T))


def test_whitening_query(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    found = placed(queries.op12_whitening(spark, sf_dir))
    shares, deviations, white = plain.whitened([r.embedding for r in table])
    rows = [found[r.vec_id] for r in table]
    assert len(found) == len(table) and all([r.component for r in of] == [1, 2, 3, 4] for of in rows)
    assert [of[0].deviation for of in rows] == list(deviations)
    assert same_but_signs(np.array([[r.whitened for r in of] for of in rows]), white)
    assert np.allclose([r.explained for r in rows[0]], shares, rtol=1e-12)
    assert {r.identity_error for of in rows for r in of} == {rows[0][0].identity_error} and rows[0][0].identity_error < 1e-12


def test_whitening_of_odd_rows(spark):
    good = [[0.1 * i, -0.03 * i * i, 1.0 + (i % 3)] for i in range(12)]
    rows = [(i, v) for i, v in enumerate(good)]
    rows += [(20, None), (21, [0.1, None, 0.2]), (22, [0.1, math.nan, 0.2]), (23, [math.inf, 0.0, 0.0]), (24, []), (25, [0.5] * 5)]
    rows += [(3, good[3]), (None, good[4]), (26, [-0.0, 0.0, 0.5])]
    table = spark.createDataFrame([(*r, 1, 0.5) for r in rows], "vec_id long, embedding array<float>, n int, x double").repartition(3)
    found = placed(whitening.whiten(table))
    assert set(found) == {*range(12), 24, 25, 26, None} and len(found[3]) == 6 and len(found[None]) == 3
    assert all(r.deviation is None and r.whitened is None for i in (24, 25) for r in found[i])
    shares, deviations, white = plain.whitened([np.float32(v) for v in good] + [[-0.0, 0.0, 0.5]])
    rows = [found[i] for i in [*range(12), 26]]
    assert [of[0].deviation for of in rows] == list(deviations)
    assert same_but_signs(np.array([[r.whitened for r in of][:3] if len(of) == 3 else [of[0].whitened, of[2].whitened, of[4].whitened] for of in rows]), white)
    assert whitening.whiten(table.limit(0)).collect() == []
    assert whitening.whiten(table.where("vec_id = 3")).collect() == []


def test_huge_entries_stay_exact(spark):
    vectors = [[2.0**40, 3.0], [-(2.0**41), 5.0], [1e300, 0.0], [-1e300, 7.0], [0.25, 0.5]]
    found = placed(whitening.whiten(spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")))
    x = [[min(max(math.floor(c * 256), -(2**63)), 2**63 - 1) for c in v] for v in vectors]
    total = [sum(c) for c in zip(*x)]
    want = [sum((5 * a - t) ** 2 for a, t in zip(row, total)) for row in x]
    assert [found[i][0].deviation for i in range(5)] == [w if w < 2**63 else None for w in want]
    assert found[0][0].identity_error < 1e-9


def test_scatter_is_exact():
    rng = random.Random(1)
    x = np.array([[rng.randrange(-(2**62), 2**62) if rng.random() < 0.1 else rng.randrange(-300, 300) for _ in range(5)] for _ in range(5000)])
    want = x.astype(object).T @ x.astype(object)
    assert (whitening.scatter_of(x) == want).all()


def symmetric(d: int, seed: int) -> np.ndarray:
    a = np.array([[random.Random(seed * 1000 + i * d + j).randrange(-50, 50) for j in range(d)] for i in range(d)], object)
    return a.T @ a


def test_characteristic_polynomial_is_exact(spark):
    for d, seed in [(1, 1), (2, 2), (7, 3), (12, 4)]:
        matrix = symmetric(d, seed)
        coefficients = whitening.polynomial(spark, matrix)
        # By traces of powers, in fractions.
        want, power = [Fraction(1)], np.eye(d, dtype=int).astype(object)
        for k in range(1, d + 1):
            power = matrix @ (power if k == 1 else power + want[-1] * np.eye(d, dtype=int).astype(object))
            want.append(Fraction(-int(np.trace(power)), k))
        assert coefficients == [int(c) for c in reversed(want)]


def test_roots_and_null_spaces_of_repeated_eigenvalues(spark):
    q = np.array([[1, 1, 1, 1], [1, -1, 1, -1], [1, 1, -1, -1], [1, -1, -1, 1]], object)
    matrix = (q @ np.diag([9, 9, 4, 0]).astype(object) @ q.T) // 1
    values, axes = whitening.components(spark, matrix)
    assert [round(float(v), 12) for v in values] == [36, 36, 16]  # the fourth is 0 and no component
    a = np.array(axes)
    assert np.allclose(a @ a.T, np.eye(3), atol=1e-14) and np.allclose(a @ matrix.astype(float), np.array([[36], [36], [16]]) * a, atol=1e-12)
    assert whitening.components(spark, np.zeros((3, 3), object)) == ([], [])


def test_roots_are_isolated_to_many_bits():
    # (x - 2)(x^2 - 2): roots 2, the square root of 2, and its negative are counted from above.
    coefficients = [4, -2, -2, 1]
    assert whitening.roots_above(coefficients, 0, 0) == 2
    second = whitening.isolate(coefficients, 2, 3)
    assert abs(second * second - 2) < Fraction(1, 1 << 90)


# Trie


def conversations() -> list[tuple]:
    rng = random.Random(3)
    rows = [(c, t, ["user", "assistant"][t % 2], f"said {rng.randrange(2)}") for c in range(150, 420) for t in range(rng.randrange(1, 7))]
    rows += [(c, t, "user", "hello") for c in range(500, 560) for t in range(3)]  # a group of copies
    rows += [(700, t, "user", f"turn {t}") for t in range(300)]  # long ones that part late
    rows += [(701, t, "user", f"turn {t}") for t in range(250)]
    rows += [(-7, 0, None, None), (-7, None, "user", "first"), (-100, 5, "user", "é\U0001f600"), (None, 1, "user", "of none"), (None, None, None, None)]
    rows += [(800, 1, "user", "x" * 100_000), (900, 0, "", ""), (901, 0, None, None)]
    return rows


@pytest.mark.parametrize("shard,queue,chunk,ids", [(256, 100_000, 4096, 4096), (2, 3, 8, 4), (7, 1, 64, 16)])
def test_trie(spark, monkeypatch, shard, queue, chunk, ids):
    monkeypatch.setattr(prefix_trie, "CHUNK", chunk)
    monkeypatch.setattr(prefix_trie, "IDS", ids)
    rows = conversations()
    random.Random(5).shuffle(rows)
    table = spark.createDataFrame([(*r, 1, "k") for r in rows], "conv_id long, turn long, role string, text string, depth int, chars string")
    found = [tuple(r) for r in prefix_trie.build(table.repartition(5), shard=shard, queue=queue).collect()]
    assert len(found) == len(set(found)) and set(found) == plain.trie(rows)


def test_trie_of_repeated_turns_and_no_rows(spark):
    table = spark.createDataFrame([(0, 1, "user", "a")] * 30 + [(1, 1, "user", "a")] * 20, "conv_id long, turn int, role string, text string")
    found = {(r.conv_id, r.depth): r for r in prefix_trie.build(table.repartition(4), shard=2).collect()}
    assert len(found) == 31 and found[0, 20].n_convs == 2 and found[0, 21].n_convs == 1 and found[0, 0].saved_tokens == 20
    assert prefix_trie.build(table.limit(0)).collect() == []
    assert prefix_trie.build(table.selectExpr("CAST(NULL AS BIGINT) AS conv_id", "turn", "role", "text")).collect() == []


def test_turns_are_numbered_over_ranges(spark):
    """One conversation with most turns lies in several ranges."""
    rows = [(1, t, t, t, 1) for t in range(2000)] + [(c, t, t, t, 1) for c in range(2, 30) for t in range(3)]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        turns = spark.createDataFrame(rows, "conv_id long, turn long, t1 long, t2 long, chars long").repartition(6)
        found = sorted((r.conv_id, r.t1, r.place) for r in prefix_trie.positions(turns).collect())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert found == sorted((c, t, t + 1) for c, t, *_ in rows)


def test_queue_spills_and_keeps_order():
    rng, queue, want = random.Random(2), prefix_trie.SpillingQueue(5), []
    for step in range(400):
        if want and rng.random() < 0.4:
            want.sort()
            assert queue.first() == want[0] and queue.pop() == want.pop(0)
        else:
            item = (rng.randrange(20), rng.randrange(3))
            want.append(item)
            queue.push(item)
    assert queue.spills > 5 and [queue.pop() for _ in want] == sorted(want) and queue.first() is None
