"""Language ID, quality, mixing, token store, vectors and urls: literal cases, plain versions, held-out accuracy."""

import zlib

import numpy as np
import plain
import public_tokenizers
import pytest
from attrition.llm import language_id, mixing, quality, token_store, url_filter, vector_dedup
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, models, normalizers, pre_tokenizers

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(plain.odd_documents(), plain.DOCS).repartition(3)


def test_language_of_held_out_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("lang IS NOT NULL").collect()
    unseen = [r for r in found if r.held_out]
    assert sum(r.lang == r.lang_pred for r in unseen) >= 0.97 * len(unseen)
    assert all(0 <= r.score <= 1 for r in found)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)


def test_language_without_letters_or_learning(spark, odd):
    found = {(r.doc_id, r.lang_pred, r.score) for r in language_id.identify(odd).collect()}
    assert {(1, "und", 0.0), (4, "und", 0.0), (7, "und", 0.0), (46, "und", 0.0)} <= found
    assert {r.lang_pred for r in language_id.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language_id.identify(odd.limit(0)).count() == 0


def test_too_many_languages_are_refused_before_anything_is_gathered(spark, monkeypatch):
    """Documents 2 to 9 are learned from but for those held out; two languages are one too many."""
    monkeypatch.setattr(language_id, "MAX_LANGUAGES", 1)
    monkeypatch.setattr(language_id, "_count", None)
    docs = spark.createDataFrame([(i, f"text {i}", "ab"[i % 2]) for i in range(2, 10)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="2 languages"):
        language_id.train(docs)


def test_language_scores_do_not_depend_on_pieces(monkeypatch):
    logs = np.log(np.random.default_rng(1).dirichlet(np.ones(1 << language_id.BITS), 3)).astype(np.float32)
    texts = ["ab cd " * 300, "x", "Zürich"]
    whole = language_id.score_texts(texts, np.zeros(3), logs)
    monkeypatch.setattr(language_id, "CELLS", 1)
    monkeypatch.setattr(language_id, "PIECE", 100)
    assert np.allclose(whole[1:], language_id.score_texts(texts, np.zeros(3), logs)[1:])


def test_quality_of_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels"))
    found = quality.classify(docs, labels).join(labels, "doc_id").where("held_out").collect()
    good = [r for r in found if r.quality == 1]
    bad = [r for r in found if r.quality == 0]
    assert sum(r.predicted for r in good) >= 0.97 * len(good)
    assert sum(1 - r.predicted for r in bad) >= 0.7 * len(bad)


def test_quality_never_sees_held_out_labels(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    rows = [sorted((r.doc_id, round(r.score, 9)) for r in quality.classify(docs, x).collect()) for x in (labels, turned)]
    assert rows[0] == rows[1]


def test_quality_of_odd_rows(spark, odd, sf_dir):
    labels = spark.createDataFrame([(28, 1), (31, 0), (28, 1), (34, None), (None, 0), (40, 0), (43, 1), (13, 1), (16, 0)], "doc_id long, quality int")
    found = quality.classify(odd, labels).collect()
    assert len(found) == len(plain.odd_documents()) and all(0 <= r.score <= 1 for r in found)
    assert {r.score for r in quality.classify(odd, labels.limit(0)).collect()} == {0.5}
    assert quality.classify(odd.limit(0), labels).count() == 0
    assert set(quality.score(odd, None).columns) == set(odd.columns)


def test_mix_gives_every_leaf_its_budget(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 7)), ["en", "de", None][i % 3], f"src{i % 5}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    domain = F.expr("CASE WHEN source = 'src0' THEN 'a' ELSE 'b' END")
    found = mixing.mix(docs, {("a",): 3, ("b", "en"): 2, ("b", "de"): 0}, domain, epochs=2).collect()
    leaves: dict = {}
    for r in found:
        have, given_out = leaves.get((r.domain, r.lang, r.source), (0, 0))
        leaves[r.domain, r.lang, r.source] = have + r.tokens, given_out + r.copies * r.tokens + r.prefix_tokens
    total = sum(have for have, _ in leaves.values())
    assert all(g <= 2 * have for have, g in leaves.values())
    assert total - len(leaves) * 3 <= sum(g for _, g in leaves.values()) <= total
    # Domain a asks for three quarters and can have two passes; what it cannot use goes to b.
    assert all(g == 2 * have for (d, _, _), (have, g) in leaves.items() if d == "a")
    assert all(g == 0 for (d, lang, _), (_, g) in leaves.items() if (d, lang) == ("b", "de"))
    partial = [r for r in found if 0 < r.prefix_tokens < r.tokens]
    assert len(partial) <= len(leaves)


def test_shortage_goes_to_siblings_before_ancestors(spark):
    rows = [(1, "a", "en", "x", 10), (2, "a", "en", "y", 100), (3, "b", "en", "z", 100)]
    leaves = spark.createDataFrame([r[1:] for r in rows], "domain string, lang string, source string, tokens long")
    found = mixing.budgets(leaves, ["domain", "lang", "source"], {}, F.lit(100).cast("long"), 1)
    assert {r.source: r.granted for r in found.collect()} == {"x": 10, "y": 40, "z": 50}
    short = mixing.budgets(leaves, ["domain", "lang", "source"], {("a",): 9}, F.lit(200).cast("long"), 1)
    assert {r.source: r.granted for r in short.collect()} == {"x": 10, "y": 100, "z": 90}


@pytest.mark.parametrize("nothing", [("a",), ("a", "x"), ("a", "x", "s")])
def test_a_branch_of_weight_0_leaves_its_share_to_others(spark, nothing):
    levels = ["domain", "lang", "source"]
    leaves = spark.createDataFrame([("a", "x", "s", 80), ("a", "y", "s", 20), ("b", "x", "s", 100)], "domain string, lang string, source string, tokens long")
    found = {tuple(r)[:3]: r.granted for r in mixing.budgets(leaves, levels, {nothing: 0}, F.lit(100).cast("long"), 1).collect()}
    left = 0 if nothing == ("a",) else 20
    assert found == {("a", "x", "s"): 0, ("a", "y", "s"): left, ("b", "x", "s"): 100 - left}


def test_mix_order_does_not_depend_on_buckets(spark, monkeypatch):
    rows = [(i, " ".join(["w"] * (1 + i % 7)), "en", "s") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    want = sorted(mixing.mix(docs, {}, F.lit("d"), share=0.4).collect())
    monkeypatch.setattr(mixing, "BUCKET_DOCS", 10)
    assert sorted(mixing.mix(docs, {}, F.lit("d"), share=0.4).collect()) == want


def test_mix_of_odd_rows(spark, odd):
    found = mixing.mix(odd, {}, F.lit(None).cast("string")).collect()
    assert len(found) == len(plain.odd_documents()) and {r.domain for r in found} == {"unknown"}
    assert mixing.mix(odd.limit(0), {}, F.col("source")).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=200), st.sampled_from([8, 1]), st.integers(1, 64))
def test_segment_round_trip(ids, plane, block):
    data = token_store.write_segment(np.array(ids, "<u4"), plane, block)
    assert token_store.read_segment(data).tolist() == ids


def test_memo_gives_what_the_tokenizer_gives():
    encoder = token_store.Encoder(TOKENIZER)
    assert encoder.by_word
    texts = [
        "<|endoftext|> a <|ENDOFTEXT|>", "Σας ΟΔΟΣ. İstanbul, a|b | c", "it's DON'T... 3.14, x.y., é. ...", "\x0b\x0cA\x85b\xa0c\x1cd\u3000e",
        "", "  ", "word.,", "ß., ŉ. 中文, 中文.", "ªº ʰ ǅ ﬁ", "e\u0301 \u0301e a\u0301.", "\U0001f600\U0001f600 ☃. '’s",
    ]
    plain_tokenizer = Tokenizer.from_file(TOKENIZER)
    for _ in range(2):
        found = encoder.encode([t.encode() for t in texts], b"")
        assert [np.frombuffer(f, "<u4").tolist() for f in found] == [plain_tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_memo_is_bounded_and_stays_right(monkeypatch):
    monkeypatch.setattr(token_store, "MEMO_WORDS", 50)
    encoder = token_store.Encoder(TOKENIZER)
    plain_tokenizer = Tokenizer.from_file(TOKENIZER)
    for i in range(12):
        texts = [f"word{i}a common, text{j * i} x{i}. common." for j in range(20)]
        found = encoder.encode([t.encode() for t in texts], b"")
        assert [np.frombuffer(f, "<u4").tolist() for f in found] == [plain_tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(encoder.number) < 50 + 20 * 4


def test_a_tokenizer_that_keeps_blanks_is_used_whole():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder = token_store.Encoder(path)
    assert not encoder.by_word
    assert np.frombuffer(encoder.encode(["a  b\nc".encode()], b"")[0], "<u4").tolist() == Tokenizer.from_file(path).encode("a  b\nc").ids


@pytest.mark.parametrize("pattern", [r"\S+", r"[a-z]{1,3}\.?|[^\sa-z]", r"[a-z]+(?=\.)|[a-z]|[^\sa-z]+", r"[a-z]+|[.,]+|[^\sa-z.,]"])
def test_stops_are_cut_off_only_where_the_tokenizer_does(tmp_path, pattern):
    words = ["hello", "hello.", "hello.,", "h", "hel", "lo", "lo.", "lo.,", "a", "a.", ".", ",", ".,", "|", "[UNK]"]
    tokenizer = Tokenizer(models.WordLevel({w: i for i, w in enumerate(words)}, unk_token="[UNK]"))
    tokenizer.normalizer = normalizers.Lowercase()
    tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
    path = str(tmp_path / "words.json")
    tokenizer.save(path)
    encoder = token_store.Encoder(path)
    assert encoder.by_word
    texts = ["Hello. hello hello., a. other. lo. a., . ., hello,"] * 2
    found = [np.frombuffer(f, "<u4").tolist() for f in encoder.encode([t.encode() for t in texts], b"")]
    assert found == [tokenizer.encode(t).ids for t in texts]


@pytest.mark.parametrize("plane", [8, 1])
def test_token_files(spark, odd, plane):
    docs = odd.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    target = token_store.new_target(spark)
    token_store.write_tokens(docs, target, TOKENIZER, plane=plane)
    rows = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_store.read_tokens(spark, target).collect()}
    texts = {r[0]: r[1] for r in plain.odd_documents() if r[0] is not None}
    assert rows == plain.tokens(list(texts.items()), Tokenizer.from_file(TOKENIZER))


def test_token_files_of_repeated_and_no_rows(spark, odd):
    for docs, n in ((odd, len(plain.odd_documents())), (odd.limit(0), 0)):
        target = token_store.new_target(spark)
        token_store.write_tokens(docs, target, TOKENIZER)
        rows = sorted(token_store.read_tokens(spark, target).collect(), key=lambda r: r.start)
        assert len(rows) == n
        assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:]))
        assert [r.doc_id or 0 for r in rows] == sorted(r.doc_id or 0 for r in rows)


def vectors(seed: int) -> list[tuple]:
    rng = np.random.default_rng(seed)
    rows = []
    for label in (0, 1):
        centres = rng.standard_normal((12, 8))
        for i in range(150):
            v = centres[i % 12] + rng.standard_normal(8) * rng.choice([0.02, 0.25])
            rows.append((len(rows), [float(x) for x in v.astype(np.float32)], label))
    rows += [(1000, rows[3][1], 0), (1001, [2 * x for x in rows[3][1]], 0), (1002, rows[3][1], None), (1003, None, 0), (1004, [0.0] * 8, 0)]
    rows += [(1005, [float("nan")] + [1.0] * 7, 0), (1006, [None] + [1.0] * 7, 0), (1007, [1.0, 2.0], 0), (1008, [1.0, 2.0], 0), (1009, [], 1)]
    return rows + [(1010, [float("inf")] + [1.0] * 7, 0)]


def plain_vectors(rows: list[tuple], cosine: float) -> dict:
    good = [(i, np.array(v, np.float64), label) for i, v, label in rows if v and label is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    linked = []
    for x, (i, v, a) in enumerate(good):
        for j, w, b in good[x + 1 :]:
            if a == b and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= cosine:
                linked.append((i, j))
    count = {i: 0 for i, _, _ in rows}
    for i, j in linked:
        count[i] += 1
        count[j] += 1
    found = plain.classes(sorted(count), linked)
    return {i: (count[i], found[i], found[i] == i) for i in count}


@pytest.mark.parametrize(("cell", "block"), [(2000, 4000), (20, 7)])
def test_vectors(spark, monkeypatch, cell, block):
    rows = vectors(5)
    monkeypatch.setattr(vector_dedup, "COPIES", 9.0)
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, vector string, n int").repartition(3)
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vector_dedup.near_duplicates(table, cell=cell, block=block).collect()}
    assert found == plain_vectors(rows, 0.93)


def test_partners_share_a_home_cell():
    rng = np.random.default_rng(3)
    x = vector_dedup.unit(np.repeat(rng.standard_normal((20, 6)), 15, axis=0) + 0.15 * rng.standard_normal((300, 6)))
    radius = float(np.sqrt(2 - 2 * 0.93))
    distance = vector_dedup.apart(x, x[::29])
    home, sent = distance.argmin(axis=1), vector_dedup.needed(distance, radius)
    a, b = np.nonzero(x @ x.T >= 0.93)
    assert sent[b, home[a]].all() and not sent.all()


def test_vectors_without_ids_and_no_vectors(spark):
    rows = [(None, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (5, [1.0, 0.0], 1), (5, [1.0, 0.0], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = sorted(vector_dedup.near_duplicates(table).collect(), key=lambda r: r.vec_id or 0)
    assert [(r.vec_id, r.n_links, r.component_id) for r in found] == [(None, 0, None), (None, 0, None), (5, 1, 5), (5, 1, 5)]
    assert vector_dedup.near_duplicates(table.limit(0)).count() == 0


URLS = [
    (1, "https://WWW.Example.com/en/5?x=/es/", "www.example.com", "/en/5", "www.example.com/en/", "allow"),
    (2, "http://a.example.com/en/5#t", "a.example.com", "/en/5", "example.com/en/", "block"),
    (3, "http://example.com/de/5", "example.com", "/de/5", "com/", "allow"),
    (4, "http://x.net/es/1.html", "x.net", "/es/1.html", "net/es/", "block"),
    (5, "http://x.net/es", "x.net", "/es", None, "allow"),
    (6, "http://com", "com", "", None, "allow"),
    (7, "http://notcom/", "notcom", "/", None, "allow"),
    (8, None, "", "", None, "allow"),
    (9, "no scheme/x", "", "", None, "allow"),
    (10, "a://b://c/d", "b:", "//c/d", None, "allow"),
    (11, "s://é.COM/É/\n", "é.com", "/É/\n", "com/", "allow"),
    (12, "http://y.org" + "/a" * 3000, "y.org", "/a" * 3000, None, "allow"),
]


def test_urls(spark):
    table = spark.createDataFrame([(*u[:2], "<p>", "z") for u in URLS], "page_id long, url string, html string, host string")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(table).collect()}
    assert found == {u[0]: u[2:] for u in URLS}
    assert url_filter.judge(table.limit(0)).count() == 0


def test_templates_learn_from_labelled_siblings(spark):
    """Rules name half of the pages of a template; the other pages of a mostly blocked one go too."""
    rules = [("h", f"/bad/{i}0", "block") for i in range(1, 9)] + [("h", f"/good/{i}0", "allow") for i in range(1, 9)]
    paths = [f"/{kind}/{i}{j}" for kind in ("bad", "good") for i in range(1, 9) for j in (0, 5)]
    table = spark.createDataFrame([(i, f"http://h{p}") for i, p in enumerate(paths)], "page_id long, url string")
    found = {r.path: (r.rule, r.verdict, r.template) for r in url_filter.judge(table, rules).collect()}
    assert found["/bad/15"] == (None, "block", "bad/*") and found["/good/15"] == (None, "allow", "good/*")
    many = spark.createDataFrame([(i, f"http://h/u/name{chr(97 + i % 26)}{chr(97 + i // 26)}") for i in range(100)], "page_id long, url string")
    assert {r.template for r in url_filter.judge(many).collect()} == {"u/*"}


def test_shares_flow_from_grandparents_and_the_host(spark):
    """Nothing below /bad/y is labelled, nor on the host `new`: each takes what is known above it."""
    rules = [("h", f"/bad/x{i}/", "block") for i in range(8)] + [("h", f"/good/x{i}/", "allow") for i in range(9)]
    urls = [f"http://h/{kind}/x{i}/p" for kind in ("bad", "good") for i in range(8)]
    urls += ["http://h/good/x8/p", "http://h/bad/y/z/p", "http://h/good/y/z/p", "http://h/other", "http://new/bad/y"]
    table = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = {(r.host, r.path): (r.verdict, r.purity) for r in url_filter.judge(table, rules).collect()}
    above_bad, above_good = 4 * 0.2 / (9 + 4), (8 + 4 * 0.2) / (8 + 4)  # the host without the branch itself
    assert found["h", "/bad/y/z/p"] == ("block", pytest.approx((8 + 4 * above_bad) / (8 + 4)))
    assert found["h", "/good/y/z/p"] == ("allow", pytest.approx(4 * above_good / (9 + 4)))
    assert found["h", "/other"] == ("allow", pytest.approx((8 + 4 * 0.2) / (17 + 4)))
    assert found["new", "/bad/y"] == ("allow", 0.2)


def test_similar_inner_branches_are_pooled(spark):
    """Branches a and b differ little and share their counts; c differs and stays alone."""
    says = {"a": "bbbbaaaa", "b": "bbbaaaaa", "c": "aaaaaaaaaaaaaaaaaaaaaaaa"}
    rules = [("h", f"/{k}/x{i}/", "block" if v == "b" else "allow") for k, marks in says.items() for i, v in enumerate(marks)]
    urls = [f"http://h{path}p" for _, path, _ in rules] + [f"http://h/{k}/y" for k in says]
    table = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = {r.path: r.purity for r in url_filter.judge(table, rules, max_children=3).collect() if r.path.endswith("y")}
    share = {k: v.count("b") / len(v) for k, v in says.items()}
    n, b = 40, 7
    alike = {k for k, v in says.items() if (share[k] - b / n) ** 2 * len(v) <= 3.84 * b / n * (1 - b / n)}
    assert alike == {"b"}  # a is above the mean by more than chance, c below it
    assert found["/a/y"] > found["/b/y"] > found["/c/y"]
    even = [("h", f"/{k}/x{i}/", "block" if i < n else "allow") for k, n in (("a", 4), ("b", 3)) for i in range(8)]
    table = spark.createDataFrame(list(enumerate(f"http://h{path}p" for _, path, _ in even)) + [(99, "http://h/b/y/q")], "page_id long, url string")
    found = {r.path: r.purity for r in url_filter.judge(table, even).collect()}
    assert found["/b/y/q"] == pytest.approx((7 + 4 * 0.2) / (16 + 4))


def test_variable_segments_below_variable_ones(spark):
    """Thousands of users with a few posts each are one template, as levels are generalised from the host down."""
    urls = [f"http://h/user{'abcdefghij'[i % 10]}{'abcdefghij'[i // 10]}/post{j}{'abcdefghij'[i % 10]}{'abcdefghij'[i // 10]}" for i in range(100) for j in "xy"]
    table = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    assert {r.template for r in url_filter.judge(table).collect()} == {"*/*"}
