"""The dealt queries against DuckDB where SQL can express them, and the pipeline against plain versions of its stages."""

import __spark_entry__ as entry
import corpus_pipeline
import plain
import pytest
from attrition.llm import mixing, quality, queries
from compare import connect, difference
from pyspark.sql import functions as F
from tokenizers import Tokenizer


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query(spark, sf_dir, con, name):
    assert difference(queries.QUERIES[name](spark, sf_dir), con, queries.ORACLES[name]) is None


def test_all_are_registered():
    assert set(queries.QUERIES) <= set(entry.queries()) and "pipeline" in entry.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def rows(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def test_simhash_query(spark, sf_dir):
    docs = rows(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    found = {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in queries.op3_simhash(spark, sf_dir).collect()}
    assert found == plain.simhash(docs)


def test_token_query(spark, sf_dir):
    docs = rows(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    found = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op8_token_store(spark, sf_dir).collect()}
    assert found == plain.tokens(docs, Tokenizer.from_file(queries.TOKENIZER))


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir).cache()
        assert out.columns == columns
        seen[name] = rows(docs), rows(out)
        docs = out
    before, after = seen["quality classifier"]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    good = {r.doc_id for r in quality.classify(spark.read.parquet(f"{sf_dir}/documents.parquet"), labels).where("predicted = 1").collect()}
    assert sorted(after) == sorted(r for r in before if r[0] in good)
    before, after = seen["simhash near-dedup"]
    kept = {i for i, (_, c) in plain.simhash(before).items() if i == c}
    assert sorted(after) == sorted(r for r in before if r[0] in kept)
    before, after = seen["benchmark decontamination"]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    judged = plain.contamination(before, items)
    assert sorted(after) == sorted(r for r in before if not plain.contaminated(*judged[r[0]][:2]))
    before, after = seen["mixing to target weights"]
    assert {r[0] for r in after} <= {r[0] for r in before} and len(after) > len(before) / 2
    found = corpus_pipeline.run(spark, sf_dir).collect()
    tokenizer = Tokenizer.from_file(queries.TOKENIZER)
    assert sorted(r.doc_id for r in found) == sorted(r[0] for r in after)
    want, start = {}, 0
    for doc, text in sorted(after):
        one = plain.tokens([(doc, text)], tokenizer)[doc]
        want.setdefault(doc, []).append((start, *one[1:]))
        start += one[1]
    assert {d: sorted((r.start, r.n_tokens, r.ids_crc32) for r in found if r.doc_id == d) for d in want} == want


def test_pipeline_stages_take_odd_and_no_rows(spark, sf_dir):
    odd = spark.createDataFrame(plain.odd_documents(), plain.DOCS).repartition(2)
    for docs in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf_dir)
            assert out.count() <= 2 * docs.count()
            assert name == "token files" or out.columns == docs.columns


def test_one_row_of_each_group_stays(spark, sf_dir):
    odd = spark.createDataFrame(plain.odd_documents(), plain.DOCS)
    out = [r.doc_id for r in corpus_pipeline.one_of_each(spark, odd, sf_dir).collect()]
    assert len(out) == len(set(out)) and 28 in out and 34 not in out


def test_rows_that_share_an_id_or_have_none_are_judged_apart(spark, sf_dir):
    texts = [" ".join(f"{name}{i}" for i in range(600)) for name in ("a", "b", "c", "d", "e")]
    ids = [7, 7, None, None, None, None, 9, 7]
    some = [*texts, texts[4], texts[4] + " tail", texts[0]]
    docs = spark.createDataFrame([(i, t, "en", "src0", None, "k", 0.5) for i, t in zip(ids, some)], plain.DOCS).repartition(3)
    kept = sorted(rows(corpus_pipeline.one_of_each(spark, docs, sf_dir)), key=lambda r: r[1])
    assert kept == [(7, texts[0]), (7, texts[1]), (None, texts[2]), (None, texts[3]), (9, texts[4] + " tail")]
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").where("length(text) > 100").first().text
    apart = spark.createDataFrame([(i, t, "en", "src0", None, "k", 0.5) for i in (7, None) for t in (texts[0], item, texts[1])], plain.DOCS)
    clean = rows(corpus_pipeline.clean_of_benchmark(spark, apart, sf_dir))
    assert sorted(clean, key=str) == sorted([(i, t) for i in (7, None) for t in texts[:2]], key=str)


def test_epochs_are_those_of_the_row(spark, sf_dir):
    texts = [f"word{i} " * (5 + i % 7) for i in range(40)]
    docs = spark.createDataFrame([(None, t, "en", f"src{i % 9}", None, "k", 0.5) for i, t in enumerate(texts)], plain.DOCS)
    named = corpus_pipeline.versioned(docs).withColumn(corpus_pipeline.ROW, F.xxhash64(*docs.columns))
    keys = [*corpus_pipeline.VERSION, corpus_pipeline.ROW]
    want = {r[corpus_pipeline.VERSION[0]]: r.copies + (r.prefix_tokens > 0) for r in queries.mixed(named, keys).collect()}
    out = corpus_pipeline.versioned(corpus_pipeline.to_weights(spark, docs, sf_dir)).groupBy(corpus_pipeline.VERSION[0]).count().collect()
    assert {r[0]: r[1] for r in out} == {v: n for v, n in want.items() if n} and len(set(want.values())) > 1


def test_weights_reach_the_mix(spark):
    assert mixing.weight_of(["domain"], queries.WEIGHTS) is not None
    assert F.expr(queries.DOMAIN) is not None
