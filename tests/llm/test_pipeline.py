"""The corpus pipeline and the registered queries."""

import __spark_entry__ as entry
import brute
import cases
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from homeward.llm import queries

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def documents(spark, rows):
    df = cases.table(spark, rows)
    return df.select("doc_id", "text", "lang", F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"))


@pytest.mark.parametrize("rows", [None, []])
def test_each_stage_on_awkward_documents(spark, sf_dir, rows):
    docs = documents(spark, cases.documents() if rows is None else rows)
    wide = docs.withColumns({c: F.lit("x") for c in cases.CLASHING})
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.schema == docs.schema or out.columns == docs.columns
        assert out.count() <= docs.count()
        if i in (0, 1, 2):
            assert stage(spark, wide, sf_dir).columns == wide.columns


def test_run(spark, sf_dir):
    """Stages in order on whole documents: what each drops is what it must."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    (_, lang), (_, dedup), (_, decon), (_, pii), _ = corpus_pipeline.STAGES
    a = {r.doc_id for r in lang(spark, docs, sf_dir).collect()}
    assert a == set(texts)  # all of them are in a language
    sets = {i: brute.shingles(t) for i, t in texts.items()}
    gone = {i for i in texts if any(j < i and sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) for j in texts)}
    b = {r.doc_id for r in dedup(spark, docs, sf_dir).collect()}
    assert b == set(texts) - gone
    benchmark = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    kept = {r.doc_id for r in decon(spark, docs, sf_dir).collect()}
    assert kept == {i for i, t in texts.items() if not any(x in t for x in benchmark)}
    red = {r.doc_id: r for r in pii(spark, docs, sf_dir).collect()}
    assert all(not brute.base_spans(r.text) and r.n_chars == len(r.text) for r in red.values())
    assert all(red[i].text == t for i, t in texts.items() if not brute.base_spans(t))
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert {r.doc_id for r in out.collect()} == b & kept


def test_registered(spark):
    names = set(entry.queries())
    assert {"pipeline", *queries.QUERIES} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)
