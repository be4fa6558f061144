"""The pipeline's stages against brute force, stage by stage on hand-made documents."""

from __future__ import annotations

import cases
import corpus_pipeline
import pytest
from pyspark.sql import functions as F

import test_decontamination
import test_ngram_join
import test_substring_dedup

PATH = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def rows():
    return cases.documents(11, 50)


def texts(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


def test_columns_stay_and_lettered_texts_pass(spark, rows):
    docs = cases.frame(spark, rows)
    kept = STAGES["language_id"](spark, docs, PATH)
    assert kept.columns == docs.columns
    assert texts(kept) == sorted(((r[0], r[1]) for r in rows if cases.lower(r[1]).strip() not in ("",)), key=repr)


def test_one_document_of_each_group_stays(spark, rows):
    rows = rows[:-1]  # the last repeats an id with another text, which no component id could tell apart
    docs = cases.frame(spark, rows)
    kept = STAGES["near_duplicates"](spark, docs, PATH)
    assert kept.columns == docs.columns
    components = test_ngram_join.brute(rows)
    empty = sum(1 for _, n, _ in components if n == 0)
    groups = {c for _, n, c in components if n}
    got = kept.collect()
    assert len(got) == len(groups) + empty
    filled = [r for r in got if test_ngram_join.shingles(r.text)]
    assert {r.doc_id for r in filled} == groups


def test_texts_lose_what_brute_force_removes(spark, rows):
    docs = cases.frame(spark, rows)
    cut = STAGES["substring_dedup"](spark, docs, PATH)
    assert cut.columns == docs.columns
    want = test_substring_dedup.brute(rows)
    left = [(d, n - gone) for d, n, gone, _ in want if not (gone and gone == n)]
    got = cut.collect()
    assert sorted(((r.doc_id, len(cases.words(r.text))) for r in got), key=repr) == sorted(left, key=repr)
    assert all(r.n_chars == len(r.text) for r in got if r.doc_id is not None and r.text and r.n_chars > 1)


def test_contaminated_documents_go(spark):
    docs = spark.read.parquet(f"{PATH}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{PATH}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    bad = {d for d, *_, contaminated in test_decontamination.brute(rows, items) if contaminated}
    assert bad
    kept = STAGES["decontamination"](spark, docs, PATH)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, _ in rows if d not in bad)


def test_whole_pipeline(spark):
    docs = spark.read.parquet(f"{PATH}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.WorkTables(spark, "test").keep(stage(spark, docs, PATH), name)
    packed = corpus_pipeline.run(spark, PATH)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.collect()}
    full = packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0]
    assert full <= 2048


def test_empty_documents(spark):
    docs = cases.empty(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, PATH)
        assert docs.columns == cases.empty(spark).columns and docs.isEmpty()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, PATH).isEmpty()
