from __future__ import annotations

import time
from collections import Counter

import cases
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm.language_id import declared_language, host_levels, identify
from tallyhouse.llm.queries import op6_language_id, table

PATH = "/root/testdata/sf0.01"


def test_languages_of_documents(spark):
    """Text alone, without what is declared: labels are those of the test tables."""
    docs = table(spark, PATH, "documents")
    rows = docs.select(
        F.col("doc_id").alias("row_id"), "text", F.col("source").alias("host"), F.lit(None).cast("string").alias("declared")
    )
    found = identify(rows, docs, markup=False).select(F.col("row_id").alias("doc_id"), "language", "probability")
    joined = found.join(docs, "doc_id")
    right = joined.agg(F.avg((F.col("language") == F.col("lang")).cast("double"))).first()[0]
    assert right > 0.97
    assert joined.where("probability < 0.25 OR probability > 1.0001").count() == 0


def test_pages(spark):
    found = op6_language_id(spark, PATH).toPandas()
    assert len(found) == table(spark, PATH, "pages").count()
    assert found["language"].isin(["de", "en", "es", "fr"]).all()
    assert (found["language"] == found["declared"]).mean() > 0.8


def test_evidence_is_combined(spark):
    docs = table(spark, PATH, "documents")
    text = docs.where("lang = 'fr' AND n_chars > 500").orderBy("doc_id").first().text
    rows = [(i, text, "a.fr", None) for i in range(60)]
    rows += [(100, None, "a.fr", None), (101, "...", "x.unknown", "de"), (102, "", None, "xx"), (103, text, "b.a.fr:80", "de")]
    rows += [rows[0]]
    frame = spark.createDataFrame(rows, "row_id long, text string, host string, declared string")
    found = {r.row_id: r for r in identify(frame, docs, markup=False).collect()}
    assert found[0].language == found[103].language == "fr"
    # No text: the host's prior decides, and a declaration against no prior of its own
    assert found[100].language == "fr" and found[100].n_pairs == 0 and found[100].text_language is None
    assert found[100].probability > 0.9
    assert found[101].n_pairs == 0 and found[102].n_pairs == 0
    assert sum(found[101].posterior) == pytest.approx(1)


def test_no_labels_and_empty_tables(spark):
    rows = spark.createDataFrame([(1, "abc", "h", None)], "row_id long, text string, host string, declared string")
    none = cases.empty(spark)
    assert identify(rows, none, markup=False).first().language == "und"
    assert identify(rows.limit(0), none, markup=False).count() == 0


def test_host_levels(spark):
    hosts = spark.createDataFrame([("a.b.co:80",), ("co",), ("",), ("www.a.co.uk",), ("co.uk",)], "host string")
    domain, suffix = host_levels(F.col("host"))
    assert [tuple(r) for r in hosts.select(domain, suffix).collect()] == [
        ("b.co", "co"), ("co", "co"), ("", ""), ("a.co.uk", "uk"), ("co.uk", "uk"),
    ]


def _pairs(text):
    kept = [b | 0x20 if chr(b).isascii() and chr(b).isalpha() else b if b >= 0x80 else 0x20 for b in (text or "").encode()]
    return [pair for pair in zip(kept, kept[1:]) if pair != (0x20, 0x20)]


def _shares(weights):
    return np.array(weights) / np.sum(weights)


def brute(rows, labelled, smoothing=20.0):
    """Posterior of every row by the formula, level by level and row by row."""
    languages = sorted({lang for lang, text in labelled if lang and text is not None})
    counts = {lang: Counter(p for of, t in labelled if of == lang for p in _pairs(t)) for lang in languages}
    logs = [0.2 * np.array([sum(np.log((counts[lang][p] + 0.5) / (counts[lang].total() + 32768)) for p in _pairs(r[1])) for lang in languages]) for r in rows]
    by_text = [_shares(np.exp(x - x.max())) * (len(_pairs(r[1])) > 0) for x, r in zip(logs, rows)]

    def places(host):
        labels = (host or "").lower().split(":")[0].split(".")
        return [(), labels[-1:], labels[-2:], (host or "").lower()]

    posteriors = []
    declared = {d: 0.5 + sum(b for b, r in zip(by_text, rows) if r[3] == d) for d in languages}
    for i, (row, log) in enumerate(zip(rows, logs)):
        prior = np.full(len(languages), 1 / len(languages))
        for level, place in enumerate(places(row[2])):
            others = sum((by_text[j] for j, r in enumerate(rows) if j != i and places(r[2])[level] == place), np.zeros(len(languages)))
            prior = (others + smoothing * prior) / (others.sum() + smoothing)
        said = np.ones(len(languages))
        if row[3] in languages:
            said = declared[row[3]] / sum(declared[d] for d in languages)
        posteriors.append(_shares(np.exp(log - log.max()) * said * prior))
    return posteriors


def test_formula_by_brute_force(spark):
    """Languages beyond those of the test tables, few texts on a host, and every level of the prior."""
    labelled = [("it", "che bella giornata oggi"), ("nl", "wat een mooie dag vandaag"), ("it", "la casa bianca"), ("pl", "jaki piękny dzień")]
    labelled += [(None, "nobody knows"), ("", "nor this"), ("de", None)]
    rows = [(1, "bella casa", "a.x.it", "it"), (2, "mooie dag", "b.x.it", None), (3, "", "a.x.it", "nl"), (4, None, None, "zz")]
    rows += [(5, "piękny dom", "A.x.it", "pl"), (6, "una bella casa bianca", "c.y.it", "it"), (7, "de dag", "d.nl", "nl"), (8, "!", "e.nl", None)]
    texts = spark.createDataFrame(labelled, "lang string, text string")
    frame = spark.createDataFrame(rows, "row_id long, text string, host string, declared string").repartition(2)
    found = {r.row_id: r for r in identify(frame, texts, markup=False).collect()}
    for row, want in zip(rows, brute(rows, labelled)):
        assert found[row[0]].posterior == pytest.approx(want, abs=1e-4)
        assert found[row[0]].language == ["it", "nl", "pl"][int(np.argmax(want))]


def test_markup_that_never_ends():
    assert declared_language("<html x='1' lang=\"FR-ca\">") == "fr" and declared_language("<html>") is None
    began = time.monotonic()
    assert declared_language("<html " * 1_700_000) is None
    assert time.monotonic() - began < 1


def test_ties_go_to_the_language_that_sorts_first(spark):
    texts = spark.createDataFrame([("zz", "abc"), ("aa", "abc")], "lang string, text string")
    rows = spark.createDataFrame([(1, None, "h", None), (2, "abc", "g", None)], "row_id long, text string, host string, declared string")
    found = {r.row_id: r for r in identify(rows, texts, markup=False).collect()}
    assert [found[i].language for i in (1, 2)] == ["aa", "aa"]
    assert found[2].posterior == pytest.approx([0.5, 0.5])


def test_long_texts_and_repeated_rows(spark):
    texts = spark.createDataFrame([("en", "the cat and the dog " * 5), ("fr", "le chat et le chien " * 5)], "lang string, text string")
    rows = [(1, "le chien " * 300_000, "h", None)] * 3 + [(2, "the dog", "h", None)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "row_id long, text string, host string, declared string, known string")
    found = identify(frame, texts, markup=False).collect()
    assert sorted((r.row_id, r.language) for r in found) == [(1, "fr")] * 3 + [(2, "en")]
