from __future__ import annotations

import cases

from tallyhouse.llm.decontamination import BenchmarkIndex, judge_documents

PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text):
    return cases.words(cases.lower(text), PATTERN)


def brute(rows, items):
    out = []
    for r in rows:
        w, hit, ids = words(r[1]), set(), set()
        for item, text in items:
            v = words(text)
            size = min(13, len(v))
            for k in range(len(v) - size + 1) if v else ():
                for i in range(len(w) - size + 1):
                    if w[i : i + size] == v[k : k + size]:
                        hit |= set(range(i, i + size))
                        ids.add(str(item))
        out.append((r[0], len(w), len(hit), sorted(ids), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def test_equals_brute_force(spark):
    rows = cases.documents(4, 40)
    long = max((r[1] or "" for r in rows), key=len)
    items = [(10, long[:300].upper()), (9, "one"), (2, "no such words at all"), (3, None), (4, "..."), (5, long[900:1000])]
    items += [(5, long[900:1000]), (6, "and " * 20), (10, "One-two")]
    found = judge_documents(cases.frame(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    got = sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in found.collect()), key=repr)
    want = brute(rows, [(i, t) for i, t in items if t])
    assert got == want
    assert [r.n_items for r in found.collect()] == [len(r["items"]) for r in found.collect()]


def test_proximity(spark):
    phrase = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu"
    gapped = phrase.replace("eta theta", "eta oh well theta")
    rows = [(1, phrase, "", "", 0, 0, ""), (2, gapped, "", "", 0, 0, ""), (3, "alpha nu", "", "", 0, 0, "")]
    items = spark.createDataFrame([(1, phrase)], "item_id long, text string")
    index = BenchmarkIndex(cases.frame(spark, rows), items, probes=13)
    of = {r.row_id: r.doc_id for r in index.rows.collect()}
    assert {of[r.row_id] for r in index.phrase_matches().collect()} == {1}
    assert {of[r.row_id]: r.spread for r in index.proximity_matches(2).collect()} == {1: 0, 2: 2}
    assert {of[r.row_id] for r in index.proximity_matches(1).collect()} == {1}


def test_items_without_an_id(spark):
    """The words behind item 10 are, with the id before them, those of an item without one."""
    one, two = "alpha beta gamma delta epsilon", "10 " + "zeta eta theta"
    items = [(None, one), (None, two), (10, "zeta eta theta"), (3, "gamma delta")]
    rows = [(1, f"{one} so"), (2, f"x {two}"), (3, "zeta eta theta iota"), (4, "none of them")]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    index = BenchmarkIndex(documents, spark.createDataFrame(items, "item_id long, text string"))
    of = {r.row_id: r.doc_id for r in index.rows.collect()}
    near = {(of[r.row_id], r["item"]) for r in index.proximity_matches(0).collect()}
    assert near == {(1, None), (1, "3"), (2, None), (2, "10"), (3, "10")}
    found = judge_documents(documents, spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r["items"], r.contaminated) for r in found}
    assert got == {
        1: (6, 5, 2, ["3", None], True),
        2: (5, 4, 2, ["10", None], True),
        3: (4, 3, 1, ["10"], True),
        4: (3, 0, 0, [], False),
    }
    brute_hits = {d: (hit, bad) for d, _, hit, _, bad in brute(rows, items)}
    assert {d: (v[1], v[4]) for d, v in got.items()} == brute_hits


def test_empty_tables(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    assert judge_documents(cases.empty(spark), items).count() == 0
    rows = cases.documents(4, 3)
    assert not any(r.contaminated for r in judge_documents(cases.frame(spark, rows), items).collect())


def test_no_python_in_the_plan(spark, capsys):
    items = spark.createDataFrame([(1, "some words here")], "item_id long, text string")
    judge_documents(cases.frame(spark, cases.documents(4, 3)), items).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan
