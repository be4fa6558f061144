from __future__ import annotations

import hashlib

import cases
import pytest

from tallyhouse.llm import substring_dedup
from tallyhouse.llm.substring_dedup import remove_repeats


def brute(rows, width=50):
    first = {}
    for r in rows:
        w = cases.words(r[1])
        for i in range(len(w) - width + 1):
            if r[0] is not None:
                key = tuple(w[i : i + width])
                first[key] = min(first.get(key, r[0]), r[0])
    out = []
    for r in rows:
        w = cases.words(r[1])
        gone = set()
        for i in range(len(w) - width + 1):
            if r[0] is not None and first[tuple(w[i : i + width])] < r[0]:
                gone |= set(range(i, i + width))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((r[0], len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=repr)


@pytest.mark.parametrize("flush", [50, 400_000])
def test_equals_brute_force(spark, monkeypatch, flush):
    monkeypatch.setattr(substring_dedup, "FLUSH_RUNS", flush)
    rows = cases.documents(2)
    assert found(remove_repeats(cases.frame(spark, rows))) == brute(rows)


def test_texts_are_cut_and_else_left_as_they_are(spark):
    passage = "\n".join(f"p{i}" for i in range(60))
    rows = [(1, passage, "", "", 0, 0, ""), (2, f" start,  here {passage}\t\tthe end ", "", "", 0, 0, "")]
    cut = {r.doc_id: r for r in remove_repeats(cases.frame(spark, rows), with_text=True).collect()}
    assert cut[1].kept_text is None and cut[1].removed == []
    assert cut[2].kept_text == " start,  here the end "
    assert [tuple(r) for r in cut[2].removed] == [(2, 62)]


def test_empty_table(spark):
    assert remove_repeats(cases.empty(spark)).count() == 0


def test_more_words_than_places_are_an_error(monkeypatch):
    import pyarrow as pa

    from tallyhouse.llm.text_arrays import U, words_of

    monkeypatch.setattr(substring_dedup, "PLACE_BITS", U(7))
    (words,) = words_of(iter([pa.RecordBatch.from_pydict({"text": ["w " * 200]})]))
    with pytest.raises(ValueError, match="more than 2"):
        substring_dedup.window_runs(words, 50, 8)


def test_a_hot_anchor_in_ever_different_runs(spark, monkeypatch):
    """One phrase of 8 words in many documents, whose surroundings differ, and repeated rows."""
    monkeypatch.setattr(substring_dedup, "FLUSH_RUNS", 100)
    phrase = " ".join(f"p{i}" for i in range(8))
    rows = []
    for i in range(120):
        around = [f"w{i}_{k}" for k in range(60)]
        rows.append((i, " ".join([*around[:30], phrase, *around[30:]]), "", "", 0, 0, ""))
    shared = " ".join(f"s{k}" for k in range(45))
    rows += [(200 + i, f"x{i % 3} {shared} {phrase} y{i % 5}", "", "", 0, 0, "") for i in range(40)]
    rows += [rows[3]] * 20
    assert found(remove_repeats(cases.frame(spark, rows))) == brute(rows)
