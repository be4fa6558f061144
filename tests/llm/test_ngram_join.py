from __future__ import annotations

import random

import cases
import pytest

from tallyhouse.llm import ngram_join
from tallyhouse.llm.ngram_join import matches_at, near_duplicate_classes, overlap_needed


def shingles(text):
    words = cases.words(cases.lower(text))
    if 0 < len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    """(doc_id, n_shingles, component_id) of every row."""
    sets = [shingles(r[1]) for r in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                label[root(i)] = root(j)
    ids = {}
    for i, row in enumerate(rows):
        if row[0] is not None:
            ids[root(i)] = min(row[0], ids.get(root(i), row[0]))
    return sorted(((r[0], len(sets[i]), ids.get(root(i))) for i, r in enumerate(rows)), key=repr)


def found(spark, rows):
    result = near_duplicate_classes(cases.frame(spark, rows))
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in result.collect()), key=repr)


def test_equals_brute_force(spark):
    rows = cases.documents(1)
    assert found(spark, rows) == brute(rows)


def chain(k, width=40):
    """Texts each of which links with its neighbours only."""
    words = [f"w{i}" for i in range(width + 4 * k)]
    return [(k - i, " ".join(words[4 * i : 4 * i + width]), None, None, 0, 0, "") for i in range(k)]


def test_long_chain_is_one_component(spark):
    rows = chain(12)
    assert found(spark, rows) == brute(rows)
    assert {c for _, _, c in found(spark, rows)} == {1}


@pytest.mark.parametrize("long_list", [2, 32])
def test_star_of_copies_that_link_through_their_original_only(spark, monkeypatch, long_list):
    monkeypatch.setattr(ngram_join, "LONG_LIST", long_list)
    draw = random.Random(3)
    base = [f"b{i}" for i in range(160)]
    rows = [(500, " ".join(base), None, None, 0, 0, "")]
    for i in range(40):
        copy = list(base)
        for at in draw.sample(range(160), 4):
            copy[at] = f"x{i}"
        rows.append((i, " ".join(copy), None, None, 0, 0, ""))
    assert found(spark, rows) == brute(rows)


def test_prefix_lemma_holds_for_any_levels():
    draw = random.Random(5)
    for _ in range(300):
        universe = range(60)
        a = set(draw.sample(universe, draw.randrange(5, 40)))
        b = set(a)
        for x in draw.sample(sorted(a), draw.randrange(0, 1 + len(a) // 5)):
            b.discard(x)
        if 100 * len(a & b) < 75 * len(a | b):
            continue
        for la in range(3):
            for lb in range(3):
                ma, mb = matches_at(len(a), la, 75), matches_at(len(b), lb, 75)
                pa = set(sorted(a)[: len(a) - overlap_needed(len(a), 75) + ma])
                pb = set(sorted(b)[: len(b) - overlap_needed(len(b), 75) + mb])
                assert len(pa & pb) >= min(ma, mb)


def test_empty_table(spark):
    assert near_duplicate_classes(cases.empty(spark)).count() == 0


def test_blocks_around_a_hub_miss_no_link(spark, monkeypatch):
    """Copies with many edits each, of which few pairs link, compared in small blocks and streams."""
    monkeypatch.setattr(ngram_join, "BLOCK_TEXTS", 7)
    monkeypatch.setattr(ngram_join, "STREAM_TEXTS", 13)
    monkeypatch.setattr(ngram_join, "HUBS", 1)
    draw = random.Random(9)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(90):
        copy = list(base)
        for at in draw.sample(range(120), draw.choice([2, 3, 4, 5])):
            copy[at] = f"x{draw.randrange(40)}"
        rows.append((i, " ".join(copy), None, None, 0, 0, ""))
    assert found(spark, rows) == brute(rows)


def test_repeated_rows_do_not_count_twice(spark):
    """Texts that share half of their words, of which some rows are repeated and some have copies without id."""
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(12):
        rows.append((i, " ".join(base + [f"x{i}y{k}" for k in range(60)]), None, None, 0, 0, ""))
    rows += rows[:4] + [(None, *r[1:]) for r in rows[4:7] for _ in range(2)]
    assert found(spark, rows) == brute(rows)
    assert {c for d, _, c in found(spark, rows) if d is not None} == set(range(12))
