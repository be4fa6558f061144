"""Spelling variants against a brute-force version over hand-made texts."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import cases
import pytest

from tallyhouse.llm.spelling_variants import alphabet_size, spelling_variants


def _one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def brute(rows, least_letters=7, least_count=2, factor=10):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = cases.lower(run)
            h = zlib.crc32(f"{doc_id}:{run}".encode()) if doc_id is not None else 1
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: k for w, k in counts.items() if len(w) >= least_letters and k >= least_count}
    near = {w: [o for o in n if _one_edit(w, o)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best and n[best] >= factor * n[w] else None
    found = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        found.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(found, key=repr)


def _run(spark, rows, **options):
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, word string, n long")
    result = spelling_variants(frame.repartition(3), **options)
    assert result.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((tuple(r) for r in result.collect()), key=repr)


@pytest.mark.parametrize("symbols", [2, 5, None])
def test_brute_force_over_few_letters(spark, symbols):
    draw = random.Random(symbols or 11)
    words = ["".join(draw.choice("abÀÿ×") for _ in range(draw.choice([2, 3, 4, 5]))) for _ in range(150)]
    rows = [(i, " ".join(draw.choices(words, k=60)) + ",Ab;AB " * 9) for i in range(40)]
    rows += [(None, "abab abab aba"), (99, None), (98, ""), rows[0], rows[0]]
    assert _run(spark, rows, least_letters=3, form_factor=2, symbols=symbols) == brute(rows, 3, 2, 2)


def test_forms_and_roots(spark):
    rows = [(2 * i, "Ordinary " * 40) for i in range(60)] + [(2 * i + 1, "ordinarz ordinarzz") for i in range(20)]
    rows += [(1000, "ordinarzzz ordinarzzz"), (1001, "standing standing standinG"), (1002, "o'ordinarz über-schön")]
    found = _run(spark, rows)
    assert found == brute(rows)
    roots = {r[0]: (r[1], r[2]) for r in found}
    assert roots["ordinarz"] == ("ordinary", "ordinary")
    assert roots["ordinarzzz"] == ("ordinarzz", "ordinary") or roots["ordinarzzz"][0] is None


def test_very_long_words_and_a_hot_word(spark):
    long = "abcdefghij" * 5000
    rows = [(i, f"{long} {long[:-1]} {long[:777]}x{long[777:]}") for i in range(3)]
    rows += [(i, "standard " * 300) for i in range(100, 130)] + [(200, "standart standart")]
    assert _run(spark, rows) == brute(rows)


def test_no_words(spark):
    assert _run(spark, []) == []
    assert _run(spark, [(1, None), (2, "short words only"), (3, "lonesome")]) == []


def test_alphabet_grows_with_the_vocabulary():
    assert [alphabet_size(n) for n in (0, 1, 100, 10**6, 10**9)] == [2, 2, 2, 8, 20]
