"""Exact duplicates against a brute-force version, and the Golomb coding by round trips."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import cases
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st

from tallyhouse.llm import exact_dedup
from tallyhouse.llm.exact_dedup import exact_duplicates, golomb_decode, golomb_encode


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    found = []
    for norm, members in groups.items():
        members.sort(key=lambda m: m[:3])
        digest = hashlib.sha256(norm.encode()).hexdigest()
        found += [(m[3], members[0][3], len(members), i == 0, digest) for i, m in enumerate(members)]
    return sorted(found, key=repr)


def _run(frame, **options):
    result = exact_duplicates(frame, **options)
    assert result.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return sorted((tuple(r) for r in result.collect()), key=repr)


@pytest.mark.parametrize("options", [{}, {"owner_rows": 8}, {"owner_rows": 16, "slack_bits": -4}])
def test_brute_force(spark, options):
    """Also with many owners, and with fingerprints so short that different texts share them."""
    rows = cases.documents(13)
    rows += [(900 + i, t, "en", "s", 1, 1, "x") for i, t in enumerate(["a b", "ab", "a b", "a\x0bb ", "é", "é", None])]
    expected = brute([r[:2] for r in rows])
    assert _run(cases.frame(spark, rows), **options) == expected


def test_a_hot_text_over_many_blocks(spark):
    rows = [(i, "the same text" + " " * (i % 7), "en", "s", 1, 1, "x") for i in range(400)]
    rows += [(1000 + i, f"own text {i}", "en", "s", 1, 1, "x") for i in range(200)]
    frame = spark.createDataFrame(rows, cases.SCHEMA).repartition(9)
    assert _run(frame, owner_rows=50) == brute([r[:2] for r in rows])


def test_blocks_that_fill_up(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BLOCK_ROWS", 10)
    rows = [(i, f"text {i % 17}", "en", "s", 1, 1, "x") for i in range(95)]
    blocks = list(exact_dedup._blocks(spark.createDataFrame(rows, cases.SCHEMA).toArrow().to_batches()))
    assert [len(b.column("doc_ids")[0]) for b in blocks] == [10] * 9 + [5]


def test_empty_table_and_very_long_text(spark):
    assert _run(cases.empty(spark)) == []
    rows = [(i, "word " * 400_000 + "." * (i // 2), "en", "s", 1, 1, "x") for i in range(4)]
    assert _run(spark.createDataFrame(rows, cases.SCHEMA)) == brute([r[:2] for r in rows])


def test_texts_with_one_digest_are_compared_by_bytes(monkeypatch):
    class Same:
        def digest(self):
            return bytes(32)

    class Wanted:
        value = np.full(1 << 23, 255, dtype=np.uint8)

    monkeypatch.setattr(exact_dedup.hashlib, "sha256", lambda text: Same())
    texts = pa.RecordBatch.from_pydict({"text": ["one", "o n e", "two", None, "one"]})
    (found,) = exact_dedup._collapsed(Wanted)(iter([texts]))
    assert found.column("norm").to_pylist() == [b"one", b"two", b""]


@given(st.sets(st.integers(0, 2**40 - 1), min_size=1, max_size=300), st.integers(0, 30))
def test_golomb_round_trip(numbers, shift):
    values = np.unique(np.array(sorted(numbers), dtype=np.uint64) >> np.uint64(shift))
    width, quotients, remainders = golomb_encode(values, 1 << (40 - shift))
    assert (golomb_decode(len(values), width, quotients, remainders) == values).all()


def test_golomb_lists_are_short():
    draw = np.random.default_rng(1)
    values = np.unique(draw.integers(0, 1 << 40, 50_000).astype(np.uint64))
    _, quotients, remainders = golomb_encode(values, 1 << 40)
    # log2(2**40 / 50,000) is 24.4 bits; the code takes less than two more
    assert 8 * (len(quotients) + len(remainders)) / len(values) < 26.4
