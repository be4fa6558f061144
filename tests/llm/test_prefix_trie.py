"""The prefix trie against a brute-force version, and the slot table by itself."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tallyhouse.llm.prefix_trie import SlotTable, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, hi string, words long"


def brute(rows):
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts, key=lambda t: t[:2])] for c, ts in own.items()}
    ways = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 4
        ways[c] = tuple(turns.get(c - int(math.fmod(c, 20)), [])[:h] + turns[c][h:])
    members = defaultdict(list)
    for c, way in ways.items():
        for d in range(len(way) + 1):
            members[way[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    found = {}
    for node in sorted(members, key=len, reverse=True):
        below = [found[c] for c in children[node]]
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        ends = ",".join(map(str, sorted(c for c in members[node] if len(ways[c]) == len(node))))
        found[node] = (
            min(members[node]),
            len(node),
            min(members[node[:-1]]) if node else None,
            len(members[node]),
            len(below),
            sum(b[5] for b in below) if below else 1,
            (len(members[node]) - 1) * words + sum(b[6] for b in below),
            hashlib.sha256(ends.encode()).hexdigest(),
        )
    return sorted(found.values(), key=repr)


def conversations(seed, n=70, texts=("hello there", "hello", "", "what now \n then", None, "é ü")):
    draw = random.Random(seed)
    rows = []
    for c in draw.sample(range(200), n):
        same = draw.random() < 0.3
        for turn in range(draw.choice([1, 2, 3, 5, 8])):
            text = texts[0] if same else draw.choice(texts)
            rows.append((c, turn, draw.choice(["user", "user", "assistant", None]), text))
    draw.shuffle(rows)
    return rows


def _run(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    result = prefix_trie(frame, **options)
    return sorted((tuple(r) for r in result.collect()), key=repr)


SMALL = [{}, {"least_members": 3}, {"least_members": 1, "shard_nodes": 2}, {"least_members": 8, "shard_nodes": 5}]


@pytest.mark.parametrize("seed", range(len(SMALL)))
def test_brute_force(spark, seed):
    """Also with a large table above many small shards."""
    rows = conversations(seed)
    rows += [(None, 0, "user", "no conversation"), (40, None, "system", "null turn first"), (-7, 0, "user", "negative")]
    assert _run(spark, rows, **SMALL[seed]) == brute(rows)


def test_no_conversations(spark):
    assert _run(spark, []) == []
    assert _run(spark, [(None, 1, "user", "text")]) == []


def test_turnless_conversations(spark):
    """Conversations whose base is absent and whose own turns are all among their first h."""
    rows = [(c, 0, "user", "only") for c in range(101, 120)]
    found = _run(spark, rows)
    assert found == brute(rows)
    assert any(depth == 0 and ends != hashlib.sha256(b"").hexdigest() for _, depth, *_, ends in found)


def test_hot_first_turn_deep_copies_and_long_texts(spark):
    rows = [(20 * c, t, "user", "the same") for c in range(60) for t in range(3)]
    rows += [(2000 + 20 * c, t, "user", f"turn {t} " * 3) for c in range(2) for t in range(300)]
    rows += [(4000, 0, "user", "long words " * 100_000)]
    for options in ({}, {"least_members": 20, "most_top": 5}):
        assert _run(spark, rows, **options) == brute(rows)


def test_equal_turn_numbers_have_one_order(spark):
    rows = [(20, 1, "user", t) for t in ("a", "b", "b", "c")] + [(40, 1, "user", t) for t in ("c", "b", "a", "b")]
    found = _run(spark, rows)
    assert found == _run(spark, rows[::-1])
    assert [r[3] for r in found if r[1] == 4] == [2]


def test_slot_table():
    draw = np.random.default_rng(3)
    for n in (0, 1, 2, 1000):
        hi, lo = draw.integers(-(2**63), 2**63 - 1, (2, n))
        table = SlotTable(hi, lo)
        assert sorted(table.find(hi, lo)) == list(range(n))
        assert (table.find(hi, lo + 1) == -1).all()
    with pytest.raises(ValueError):
        SlotTable(np.array([1, 1]), np.array([2, 2]))
