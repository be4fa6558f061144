from __future__ import annotations

import math
import random
import zlib
from array import array

import cases
import pytest

from tallyhouse.llm.packing import WordIds, pack, plan
from tallyhouse.llm.queries import tokenizer_file

PATH = tokenizer_file("word_bpe_49k.json")


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece_once_and_fills_sequences(seed):
    draw = random.Random(seed)
    capacity = draw.choice([10, 64, 2048])
    counts = {draw.randrange(1, capacity + 1): draw.randrange(1, 400) for _ in range(draw.randrange(1, 40))}
    filled: dict[int, list] = {}
    numbers: dict[int, list] = {}
    for length, first, last, sequence, offset in plan(counts, capacity):
        numbers.setdefault(length, []).extend(range(first, last + 1))
        for k in range(last - first + 1):
            filled.setdefault(sequence + k, []).append((offset, length))
    assert {k: list(range(n)) for k, n in counts.items()} == {k: sorted(v) for k, v in numbers.items()}
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    least = math.ceil(sum(k * n for k, n in counts.items()) / capacity)
    assert len(filled) <= 11 / 9 * least + 2


def test_a_tokenizer_that_keeps_blanks_and_case():
    path = tokenizer_file("byte_bpe_50k.json")
    known = WordIds(path)
    assert not known.by_word and WordIds(PATH).by_word
    for text in ("Hello World again", "", "a  b\n", "é Étage's 10"):
        assert known.of_text(text) == array("I", known.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


def test_word_ids_equal_the_tokenizers():
    known = WordIds(PATH)
    odd = ["", "a\x1cb c", "ΣΑΣ Σας", "İstanbul don't we'll x<|endoftext|>y", "éa café.", "ab_c,, 12ab3 Ünï x y\u0085z"]
    odd += ["'''s 'tis ǅ ß!! ﬀ ½ ² ١٢", "\u200bzero \ufeffbom 你好。世界! 😀👍🏽 a\u0338b", "A!B ?? don’t"]
    odd += [r[1] or "" for r in cases.documents(8, 20)]
    for text in odd:
        ids = known.tokenizer.encode(text, add_special_tokens=False).ids
        assert known.of_text(text) == array("I", ids).tobytes()


def test_pieces_equal_the_tokenizers(spark):
    rows = cases.documents(3, 30)
    tokenizer = WordIds(PATH).tokenizer
    want = []
    for r in rows:
        ids = [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 0]
        for k, start in enumerate(range(0, len(ids), 64)):
            part = array("I", ids[start : start + 64])
            want.append((r[0], k, start, len(part), zlib.crc32(part.tobytes())))
    got = pack(cases.frame(spark, rows), PATH, capacity=64, pieces_per_part=5).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(want, key=repr)
    places: dict[int, list] = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for used in places.values():
        assert [o for o, _ in sorted(used)] == [sum(n for _, n in sorted(used)[:i]) for i in range(len(used))]
        assert sum(n for _, n in used) <= 64


def test_empty_table(spark):
    assert pack(cases.empty(spark), PATH).count() == 0
