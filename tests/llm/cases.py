"""Hand-made documents with the cases that every operator must bear."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row_id long, label string"
VOCABULARY = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "re", "so", "ta") for b in ("ba", "de", "fi", "go", "hu")]


def words(text: str | None, pattern: str = r"[^\x20\x09-\x0D]+") -> list[str]:
    return re.findall(pattern, text or "")


def lower(text: str | None) -> str:
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def documents(seed: int, n: int = 60) -> list[tuple]:
    """Rows of SCHEMA: random texts, exact and near copies, shared passages, empty, null, repeated and long
    ones, and columns whose names the operators use inside."""
    draw = random.Random(seed)
    some = lambda k: [draw.choice(VOCABULARY) + draw.choice(["", "", ".", "é"]) for _ in range(k)]
    passage, common = some(70), some(55)
    texts: list[str | None] = []
    for i in range(n):
        kind, body = draw.random(), some(draw.choice([3, 8, 30, 120, 200]))
        earlier = [t for t in texts if t]
        if kind < 0.15 and earlier:
            body = draw.choice(earlier).split(" ")
        elif kind < 0.45 and earlier:
            body = draw.choice(earlier).split(" ")
            for _ in range(1 + len(body) // 40):
                body[draw.randrange(len(body))] = draw.choice(VOCABULARY) + str(i)
        elif kind < 0.6:
            at = draw.randrange(len(body))
            body[at:at] = passage
        elif kind < 0.75:
            body += common[draw.randrange(5) :]
        texts.append(" ".join(body))
    texts += [None, "", "   \n\t ", "one", "One", "ONE two", "one two", "Ab cd ef gh", " ".join(["and"] * 130)]
    texts += [" ".join(["and"] * 130), " ".join(some(3000)), " ".join(passage), "tab\tline\nfeed\x0bvertical\x0c end"]
    rows = [(2 * i + 3, t, "en", f"s{i % 3}", len(t or ""), 7, "x") for i, t in enumerate(texts)]
    draw.shuffle(rows)
    return rows + [rows[0], rows[5], (None, texts[3], None, None, None, None, None), (rows[7][0], "other text " * 9, "en", "s", 1, 1, "")]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
