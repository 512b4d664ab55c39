"""Small corpora for the tests: ordinary ones with copies, and one of edge cases with clashing column names."""

from __future__ import annotations

import random

WORDS = "the of and a to in is was that for on with as are this by from at or an river stone cloud apple".split()
CLASHES = ("row", "key", "maybe", "tag", "a", "b", "n", "h", "sha", "kept", "score", "label", "node", "t", "rest", "ids")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(("", "", "", str(rng.randrange(900)))) for _ in range(n))


def edited(rng: random.Random, text: str, changes: int) -> str:
    words = text.split(" ")
    for _ in range(changes):
        at = rng.randrange(len(words))
        words[at] = rng.choice(("new", "odd", "word")) + str(rng.randrange(99))
    return " ".join(words)


def corpus(seed: int = 5, size: int = 120) -> list[tuple]:
    """Rows with exact copies, case copies, chains of near copies and short texts."""
    rng = random.Random(seed)
    texts = [sentence(rng, rng.choice((3, 5, 8, 40, 90, 200))) for _ in range(size)]
    for _ in range(size):
        base = rng.choice(texts)
        texts.append(rng.choice((base, base.upper(), edited(rng, base, 1), edited(rng, base, 2), edited(rng, base, 6),
                                 base + " " + sentence(rng, 6), "É" + base)))
    rng.shuffle(texts)
    return [(i, text, "en", "s", len(text)) for i, text in enumerate(texts)]


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def edge_rows() -> list[tuple]:
    rng = random.Random(1)
    long = sentence(rng, 60_000)
    texts = [None, "", " \t\n", "one", "ONE", "one two three four", "one two three four five", "é É ß 漢字 😀", "x" * 3000,
             long, long, long.upper(), "a b c d e f g h", "same same same same same same same same"]
    rows = [(i, text, None, None, None) for i, text in enumerate(texts)]
    rows += [(None, "no id", "en", "s", 1), (None, "no id", "en", "s", 1), (None, None, None, None, None)]
    return rows + [rows[3], rows[3], rows[7], (1, "another text with the id of an empty one", None, None, None)]


def edge_table(spark, rows=None):
    """The edge cases with extra columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    df = table(spark, edge_rows() if rows is None else rows)
    return df.withColumns({name: F.lit(f"extra {name}") for name in CLASHES})
