"""Small tables with the awkward rows that every operator must take."""

import random

from pyspark.sql import functions as F

SYLLABLES = ("an", "the", "or", "éa", "ion", "st", "ß", "re", "wh", "ou")


def prose(seed: int, words: int) -> str:
    chance = random.Random(seed)
    made = ["".join(chance.choices(SYLLABLES, k=chance.randint(1, 3))) for _ in range(words)]
    return " ".join(w.capitalize() if chance.random() < 0.2 else w for w in made)


def near_copy(text: str, seed: int, edits: int) -> str:
    chance = random.Random(seed)
    words = text.split(" ")
    for _ in range(edits):
        words[chance.randrange(len(words))] = "changed"
    return " ".join(words)


def awkward_texts() -> list[tuple[int | None, str | None]]:
    """Nulls, empties, white space, ties, repeated rows, copies and a long text."""
    base = prose(1, 120)
    return [
        (10, base),
        (3, base),
        (3, base),
        (7, base.replace(" ", "  \n")),
        (None, base),
        (None, None),
        (1, None),
        (2, ""),
        (4, " \t\n"),
        (5, "one"),
        (6, "two words"),
        (8, near_copy(base, 2, 1)),
        (9, near_copy(base, 3, 2)),
        (11, prose(4, 300)),
        (12, "\n".join(prose(50 + i, 9) for i in range(40))),
        (13, "a\u0000b\x1f ÄÖ é🙂 K ſ"),
        (14, prose(5, 40_000)),
        (15, prose(4, 300)),
    ]


def frame(spark, rows, columns="doc_id long, text string"):
    return spark.createDataFrame(rows, columns)


def with_clashes(docs):
    """Further columns under names that operators might use themselves."""
    names = ("__text", "__source", "__key", "__gone", "__id", "__url", "found", "lines", "score", "fp", "sha", "part", "key", "id")
    return docs.withColumns({n: F.lit(f"own {n}") for n in names})
