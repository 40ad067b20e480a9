"""Awkward rows for the tests of the operators."""

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("size", T.StringType()), T.StructField("row", T.LongType()), T.StructField("N_words", T.LongType())]
)


def long_text(seed: int, n: int) -> str:
    import random

    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 7))) for _ in range(n))


def awkward_texts() -> list[tuple]:
    """Nulls, empty, very long, tied and repeated rows; an id twice, a null id, shared passages."""
    passage, base = long_text(1, 60), long_text(2, 200)
    near = base.split()
    near[100] = "changed"
    texts = [
        (1, None, "a"),
        (2, "", "a"),
        (3, "  \n\t ", None),
        (4, "one", "b"),
        (5, f"{long_text(3, 30)} {passage} {long_text(4, 40)}", "a"),
        (6, f"{long_text(5, 9)}\n{passage}", "b"),
        (7, passage, None),
        (8, base, "a"),
        (9, base, "c"),
        (9, base, "c"),
        (10, " ".join(near), "a"),
        (11, "tie " * 500, "a"),
        (12, long_text(6, 30000), "b"),
        (13, "x" * 50000, "d"),
        (14, "ONE two THREE four five", "a"),
        (15, "one TWO three FOUR five", "a"),
        (None, long_text(7, 50), "a"),
        (None, long_text(7, 50), "a"),
        (4, "another text with the same id", "b"),
        (16, "Æther ﬁ ́e   中文 😀 CC BY-NC 4.0, All Rights Reserved. <|endoftext|>", "d"),
        (17, "Released under the MIT License. GNU General Public License, version 3", "d"),
    ]
    return [(i, t, "en", s, None if t is None else len(t), "clash", 7, 8) for i, t, s in texts]
