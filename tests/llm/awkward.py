"""Small document tables with everything that may go wrong in them."""

from __future__ import annotations

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Names that the operators use inside.
    *(T.StructField(c, T.StringType()) for c in ("id", "t", "a", "b", "k0", "u0", "key", "name", "run", "runs", "print", "root", "spans", "row", "keep", "ids", "n_words", "g_root")),
])


def rows(texts, first_id=0):
    out = []
    for i, t in enumerate(texts):
        own, text = t if isinstance(t, tuple) else (first_id + i, t)
        out.append((own, text, None if i % 5 == 0 else "en", "s", None if text is None else len(text), *["x"] * (len(SCHEMA) - 5)))
    return out


def frame(spark, texts, parts=3):
    return spark.createDataFrame(rows(texts), SCHEMA).repartition(parts)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(dice: random.Random, n: int, size: int = 400) -> str:
    return " ".join(f"w{dice.randint(0, size)}" for _ in range(n))


def corpus(seed: int = 1) -> list:
    """Copies, near copies, shared passages, periodic and odd texts, nulls, repeated and missing ids."""
    dice = random.Random(seed)
    base = [words(dice, dice.randint(20, 160)) for _ in range(12)]
    passage, long_passage = words(dice, 30), words(dice, 140)
    texts: list = [*base, base[0], base[0], base[1] + " tail", "head " + base[2], *[f"{words(dice, 9)} {passage} {words(dice, 7)}" for _ in range(6)]]
    texts += [f"{words(dice, 3)}\n{long_passage} {words(dice, 4)}" for _ in range(4)]
    near = base[5].split()
    for i in range(6):
        copy = list(near)
        copy[dice.randrange(len(copy))] = f"x{i}"
        texts.append(" ".join(copy))
    texts += ["ab " * 400, "a" * 1500, "", "   \n\t ", None, None, "one", "one two three", "ÄÖ ünïcode ▁ blank nbsp  two  blanks \n\n line", words(dice, 3000, 50)]
    texts += [(7, base[3]), (7, words(dice, 60)), (None, base[4]), (None, words(dice, 60)), (None, base[4])]
    return texts
