"""Small tables with the awkward cases that every operator has to take."""

from __future__ import annotations

import random

from pyspark.sql import types as T

LONG = " ".join(f"wort{i % 977}" for i in range(60_000))

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that the operators use inside or give to their results.
        *[T.StructField(n, T.StringType()) for n in ("size", "shard", "key", "id", "chunk", "group_size", "score", "ids")],
    ]
)


def sentence(rng: random.Random, words: int) -> str:
    return " ".join(rng.choice("der die das ein Haus Baum ist war alt neu groß klein".split()) + str(rng.randrange(40)) for _ in range(words))


def rows(seed: int = 1, n: int = 60) -> list[tuple]:
    rng = random.Random(seed)
    texts = [sentence(rng, rng.randrange(1, 90)) for _ in range(n)]
    shared = sentence(rng, 50)
    texts[3] = texts[4] = texts[5]
    texts[6] = f"{sentence(rng, 20)} {shared} {sentence(rng, 9)}"
    texts[7] = f"{shared} {sentence(rng, 30)}"
    texts[8] = f"{shared} x {shared}"
    texts[9] = LONG
    texts[10], texts[11], texts[12], texts[13] = None, "", " \n\t ", None
    texts[14] = "Licensed under the Apache License, Version 2.0.\n" + texts[14]
    texts[15] = "▁ a▁b  c\r\n\x0b ퟿😀 ende "
    found = [
        (i, t, "de", None if i % 11 == 0 else f"src{i % 4}", None if t is None else len(t), *["own"] * 8) for i, t in enumerate(texts)
    ]
    found += [found[20]] * 3  # repeated rows
    found.append((None, texts[21], None, "src1", 1, *[None] * 8))
    found.append((None, None, None, None, None, *[None] * 8))
    return found


def documents(spark, seed: int = 1, n: int = 60):
    return spark.createDataFrame(rows(seed, n), SCHEMA).repartition(3)


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()
