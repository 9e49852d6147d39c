"""Documents that every operator must take: nulls, empty and long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside; as columns of the input they must not disturb.
CLASHING = "digest keep_id kept text_hash fp root row_id block shard letters score ids spans u"


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}x" for _ in range(n))


def odd_rows() -> list[tuple]:
    shared = prose(1, 60)
    return [
        (5, None, None, None, None), (6, "", "en", "s", 0), (7, " \t\n", "en", "s", 3), (8, shared, "en", "s", 1),
        (9, shared.replace(" ", "\n", 3), "en", None, 1), (10, shared + "  ", "en", "s", 1),
        (11, prose(2, 40) + " " + shared + " " + prose(3, 40), "en", "s", 1),
        (12, prose(4, 9000), "en", "s", 1), (12, prose(4, 9000), "en", "s", 1), (None, prose(5, 50), None, None, None),
        (None, prose(5, 50), None, None, None), (13, "é" * 300 + " ü ß   \x85 x", "de", "s", 1), (14, "a", "en", "s", 1),
        (15, prose(4, 9000)[:-1] + "y", "en", "s", 1), (16, "12 34 !!", "en", "s", 1), (17, "x\x00y " * 40, "en", "s", 1),
    ]


def odd_docs(spark):
    """The odd rows, over several partitions, with columns whose names the operators use themselves."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)
    return df.withColumns({c: F.lit("z") for c in CLASHING.split()})


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
