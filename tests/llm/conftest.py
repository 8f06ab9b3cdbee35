from __future__ import annotations

import pytest
from pyspark.sql import functions as F

#: nulls, empty, blank, tiny, very long, repeated and tied rows
LONG = "Xyz ab " * 30_000 + "end."
EDGES = [
    (1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, "one two three"), (6, LONG), (6, LONG), (7, LONG), (None, "no id here, none"),
    (None, "no id here, none"), (8, "x" * 100_000), (8, "a tie of ids"), (9, "é世\U0001f642 <turn </turn> \\ \x00"),
]


@pytest.fixture(scope="session")
def edges(spark):
    """Edge rows with columns whose names the operators might use themselves."""
    df = spark.createDataFrame(EDGES, "doc_id long, text string").repartition(3)
    clash = ["key", "id", "class", "class_id", "comp", "spans", "pii", "items", "votes", "measures", "quality", "shard", "Shard_Bytes",
             "n_bytes", "addr", "t", "w", "g", "r", "n_chars", "blank", "own", "band", "masked",
             "h", "keep_id", "group_size", "kept", "text_sha256", "ties", "place", "first", "row", "part", "step", "filter", "n_least", "digest"]
    return df.select("*", *[F.lit(c).alias(c) for c in clash])


@pytest.fixture(scope="session")
def nothing(edges):
    return edges.limit(0)


def rows(df, *columns):
    """All rows as sorted tuples; nulls first."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda t: [(x is not None, x) for x in map(str, t)])
