from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

#: Names that operators use inside or add; inputs may have columns of these names.
CLASHING = ["size", "shard", "slot", "node", "n", "copies", "digest", "spans", "row", "score", "kept", "n_words", "ids", "group_id",
            "text_md5", "_row", "_text", "_digest", "_key", "draw", "logs", "rank", "block", "half", "host", "path"]


def prose(seed: int, n: int) -> str:
    choose = random.Random(seed)
    return " ".join(choose.choice("abcdefghijklmnop") * 2 + str(choose.randrange(400)) for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """``(doc_id, text, lang, source, n_chars)``: nulls, empty and very long texts, ties, repeated rows."""
    body = prose(1, 120)
    near = body.replace(body.split()[60], "changed")
    rows = [
        (1, body, "en", "a", len(body)), (2, near, "en", "a", len(near)), (3, body, "en", None, len(body)),
        (4, None, "en", "b", None), (5, "", None, "b", 0), (6, " \t\n\u000b ", "en", "b", 5), (7, "two words", "en", "c", 9),
        (8, prose(2, 30_000), "en", "c", 0), (9, "é ß ❤️ 日本 #x# | <b>", None, "c", 1), (None, prose(3, 80), "de", "a", 2),
        (None, prose(4, 80), "de", "a", 2), (10, prose(5, 90), "en", "", 3), (10, prose(6, 90), "en", "d", 3), (11, "Two Words", "en", "d", 9),
    ] + [(12, prose(7, 70), "en", "a", 1)] * 3 + [(20 + i, "word " * 60, "en", "a", 300) for i in range(3)]
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    """The rows as a frame whose other columns have the names that operators use."""
    frame = spark.createDataFrame(edge_rows, "doc_id long, text string, lang string, source string, n_chars long")
    return frame.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHING])


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
