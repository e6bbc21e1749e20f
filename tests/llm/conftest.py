from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Names that operators use inside or return.
    T.StructField("score", T.StringType()), T.StructField("print", T.IntegerType()), T.StructField("block", T.StringType()),
    T.StructField("quality_score", T.DoubleType()), T.StructField("scan_row", T.LongType()),
])
STEMS = {"en": "the and ing tion er ed ly th sh ou".split(), "de": "der sch ung keit ein ich ver und ß ü".split()}


def prose(seed: int, words: int, lang: str = "en") -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(STEMS[lang]) for _ in range(rng.randint(1, 4))) for _ in range(words))


def edge_texts() -> list[tuple]:
    """(doc_id, text): nulls, empty and blank texts, copies, near copies, a shared passage, a very long text."""
    base, passage = prose(1, 80), prose(2, 30)
    near = base.split()
    near[40] = "changed"
    return [
        (1, None), (2, ""), (3, "  \n\t "), (4, "one two"), (5, "one two"), (6, base), (7, base), (6, base),
        (8, " ".join(near)), (9, base.upper()), (10, f"{prose(3, 20)} {passage} {prose(4, 9)}"), (11, f"é{passage} {prose(5, 25)}"),
        (12, prose(6, 9000)), (13, "a" * 300), (14, "a" * 120), (15, prose(7, 60, "de")), (6, prose(8, 40)),
        (None, base), (None, None), (16, "日本語 🎉 " * 12), (17, "x\x00y\r\n z"), (18, passage[:60] + passage[:60]),
    ]


@pytest.fixture
def documents(spark):
    """A frame of given (doc_id, text) rows with the columns of documents and some that clash."""
    def make(pairs):
        rows = [
            (i, t, None if t is None else "de" if "sch" in t else "en", "s", None if t is None else len(t), "x", 1, "b", 0.5, 9)
            for i, t in pairs
        ]
        return spark.createDataFrame(rows, DOCUMENTS)

    return make
