import random

import pytest

WORDS = "the of and river stone light paper garden window music silver forest bridge candle".split()


def prose(seed: int, n: int) -> str:
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) + rnd.choice(["", "", "s", "ly", "er"]) + str(rnd.randrange(50)) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text) with nulls, empty and long texts, copies, near copies, repeated rows."""
    long_text = prose(1, 6000)
    passage = prose(2, 60)
    line = "This very line is repeated everywhere"
    return [
        (1, long_text),
        (2, long_text),
        (3, " ".join(prose(3, 120).split()[:119]) + " changed"),
        (4, prose(3, 120)),
        (5, None),
        (6, ""),
        (7, " \t\n"),
        (8, f"{prose(4, 30)}\n{line}\n{passage} {prose(5, 30)}"),
        (9, f"{prose(6, 40)} {passage}\n  {line.upper()} \nshort\nshort"),
        (10, "Ünïcode ÉTÉ naïve 😀 中文 don't <|endoftext|> x²"),
        (11, "the river"),
        (11, "the river"),
        (None, "a row without an id"),
        (None, None),
        (12, "the  river\n"),
        (13, "all rights reserved. Licensed under the Apache License, Version 2.0 (cc by)"),
        (14, prose(7, 15)),
    ]


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """The corpus with extra columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    extra = "fp score key lost kept keep_id recipe gram word start items a.b".split()
    frame = spark.createDataFrame(corpus, "doc_id long, text string").repartition(3)
    frame = frame.select("*", F.lit("src0").alias("source"), *(F.lit(1).alias(c) for c in extra))
    return frame


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def rows_of():
    """Rows as sorted tuples."""

    def rows(frame, *columns):
        found = frame.select(*columns) if columns else frame
        return sorted((tuple(r) for r in found.collect()), key=repr)

    return rows
