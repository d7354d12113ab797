from __future__ import annotations

import random

import pytest

from tickloom.llm.queries import find_package

@pytest.fixture(autouse=True)
def package(spark):
    find_package(spark)


@pytest.fixture
def corpus():
    """(id, text, lang, source) with nulls, empty and long texts, ties, copies and repeated rows."""
    rng = random.Random(11)
    vocab = [f"w{i}" for i in range(60)] + ["é,", "the", "of", "a b"]
    passage = [rng.choice(vocab) for _ in range(120)]
    rows = []
    for i in range(150):
        words = [rng.choice(vocab) for _ in range(rng.randint(0, 90))]
        if i % 5 == 0:
            words[5:5] = passage[: rng.randint(30, 120)]
        if i % 11 == 0:
            words += ["go", "on"] * rng.randint(1, 60)
        rows.append((i, rng.choice([" ", "\n", "  \t"]).join(words), rng.choice(["en", "fr"]), f"s{i % 4}"))
    rows += [(200 + k, rows[3][1], "en", None) for k in range(12)]
    rows += [(300, None, None, None), (301, "", "en", "s0"), (302, " \n\t ", "fr", "s1"), (None, "some text", "en", "s0")]
    rows += [(303, rows[7][1], "en", "s3")] * 3 + [(None, None, None, None)] * 2
    rows.append((304, " ".join(rng.choice(vocab) for _ in range(20_000)), "en", "s2"))
    return rows


@pytest.fixture
def docs(spark, corpus):
    """The corpus with further columns whose names the operators use inside."""
    df = spark.createDataFrame(corpus, "doc_id long, text string, lang string, source string")
    return df.selectExpr("*", "1 AS id", "'x' AS row", "2 AS size", "0.5 AS score", "array(1) AS words").repartition(5)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string")
