import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(rng, n):
    return " ".join("".join(rng.choice(("an", "the", "on", "re", "ti", "ou", "é", "sch", "ción", "ing", "ble")) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Rows with copies, near copies, shared passages, nulls, blanks, repeated rows and one very long text."""
    rng = random.Random(17)
    rows = []

    def add(text, lang="en", source="a"):
        rows.append((len(rows), text, lang, source, None if text is None else len(text)))

    passage = prose(rng, 40)
    for k in range(25):
        add(prose(rng, rng.randint(60, 200)), rng.choice(("en", "de", None)), rng.choice(("a", "a", "a", "b", None)))
    base = prose(rng, 150).split(" ")
    for k in range(12):  # near copies of each other
        copy = list(base)
        for _ in range(k % 5):
            copy[rng.randrange(len(copy))] = "edit"
        add(" ".join(copy))
    for k in range(6):
        add(rows[3][1])
        add(rows[4][1].replace(" ", "\n ") + "\t")
        add(prose(rng, 30) + " " + passage + "\n" + prose(rng, 20))
    add(None)
    add("")
    add(" \n\t ")
    add(None, None, None)
    add("one two", "xx", "")
    add("a\x00b é c 🙂 " * 30)
    add("ab " * 300)
    add("x" * 5000)
    add(" ".join(prose(rng, 40) for _ in range(600)))  # very long
    add("mail a.b@c.example.com call +1 (988) 555-2485 on 4111111111111111 at 10.0.0.1 not 10.0.0.256 password=b7db7aa4a5fcc78305 end")
    add("Licensed under the Apache License, Version 2.0.\nCC BY-NC 4.0 and the MIT License; gnu General  public-license")
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus, tmp_path_factory):
    """The corpus as a table with extra columns under names that the operators use themselves."""
    from pyspark.sql import functions as F

    path = str(tmp_path_factory.mktemp("corpus") / "documents")
    frame = spark.createDataFrame(corpus, SCHEMA).withColumns(
        {n: F.lit(1) for n in ("kept", "digest", "norm", "block", "position", "n_words", "_t", "_w", "_row", "_id", "key", "u", "bucket", "length", "spans", "id", "score")})
    frame.repartition(4).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
