import random

import pytest
from pyspark.sql import types as T

#: Input columns plus some whose names the operators use themselves.
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("size", T.StringType()),
                       T.StructField("shard", T.StringType()), T.StructField("sig", T.StringType()), T.StructField("kept", T.StringType()),
                       T.StructField("id", T.StringType()), T.StructField("n", T.StringType()), T.StructField("component", T.StringType()),
                       T.StructField("evidence", T.StringType()), T.StructField("host", T.StringType()), T.StructField("target", T.StringType())])
EXTRA = ("x",) * 10


def row(key, text, source="a", lang="en"):
    return (key, text, lang, source, len(text or ""), *EXTRA)


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


def edge_rows():
    """Nulls, empty and very long texts, ties, repeated rows, near copies, shared passages."""
    rng = random.Random(7)
    passage, line = sentence(rng, 60), sentence(rng, 8)
    base = sentence(rng, 200)
    words = base.split()
    rows = [row(0, ""), row(1, None), row(2, "   \n\t "), row(3, "one two"), row(4, "One TWO"), row(4, "One TWO"), row(5, "one two three four five")]
    rows += [row(10, base), row(11, base), row(12, base, None), row(12, base, None)]
    for k in range(13, 19):  # near copies: one word changed
        w = list(words)
        w[rng.randrange(len(w))] = "changed" + str(k)
        rows.append(row(k, " ".join(w), "b"))
    for k in range(20, 30):
        rows.append(row(k, f"{sentence(rng, 40)} {passage}\n{line}\n{sentence(rng, 30)}\n{line}", rng.choice("abc")))
    rows += [row(30, "é" * 80 + " ñandú " + "日本語" * 40), row(31, "x" + "é" * 80 + " ***$$ " + "日本語" * 41), row(None, passage), row(None, base, None, None)]
    rows.append(row(40, sentence(rng, 30_000), "long"))
    rows.append(row(41, "all rights reserved. Licensed under CC BY-NC 4.0; GNU General Public Licence, all  rights\nreserved", "c"))
    rows.append(row(42, "ab " * 400, "c"))
    rows += [row(50 + k, sentence(rng, rng.choice([1, 3, 6, 12, 50, 400])), rng.choice("abc")) for k in range(40)]
    return rows


@pytest.fixture(scope="session")
def edge(spark):
    rows = edge_rows()
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache(), rows


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
