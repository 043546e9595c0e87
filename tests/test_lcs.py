"""Bit-parallel LCS against the table of the definition."""

import random

from pyspark.sql import functions as F

from lexiflow.operators.evaluate import lcs_length


def table(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        row = [0] + [0] * len(b) if not b else row
        new = [0]
        for j, y in enumerate(b, 1):
            new.append(row[j - 1] + 1 if x == y else max(row[j], new[-1]))
        row = new
    return row[-1]


def test_lcs_against_table(spark):
    r = random.Random(1)
    rows = [(None, "a"), ("a", None), ("", ""), ("", "x"), ("ñandú", "nandú"), ("a" * 62, "a" * 62), ("a" * 63, "a" * 63), ("ab" * 100, "ba" * 90), ("walking", "walk"), ("walk", "walked")]
    for n in (1, 5, 12, 61, 62, 63, 64, 124, 125, 300):
        for letters in ("ab", "abcdeé", "abcdefghijklmnopqrstuvwxyzñü"):
            for _ in range(4):
                rows.append(tuple("".join(r.choice(letters) for _ in range(r.randint(max(n - 3, 0), n))) for _ in range(2)))
    df = spark.createDataFrame(rows, "a string, b string")
    got = df.select("a", "b", lcs_length(F.col("a"), F.col("b")).alias("n"))
    assert all(x.n == table(x.a or "", x.b or "") for x in got.collect())
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()
