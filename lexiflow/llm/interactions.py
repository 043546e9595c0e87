"""Audit of how filters interact: what each removes after the others, in every order.

A document's failures are the bits of a mask. Counted by part and mask, the
documents give the table v(S) of all coalitions S of filters: how many a part
loses when the filters of S are applied. That table answers everything.

* Step counts are coalition differences: a filter applied after those of S
  removes v(S + f) - v(S), of the v(f) that fail it.
* Shapley values solve the kernel-weighted least squares problem
  min sum w(S) (v(S) - sum of phi over S)^2 with sum of phi = v(all). Its normal
  equations, with a multiplier for the constraint, are solved in rationals for the
  unit vectors of all coalitions. The solution is linear in v, so one exact matrix
  serves every part; times the number of orders its entries are whole numbers,
  and the sum over all orders is an integer product on Spark.

The corpus is reduced to (part, mask) counts in tasks before it moves; nothing
but that matrix is computed on the driver."""

from __future__ import annotations

import re
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare, written

MIN_WORDS = 50
MIN_DISTINCT = 65  # per cent of the words
MAX_CAPITALS = 5  # per cent of the code points
SYMBOLS = "#$%&*|"
FILTERS = "ABCDE"

_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_SYMBOL = re.compile(b"[" + re.escape(SYMBOLS).encode() + b"]")
_CONTINUATION = bytes(range(0x80, 0xC0))


def text_failures(text: bytes) -> int:
    """Bits 0 to 3: too few words, too few distinct ones, too many capitals, a symbol.
    Words are maximal runs of bytes other than space and \\t to \\r."""
    words = text.split()
    points = len(text) - (0 if text.isascii() else len(text) - len(text.translate(None, _CONTINUATION)))
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    return ((len(words) < MIN_WORDS)
            | (100 * len(set(words)) < MIN_DISTINCT * len(words)) << 1
            | (100 * capitals > MAX_CAPITALS * points) << 2
            | (_SYMBOL.search(text) is not None) << 3)


def failures(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """``doc_id``, ``part`` (null: empty) and ``mask`` of the five filters for every row.

    Bit 4: the text equals that of a smaller id anywhere in the table. A null text
    is empty. A null id is smaller than none and has no smaller one, so it never
    sets bit 4; repeated rows of one id don't set it for each other."""
    prepare(docs.sparkSession)
    base = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))

    def run(batches):
        import hashlib

        import pyarrow as pa

        for batch in batches:
            texts = batch.column(2).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([text_failures(t) for t in texts], pa.int32()),
                 pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())], ["doc_id", "part", "mask", "digest"])

    # two consumers: the texts are judged once
    rows = written(base.mapInArrow(run, "doc_id long, part string, mask int, digest binary"), "failures", compression="zstd")
    # written ahead, so that the join has an exchange of its own and a hot text can be split over tasks
    first = written(rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
                    .filter("first < last").drop("last"), "repeated-texts")
    return rows.join(first, "digest", "left").select(
        "doc_id", "part", F.when(F.col("doc_id") > F.col("first"), F.col("mask").bitwiseOR(16)).otherwise(F.col("mask")).alias("mask"))


def shapley_matrix(n: int) -> list[list[int]]:
    """Row f, column S: the weight of v(S) in n! times the Shapley value of filter f,
    from the efficiency-constrained normal equations in rationals."""
    full = (1 << n) - 1
    weight = {s: Fraction(n - 1, comb(n, k) * k * (n - k)) for s in range(1, full) if (k := s.bit_count())}
    members = {s: [i for i in range(n) if s >> i & 1] for s in range(full + 1)}
    # unknowns: phi of each filter and the multiplier; right-hand sides: each v(S) = 1
    rows = [[Fraction(0)] * (n + 1 + full + 1) for _ in range(n + 1)]
    for s, w in weight.items():
        for i in members[s]:
            for j in members[s]:
                rows[i][j] += w
            rows[i][n + 1 + s] += w
    for i in range(n):
        rows[i][n] = rows[n][i] = Fraction(1)
    rows[n][n + 1 + full], rows[n][n + 1] = Fraction(1), Fraction(-1)
    for c in range(n + 1):
        pivot = next(r for r in range(c, n + 1) if rows[r][c])
        rows[c], rows[pivot] = rows[pivot], rows[c]
        rows[c] = [x / rows[c][c] for x in rows[c]]
        for r in range(n + 1):
            if r != c and rows[r][c]:
                rows[r] = [x - rows[r][c] * y for x, y in zip(rows[r], rows[c])]
    scaled = [[x * factorial(n) for x in row[n + 1:]] for row in rows[:n]]
    if any(x.denominator != 1 for row in scaled for x in row):
        raise ArithmeticError("the solution is not a whole number of orders")
    return [[int(x) for x in row] for row in scaled]


def audit(flags: DataFrame, outcomes: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of ``filters`` and step, zeros included.

    ``flags`` has ``doc_id``, ``part`` and ``mask`` (bit i: fails ``filters[i]``);
    ``outcomes`` has ``doc_id``, ``quality`` and ``toxic``, where an id counts as good
    (toxic) if any of its rows says 1; ids without a row, null ids and null values
    say nothing. Up to six filters. An empty ``flags`` gives no rows."""
    n = len(filters)
    if not 2 <= n <= 6 or len(set(filters)) != n:
        raise ValueError("two to six filters with different letters")
    known = outcomes.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.coalesce("quality", F.lit(0)) == 1).cast("long")).alias("good"),
        F.max((F.coalesce("toxic", F.lit(0)) == 1).cast("long")).alias("toxic"))
    counts = flags.select("doc_id", "part", "mask").join(known, "doc_id", "left").groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))
    # at most 2^n masks a part
    table = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("t"))

    def coalitions(field: str) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit((1 << n) - 1)), lambda s: F.aggregate(
            "t", F.lit(0).cast("long"), lambda a, m: a + F.when(m["mask"].bitwiseAND(s) != 0, m[field]).otherwise(0)))

    whole = F.aggregate("t", F.lit(0).cast("long"), lambda a, m: a + m["n"])
    v = table.select("part", whole.alias("rows"), coalitions("n").alias("v"), coalitions("good").alias("g"), coalitions("toxic").alias("x"))
    shares = [F.aggregate(F.zip_with("v", F.lit(row), lambda a, b: a * b), F.lit(0).cast("long"), lambda a, b: a + b)
              for row in shapley_matrix(n)]
    v = v.select("*", F.array(*shares).alias("shares"))

    orders = list(permutations(range(n)))
    steps = [(o, k, order[k], sum(1 << f for f in order[:k])) for o, order in enumerate(orders) for k in range(n)]

    def constant(values) -> Column:
        return F.lit(list(values))[F.col("i")]

    every = v.select("*", F.explode(F.sequence(F.lit(0), F.lit(len(steps) - 1))).alias("i")).select(
        "*", constant(s[0] for s in steps).alias("o"), constant(s[1] + 1 for s in steps).alias("step"),
        constant(s[2] for s in steps).alias("f"), constant(s[3] for s in steps).alias("before"),
        constant(s[3] | 1 << s[2] for s in steps).alias("after"), constant(1 << s[2] for s in steps).alias("alone"))
    removed = F.col("v")[F.col("after")] - F.col("v")[F.col("before")]
    full = (1 << n) - 1
    return every.select(
        "part", F.lit(["".join(filters[f] for f in order) for order in orders])[F.col("o")].alias("filter_order"), "step",
        (F.col("rows") - F.col("v")[F.col("after")]).alias("kept"), removed.alias("removed"),
        (F.col("v")[F.col("alone")] - removed).alias("redundant"),
        (F.col("v")[full] - F.col("v")[F.lit(full).bitwiseXOR(F.col("alone"))]).alias("unique_fails"),
        (F.col("g")[F.col("after")] - F.col("g")[F.col("before")]).alias("good_lost"),
        (F.col("x")[F.col("after")] - F.col("x")[F.col("before")]).alias("toxic_lost"),
        F.col("shares")[F.col("f")].alias("shapley"))
