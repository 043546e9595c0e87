"""Scoring core shared by the evaluators.

Every scorer first collapses its input to distinct (group, gold, prediction)
rows with a count. That partial aggregate runs map-side, so a hot form (a
function word holding a third of all tokens) costs one row per task before the
shuffle, and the edit distance is computed once per distinct pair instead of
once per token.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIGITS = 6


def ratio(num: Column, den: Column) -> Column:
    """num / den as a rounded double, null when den is 0 (the reference divides by zero)."""
    return F.when(den > 0, F.round(num.cast("double") / den, DIGITS))


def collapse(df: DataFrame, by: Sequence[str], gold: str, pred: str, weight: str | None = None) -> DataFrame:
    """(by..., gold, pred, n): distinct pairs with their multiplicity."""
    w = F.sum(weight) if weight else F.count(F.lit(1))
    return df.groupBy(*by, gold, pred).agg(w.cast("bigint").alias("n"))


def score_collapsed(pairs: DataFrame, by: Sequence[str], gold: str, pred: str) -> DataFrame:
    """Accuracy and mean edit distance over wrong rows only, per group."""
    ok = F.col(gold).eqNullSafe(F.col(pred))
    dist = F.when(~ok, F.levenshtein(F.coalesce(F.col(pred), F.lit("")), F.coalesce(F.col(gold), F.lit(""))))
    n = F.col("n")
    out = pairs.groupBy(*by).agg(
        F.sum(n).cast("bigint").alias("n_rows"),
        F.sum(F.when(ok, n).otherwise(0)).cast("bigint").alias("n_right"),
        F.sum(F.when(~ok, n).otherwise(0)).cast("bigint").alias("n_wrong"),
        F.coalesce(F.sum(dist * n), F.lit(0)).cast("bigint").alias("distance"))
    return out.select(*by, "n_rows", "n_right", "n_wrong", "distance",
                      ratio(F.col("n_right"), F.col("n_rows")).alias("accuracy"),
                      ratio(F.col("distance"), F.col("n_wrong")).alias("mean_distance"))


def score(df: DataFrame, by: Sequence[str], gold: str, pred: str, weight: str | None = None) -> DataFrame:
    return score_collapsed(collapse(df, by, gold, pred, weight), by, gold, pred)
