"""Set operations (U1, U2; U3 lives with the evaluators)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_splits(*parts: DataFrame) -> DataFrame:
    """Train and dev (or any splits) as one table, columns matched by name."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def mirror(ex: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """The examples plus their mirror images: every (a, b) column pair
    swapped (e.g. source/target and source feats/target feats together)."""
    swap = {}
    for a, b in pairs:
        swap[a], swap[b] = b, a
    mirrored = ex.select(*[F.col(swap.get(c, c)).alias(c) for c in ex.columns])
    return ex.withColumn("mirrored", F.lit(False)).unionByName(mirrored.withColumn("mirrored", F.lit(True)))
