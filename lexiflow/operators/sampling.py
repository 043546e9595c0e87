"""Seeded splits and samples.

Order comes from ``md5(seed:key)`` (hex compares like the 128-bit number), a
hash every engine computes the same way, so a split is reproducible across
runs, clusters and the SQL oracle. No sampler gathers the table in one task:
global ranks use the chunked prefix sum of ``windows.running_number`` (chunks
are hash prefixes, so they are balanced), an exact split only looks for its two
cuts, quotas are cut at a hash prefix found by counting, and per-group heads are
merged in a tree (``first_rows``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .windows import running_number


#: Heads of a group that are merged in one task.
FAN = 64


def seeded_hash(key: Column, seed: int | str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def seeded_rank(df: DataFrame, key: Column, seed: int | str, out: str = "rank") -> DataFrame:
    """1-based global rank of each row by its seeded hash (ties by key)."""
    h = df.withColumn("_h", seeded_hash(key, seed)).withColumn("_k", key.cast("string"))
    # 5 hex digits = 2^20 balanced chunks.
    return running_number(h, [], ["_h", "_k"], out,
                          chunk=F.conv(F.substring("_h", 1, 5), 16, 10).cast("bigint")).drop("_h", "_k")


def split_exact(df: DataFrame, key: Sequence[str], p: float, q: float, seed: int, rank: bool = True) -> DataFrame:
    """Shuffle the distinct keys with a fixed seed; the first round(p*n) are
    test, the next round(q*n) valid, the rest train (rounding half to even, as
    Python's ``round``). Returns the distinct keys with ``rank`` and ``split``.

    Without ``rank`` nothing is ranked but the two hash prefixes in which the cuts
    fall: prefix counts tell where that is, and every other key gets its split by
    comparing its hash with the keys at the cuts. The distinct keys are written once."""
    kstr = F.concat_ws("_", *[F.col(k).cast("string") for k in key])
    keys = df.select(*key).distinct()
    if rank:
        ranked = seeded_rank(keys, kstr, seed)
        # the total is a scalar subquery: one number, no join
        n = keys.agg(F.count(F.lit(1))).scalar()
        n_test, n_valid = F.bround(n * p, 0), F.bround(n * q, 0)
        s = (F.when(F.col("rank") <= n_test, F.lit("test"))
              .when(F.col("rank") <= n_test + n_valid, F.lit("valid")).otherwise(F.lit("train")))
        return ranked.select(*key, "rank", s.alias("split"))
    keys = materialise(keys.withColumn("_h", seeded_hash(kstr, seed)).withColumn("_k", kstr))
    # at most 16^4 prefixes, whatever the number of keys
    counts = materialise(keys.groupBy(F.substring("_h", 1, 4).alias("_b")).agg(F.count(F.lit(1)).alias("_n")))
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    running = counts.withColumn("_to", F.sum("_n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)))

    def upto(at: int) -> Column:
        """Whether a key is among the first ``at``."""
        if at <= 0 or at >= total:
            return F.lit(at > 0)
        edge = running.filter((F.col("_to") >= at) & (F.col("_to") - F.col("_n") < at)).first()
        last = keys.filter(F.substring("_h", 1, 4) == edge["_b"]).orderBy("_h", "_k").offset(
            at - (edge["_to"] - edge["_n"]) - 1).limit(1).first()
        return (F.col("_h") < last["_h"]) | ((F.col("_h") == last["_h"]) & (F.col("_k") <= last["_k"]))

    n_test = round(total * p)
    split = F.when(upto(n_test), F.lit("test")).when(upto(n_test + round(total * q)), F.lit("valid")).otherwise(F.lit("train"))
    return keys.select(*key, split.alias("split"))


def nested_samples(df: DataFrame, key: Column, sizes: Sequence[int], seed: int) -> DataFrame:
    """One seeded shuffle; sample ``s`` is its first ``s`` rows, so smaller
    samples nest in larger ones. One output row per (sample_size, row). Only the
    rows of the largest sample are ever numbered."""
    most = max((int(s) for s in sizes), default=0)
    order = [seeded_hash(key, seed), key.cast("string")]
    top = df.withColumn("_h", order[0]).withColumn("_k", order[1]).orderBy("_h", "_k").limit(most)
    ranked = running_number(top, [], ["_h", "_k"], "rank",
                            chunk=F.conv(F.substring("_h", 1, 5), 16, 10).cast("bigint")).drop("_h", "_k")
    arr = F.array(*[F.lit(int(s)) for s in sizes])
    return ranked.select("*", F.explode(F.filter(arr, lambda s: F.col("rank") <= s)).alias("sample_size"))


def first_rows(df: DataFrame, key: Sequence[str], order: Sequence[Column], n: int, out: str) -> DataFrame:
    """The first ``n`` rows of each group with their rank, as a tree of heads. The
    largest group's size gives the number of levels; on each level a group's rows
    are dealt to so many hash buckets that about ``FAN * n`` of them meet in one,
    which keeps its first ``n``. What a task sorts depends on ``n`` alone, and a
    table of small groups is ranked at once."""
    largest = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).agg(F.coalesce(F.max("_n"), F.lit(0))).first()[0]
    buckets = 1
    while buckets * FAN * max(n, 1) < largest:
        buckets *= FAN
    while buckets > 1:
        w = Window.partitionBy(*key, "_b").orderBy(*order)
        df = df.withColumn("_b", F.pmod(F.xxhash64(*order), F.lit(buckets))).withColumn("_r", F.row_number().over(w)).filter(
            F.col("_r") <= n).drop("_b", "_r")
        buckets //= FAN
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter(F.col(out) <= n)


def split_stratified(df: DataFrame, stratum: str, key: Column, quotas: Mapping[str, Sequence[int]],
                     seed: int, roles: Sequence[str] = ("train", "dev", "test")) -> DataFrame:
    """Per stratum, rows in seeded order fill the quotas contiguously:
    the first q_train rows train, the next q_dev dev, the next q_test test; the
    rest is not sampled. ``quotas`` maps stratum -> (q_train, q_dev, q_test); the
    quota table is a literal of a few rows (broadcast).

    Counts of hash prefixes give each stratum the prefix up to which its quota is
    surely reached. Only rows up to there are moved and ranked: the quota and what
    one prefix holds, a millionth of the stratum. Strata without a quota go first."""
    spark = df.sparkSession
    qrows = [(s, *[int(x) for x in v]) for s, v in quotas.items()]
    qdf = F.broadcast(spark.createDataFrame(qrows, f"{stratum} string, " + ", ".join(f"q_{r} long" for r in roles)))
    quota = sum((F.col(f"q_{r}") for r in roles), F.lit(0))
    rows = df.withColumn("_h", seeded_hash(key, seed)).withColumn("_k", key.cast("string")).join(qdf, stratum)
    prefix = F.substring("_h", 1, 5)
    counts = rows.groupBy(stratum, prefix.alias("_b"), quota.alias("_q")).agg(F.count(F.lit(1)).alias("_n"))
    running = F.sum("_n").over(Window.partitionBy(stratum).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0))
    last = counts.withColumn("_to", running).filter(F.col("_to") - F.col("_n") < F.col("_q")).groupBy(stratum).agg(
        F.max("_b").alias("_last"))  # a row a quota
    few = rows.join(F.broadcast(last), stratum).filter(prefix <= F.col("_last")).drop("_last")
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy(stratum).orderBy("_h", "_k"))).drop("_h", "_k")
    role, upto = F.lit(None).cast("string"), quota
    for r in reversed(roles):
        role, upto = F.when(F.col("rank") <= upto, F.lit(r)).otherwise(role), upto - F.col(f"q_{r}")
    return ranked.withColumn("role", role).filter(F.col("role").isNotNull()).drop(*[f"q_{r}" for r in roles])


def head_per_group(df: DataFrame, key: str, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows of each group in ``order``."""
    return first_rows(df, [key], [F.col(c) for c in order], n, "rn")


def top_k(df: DataFrame, key: Sequence[str], score: str, k: int, tie: Sequence[str] = ()) -> DataFrame:
    """The ``k`` best rows per key by ``score`` (best first, ties by ``tie``)."""
    w = Window.partitionBy(*key).orderBy(F.col(score).desc(), *tie)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def top_k_array(arr: Column, k: int) -> Column:
    """W7 on an array: the ``k`` largest elements, largest first."""
    return F.slice(F.sort_array(arr, asc=False), 1, k)
