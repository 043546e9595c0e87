"""Character alignment of word pairs.

Spark has no edit-alignment operator, so the dynamic programme runs in an
Arrow-batched ``mapInPandas`` kernel, and only on **distinct** pairs: the
corpus is collapsed to distinct (source, target) first (a hot pair costs one
row per task before the shuffle), aligned once, and joined back where rows are
needed. The kernel keeps no state between rows.

Corpus alignment (M3) re-aims the reference's sequential sampler as batch
hard EM: count aligned symbol pairs with ``groupBy``, turn counts into costs,
re-align every pair with those costs, repeat. The pairs are dealt to buckets and
each bucket is sent the cost table; nothing is collected. Each round's alignment is written to the shared checkpoint folder to cut
the lineage.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import chars

GAP = "~"
PRIOR = 0.1
#: Distinct pairs that one task aligns at a time, about.
BUCKET_PAIRS = 5_000
#: Rounds of corpus alignment (the original aligner's value).
ROUNDS = 10


def align_pad(a: Column, b: Column) -> tuple[Column, Column]:
    """M1: pad the shorter side on the right with the gap symbol (all pairs kept, Q4)."""
    n = F.greatest(F.length(a), F.length(b))
    return F.rpad(a, n, GAP), F.rpad(b, n, GAP)


def best_alignment(src: str, tgt: str, table: dict | None = None, default: float = 1.0) -> tuple[str, str, float]:
    """Cheapest alignment of two strings. ``table`` prices pairs of symbols, the
    gap symbol for an insertion or deletion, and ``default`` any other pair; without
    a table equal symbols are free and all else costs 1.

    ``least[i][j]`` is the price of the first i source and j target characters.
    The alignment is read from the end: of the moves that explain a price,
    deleting a source character comes first, then substituting, then inserting."""
    if table is None:
        def price(x, y):
            return 0.0 if x == y else 1.0
    else:
        def price(x, y):
            return table.get((x, y), default)
    drop = [price(c, GAP) for c in src]
    add = [price(GAP, t) for t in tgt]
    swap = [[price(c, t) for t in tgt] for c in src]
    least = [list(accumulate(add, initial=0.0))]
    for d, swaps in zip(drop, swap):
        above = least[-1]
        best = above[0] + d
        row = [best]
        for corner, up, s, a in zip(above, above[1:], swaps, add):
            up += d
            corner += s
            if corner < up:
                up = corner
            best += a
            if up < best:
                best = up
            row.append(best)
        least.append(row)
    i, j, columns = len(src), len(tgt), []
    while i or j:
        here = least[i][j]
        if i and (not j or least[i - 1][j] + drop[i - 1] == here):
            i -= 1
            columns.append((src[i], GAP))
        elif i and least[i - 1][j - 1] + swap[i - 1][j - 1] == here:
            i, j = i - 1, j - 1
            columns.append((src[i], tgt[j]))
        else:
            j -= 1
            columns.append((GAP, tgt[j]))
    columns.reverse()
    return "".join(a for a, _ in columns), "".join(b for _, b in columns), least[-1][-1]


def actions(aligned_source: Column, aligned_target: Column) -> Column:
    """M5: the transducer's actions for an alignment. A column with a source
    character steps to it (``^``); a column with a target character writes it, as
    the position of the source character the transducer stands on when they are
    equal, else as itself. At the end it steps to the end mark and stops (``>``);
    an alignment without columns only stops."""
    columns = F.arrays_zip(chars(aligned_source).alias("s"), chars(aligned_target).alias("t"))
    none = F.array().cast("array<string>")
    start = F.struct(F.lit(0).alias("at"), F.lit("<").alias("on"), none.alias("out"))

    def column(state, c):
        steps = c["s"] != GAP
        at = state["at"] + steps.cast("int")
        on = F.when(steps, c["s"]).otherwise(state["on"])
        written = F.when(c["t"] == GAP, none).otherwise(
            F.array(F.when(c["t"] == on, at.cast("string")).otherwise(c["t"])))
        return F.struct(at.alias("at"), on.alias("on"),
                        F.concat(state["out"], F.when(steps, F.array(F.lit("^"))).otherwise(none), written).alias("out"))

    def end(state):
        return F.concat(state["out"], F.when(F.size(columns) > 0, F.array(F.lit("^"))).otherwise(none), F.array(F.lit(">")))

    return F.aggregate(columns, start, column, end)


ALIGN_SCHEMA = "source string, target string, aligned_source string, aligned_target string, cost double"
WEIGHTED_SCHEMA = ALIGN_SCHEMA + ", n long"


def _unit_kernel(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = [best_alignment(s, t) for s, t in zip(pdf["source"], pdf["target"])]
        yield pd.DataFrame({"source": pdf["source"], "target": pdf["target"],
                            "aligned_source": [r[0] for r in out], "aligned_target": [r[1] for r in out],
                            "cost": [float(r[2]) for r in out]})


def _cost_kernel(pairs: pd.DataFrame, costs: pd.DataFrame) -> pd.DataFrame:
    """Align a bucket of pairs at the cost table's prices; the row without symbols
    has the price of any other pair of symbols."""
    table = {(x, y): c for x, y, c in zip(costs["x"], costs["y"], costs["c"])}
    default = table.pop((None, None))
    out = [best_alignment(s, t, table, default) for s, t in zip(pairs["source"], pairs["target"])]
    return pd.DataFrame({"source": pairs["source"], "target": pairs["target"],
                         "aligned_source": [r[0] for r in out], "aligned_target": [r[1] for r in out],
                         "cost": [float(r[2]) for r in out], "n": pairs["n"].values})


def distinct_pairs(df: DataFrame, source: str, target: str) -> DataFrame:
    return df.select(F.col(source).alias("source"), F.col(target).alias("target")).distinct()


def align_med(pairs: DataFrame, source: str = "source", target: str = "target") -> DataFrame:
    """M2: minimum-edit alignment of every distinct pair (unit costs)."""
    return distinct_pairs(pairs, source, target).mapInPandas(_unit_kernel, ALIGN_SCHEMA)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """Counts of aligned symbol pairs (x, y) over the alignment table."""
    z = F.arrays_zip(chars(F.col("aligned_source")).alias("x"), chars(F.col("aligned_target")).alias("y"))
    e = aligned.select(F.explode(z).alias("p"), F.col("n") if "n" in aligned.columns else F.lit(1).alias("n"))
    return e.groupBy(F.col("p.x").alias("x"), F.col("p.y").alias("y")).agg(F.sum("n").alias("cnt"))


def costs_from_counts(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """cost(x, y) = -log((count + prior) / (total + distinct * prior)); also the
    one-row (total, distinct, default cost for unseen pairs)."""
    tot = counts.agg(F.sum("cnt").alias("total"), F.count(F.lit(1)).alias("distinct"))
    tot = tot.withColumn("default", -F.log(F.lit(PRIOR) / (F.col("total") + F.col("distinct") * PRIOR)))
    denom = tot.select(F.col("total") + F.col("distinct") * PRIOR).scalar()
    return counts.select("x", "y", (-F.log((F.col("cnt") + PRIOR) / denom)).alias("c")), tot


def _realign(weighted: DataFrame, counts: DataFrame, buckets: int) -> DataFrame:
    """Re-align every distinct pair at the prices given by ``counts``: the pairs are
    dealt to buckets of bounded size and the cost table, whose size is that of the
    alphabet's symbol pairs, is sent to each bucket once."""
    cost, tot = costs_from_counts(counts)
    none = F.lit(None).cast("string")
    table = cost.unionByName(tot.select(none.alias("x"), none.alias("y"), F.col("default").alias("c")))
    sent = table.withColumn("b", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long"))))
    dealt = weighted.withColumn("b", F.pmod(F.xxhash64("source", "target"), F.lit(buckets)))
    return dealt.groupBy("b").cogroup(sent.groupBy("b")).applyInPandas(_cost_kernel, WEIGHTED_SCHEMA)


def corpus_rounds(pairs: DataFrame, source: str = "source", target: str = "target", iters: int = ROUNDS,
                  checkpoint: bool = True) -> Iterator[tuple[DataFrame | None, DataFrame | None, DataFrame]]:
    """The rounds of ``align_corpus``: the symbol-pair counts that set the prices, the
    alignment they were counted in, and the alignment at those prices. The padded
    start comes first, without counts."""
    from ..session import materialise
    keep = materialise if checkpoint else (lambda d: d)
    weighted = keep(pairs.groupBy(F.col(source).alias("source"), F.col(target).alias("target")).agg(
        F.count(F.lit(1)).alias("n")))
    a, b = align_pad(F.col("source"), F.col("target"))
    cur = weighted.select("source", "target", a.alias("aligned_source"), b.alias("aligned_target"),
                          F.lit(None).cast("double").alias("cost"), "n")
    yield None, None, cur
    buckets = -(-max(weighted.count(), 1) // BUCKET_PAIRS)
    before = None
    for _ in range(iters):
        counts = pair_counts(cur)
        # equal counts give equal prices, so every later round would repeat this one
        now = counts.agg(F.count(F.lit(1)), F.sum(F.xxhash64("x", "y", "cnt").cast("decimal(38,0)"))).first()
        if now == before:
            return
        before = now
        last, cur = cur, keep(_realign(weighted, counts, buckets))
        yield counts, last, cur


def align_corpus(pairs: DataFrame, source: str = "source", target: str = "target", iters: int = ROUNDS,
                 checkpoint: bool = True) -> DataFrame:
    """M3: corpus alignment by batch hard EM. Start from the padded alignment
    (M1), then at most ``iters`` rounds (fewer once nothing changes) of: count aligned symbol pairs over the corpus
    (each distinct pair weighted by its frequency), price every symbol pair by
    its count (prior 0.1), re-align every distinct pair at those prices.
    The weighted pair table and each round's alignment are checkpointed to the
    shared folder, so a round never re-reads the corpus and a lost executor
    resumes from the last round. Output: source, target, aligned_source,
    aligned_target, cost, n."""
    for _, _, aligned in corpus_rounds(pairs, source, target, iters, checkpoint):
        pass
    return aligned


def column_prices(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """source, target and ``price``: the sum of what the columns of their alignment
    cost at the prices given by ``counts`` (no columns: 0). The columns meet the
    prices in a join on their symbols, whose table has the alphabet's size."""
    cost, tot = costs_from_counts(counts)
    z = F.arrays_zip(chars(F.col("aligned_source")).alias("x"), chars(F.col("aligned_target")).alias("y"))
    seen = aligned.select("source", "target", F.explode_outer(z).alias("p")).groupBy(
        "source", "target", F.col("p.x").alias("x"), F.col("p.y").alias("y")).agg(F.count(F.lit(1)).alias("k"))
    price = F.when(F.col("x").isNull(), 0.0).otherwise(F.coalesce("c", tot.select("default").scalar()))
    return seen.join(cost, ["x", "y"], "left").groupBy("source", "target").agg(F.sum(price * F.col("k")).alias("price"))


def template(aligned_source: Column, aligned_target: Column) -> Column:
    """M4: edit template from an alignment: an inserted or changed character is
    a literal, an equal character is the index of the source character it
    copies, a deleted source character moves the index on."""
    al, aw = chars(aligned_source), chars(aligned_target)

    def elem(c, i):
        w = F.get(aw, i)
        idx = F.size(F.filter(F.slice(al, 1, i), lambda s: s != GAP)).cast("string")
        return (F.when(c == GAP, w).when(w == GAP, F.lit(None).cast("string"))
                 .when(c == w, idx).otherwise(w))
    return F.filter(F.transform(al, elem), lambda e: e.isNotNull())


def actions_frame(aligned: DataFrame) -> DataFrame:
    """M5 over an alignment table: adds ``actions`` (array of strings)."""
    return aligned.select("source", "target", "aligned_source", "aligned_target", "cost",
                          actions(F.col("aligned_source"), F.col("aligned_target")).alias("actions"))


def alignment_report(aligned: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Index, aligned source, aligned target (ordered by the given keys)."""
    order = order or ["source", "target"]
    from .windows import range_chunks, running_number
    r = running_number(range_chunks(aligned, order), [], order, "index", chunk=F.col("_range"))
    return r.select("index", "aligned_source", "aligned_target")
