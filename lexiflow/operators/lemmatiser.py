"""Table lemmatisers and their checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import instantiate
from ..session import materialise
from .align import align_med, template


def vote(preds: DataFrame, key: Sequence[str], pred: str = "prediction") -> DataFrame:
    """M6: ensemble vote per key: most votes wins; when the winner has a single
    vote the shortest prediction wins; remaining ties by prediction text.
    The window runs over the few candidates of one key."""
    v = preds.groupBy(*key, pred).agg(F.count(F.lit(1)).alias("votes"))
    w = Window.partitionBy(*key).orderBy(F.col("votes").desc(),
                                         F.when(F.col("votes") == 1, F.length(pred)).otherwise(0), F.col(pred))
    return v.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1).drop("_r")


def vote_row(preds: Sequence[Column]) -> Column:
    """M6 where a row holds its candidates side by side: a struct (prediction,
    votes) by the rule of ``vote``, without a shuffle."""
    arr = F.array(*preds)
    ranked = F.transform(F.array_distinct(arr), lambda p: F.struct(
        (-F.size(F.filter(arr, lambda x: x.eqNullSafe(p)))).alias("less"), p.alias("prediction")))
    ranked = F.transform(ranked, lambda r: F.struct(
        r["less"].alias("less"), F.when(r["less"] == -1, F.length(r["prediction"])).otherwise(0).alias("long"), r["prediction"].alias("prediction")))
    best = F.array_min(ranked)
    return F.struct(best["prediction"].alias("prediction"), (-best["less"]).cast("bigint").alias("votes"))


def pair_templates(pairs: DataFrame, source: str, target: str) -> DataFrame:
    """Templates of the distinct (source, target) pairs (M2 alignment + M4)."""
    al = align_med(pairs, source, target)
    return al.select("source", "target", template(F.col("aligned_source"), F.col("aligned_target")).alias("template"))


def fit_templates(train: DataFrame, source: str, target: str, pos: str, suffix_len: int = 2) -> tuple[DataFrame, DataFrame]:
    """M7 fit: per (pos, last ``suffix_len`` characters of the source) the most
    frequent template, and per pos alone the back-off template. Ties go to the
    smaller template text. Pairs are collapsed, then aligned once, and both models
    come from one aggregate; aggregates have a map-side step, so no group is
    gathered in one task."""
    counted = train.groupBy(F.col(pos).alias("pos"), F.col(source).alias("source"), F.col(target).alias("target")).agg(
        F.count(F.lit(1)).alias("n"))
    # pairs are collapsed before they meet their templates
    t = counted.join(pair_templates(counted, "source", "target"), ["source", "target"]) \
        .withColumn("suffix", F.substring("source", -suffix_len, suffix_len)) \
        .withColumn("tkey", F.array_join("template", "\u0001"))
    counts = materialise(t.groupBy("pos", "suffix", "tkey").agg(F.sum("n").alias("n"), F.first("template").alias("template")))

    def best(keys):
        c = counts.groupBy(*keys, "tkey").agg(F.sum("n").alias("n"), F.first("template").alias("template"))
        # most frequent first, then the smaller template text
        return c.groupBy(*keys).agg(F.min_by("template", F.struct((-F.col("n")).alias("negn"), F.col("tkey")))
                                    .alias("template"))
    by_suffix = best(["pos", "suffix"])
    by_pos = best(["pos"])
    return by_suffix, by_pos


def apply_templates(test: DataFrame, source: str, pos: str, by_suffix: DataFrame, by_pos: DataFrame,
                    suffix_len: int = 2, out: str = "prediction") -> DataFrame:
    """M7 apply: look up (pos, suffix), back off to pos, else copy; instantiate."""
    t = test.withColumn("_suffix", F.substring(source, -suffix_len, suffix_len))
    s = by_suffix.select(F.col("pos").alias("_p1"), F.col("suffix").alias("_s1"), F.col("template").alias("_t1"))
    p = by_pos.select(F.col("pos").alias("_p2"), F.col("template").alias("_t2"))
    j = t.join(s, (t[pos] == s["_p1"]) & (t["_suffix"] == s["_s1"]), "left") \
         .join(p, F.col(pos) == F.col("_p2"), "left")
    tpl = F.coalesce(F.col("_t1"), F.col("_t2"))
    pred = F.when(tpl.isNotNull(), instantiate(tpl, F.col(source))).otherwise(F.col(source))
    return j.withColumn(out, pred).drop("_suffix", "_p1", "_s1", "_t1", "_p2", "_t2")


def literal_index(templates: DataFrame, test: DataFrame) -> DataFrame:
    """J7's candidates: ``template`` (array) rows against distinct ``source``,
    ``target`` pairs.

    For a source of a given length a template fixes the target's length and the
    letters at some places. It is filed under the one that fewest pairs of these two
    lengths have (ties: the first place), counted beforehand; a template that copies
    everything is filed under the lengths alone. A pair looks up its own letters at
    all places. So every candidate agrees with the pair in its rarest fixed letter, and
    a template whose letter no pair has is dropped. Returns ``template``, ``source``,
    ``target``."""
    spots = F.transform(F.split("target", ""), lambda c, i: F.struct((i + 1).alias("at"), c.alias("letter")))
    no_spot = F.array(F.struct(F.lit(0).alias("at"), F.lit("").alias("letter")))
    probes = test.select("source", "target", F.length("source").alias("len"), F.length("target").alias("out"),
                         F.explode(F.concat(no_spot, F.when(F.length("target") > 0, spots).otherwise(F.array()))).alias("s")).select(
        "source", "target", "len", "out", "s.at", "s.letter")
    common = materialise(probes.groupBy("len", "out", "at", "letter").agg(F.count(F.lit(1)).alias("pairs")))
    # as many lengths as words have: one array beside each template
    every = test.agg(F.collect_set(F.length("source"))).scalar()

    def is_copy(x):
        return x.rlike("^[0-9]+$")

    t = templates.select("template", F.explode(every).alias("len"))
    t = t.withColumn("parts", F.filter("template", lambda x: ~is_copy(x) | (x.try_cast("int") < F.col("len")))).withColumn(
        "out", F.size("parts"))
    fixed = F.filter(F.transform("parts", lambda x, i: F.struct((i + 1).alias("at"), x.alias("letter"))), lambda x: ~is_copy(x["letter"]))
    t = t.withColumn("fixed", fixed).select("template", "len", "out", F.size("fixed").alias("n"), F.explode(
        F.when(F.size("fixed") > 0, F.col("fixed")).otherwise(no_spot)).alias("s")).select("template", "len", "out", "n", "s.at", "s.letter")
    filed = t.join(common, ["len", "out", "at", "letter"]).groupBy("template", "len", "out", "n").agg(
        F.min(F.struct("pairs", "at", "letter")).alias("s"), F.count(F.lit(1)).alias("met")).filter(
        F.col("met") == F.greatest(F.col("n"), F.lit(1)))  # no pair has one of the letters: no pair is made
    filed = filed.select("template", "len", "out", "s.at", "s.letter")
    return probes.join(filed, ["len", "out", "at", "letter"]).select("template", "source", "target")


def template_coverage(train: DataFrame, test: DataFrame, source: str, target: str) -> DataFrame:
    """A test pair counts as covered when some training template makes its
    target from its source. Distinct pairs meet the templates of their rarest fixed
    letter (``literal_index``); ``instantiate`` then decides. Output one row: covered,
    total, percent (over test rows)."""
    te = test.groupBy(F.col(source).alias("source"), F.col(target).alias("target")).agg(F.count(F.lit(1)).alias("n"))
    te = materialise(te)
    templates = pair_templates(train, source, target).select("template").distinct()
    return covered_share(te, templates)


def covered_share(te: DataFrame, templates: DataFrame) -> DataFrame:
    """J7 for given templates: distinct pairs with their count ``n``."""
    hits = literal_index(templates, te).filter(
        instantiate(F.col("template"), F.col("source")) == F.col("target")).select("source", "target").distinct()
    j = te.join(hits.withColumn("_hit", F.lit(1)), ["source", "target"], "left")
    return j.agg(F.coalesce(F.sum(F.when(F.col("_hit").isNotNull(), F.col("n"))), F.lit(0)).cast("bigint").alias("covered"),
                 F.sum("n").cast("bigint").alias("total")) \
            .withColumn("percent", F.round(F.col("covered") * 100.0 / F.col("total"), 6))


def check_solution(solution: DataFrame, inputs: DataFrame, nbest: DataFrame, mismatches: DataFrame,
                   k: int, fields: int = 3) -> DataFrame:
    """M9: sanity checks of a prediction run, as one row of counts: lines with
    the expected field count, solution rows vs input rows, n-best rows vs
    k x input, non-empty first candidates, n-best/greedy disagreements (J8),
    and the number of checks passed."""
    s = solution.agg(F.count(F.lit(1)).alias("n_solution"),
                     F.sum((F.size(F.split("line", "\t")) == fields).cast("int")).alias("n_fields_ok"))
    nb = nbest.agg(F.count(F.lit(1)).alias("n_nbest"),
                   F.sum(((F.col("pos") % k == 0) & (F.length("line") > 0)).cast("int")).alias("n_first_nonempty"))
    # every check is one number: the other totals ride along as scalar subqueries
    j = s.select("n_solution", "n_fields_ok",
                 inputs.agg(F.count(F.lit(1))).scalar().alias("n_input"),
                 nb.select("n_nbest").scalar().alias("n_nbest"),
                 nb.select("n_first_nonempty").scalar().alias("n_first_nonempty"),
                 mismatches.agg(F.count(F.lit(1))).scalar().alias("n_mismatch"))
    checks = [F.col("n_fields_ok") == F.col("n_solution"), F.col("n_solution") == F.col("n_input"),
              F.col("n_nbest") == F.col("n_input") * k, F.col("n_first_nonempty") == F.col("n_input"),
              F.col("n_mismatch") == 0]
    passed = sum(c.cast("int") for c in checks)
    return j.select(*[F.col(c).cast("bigint").alias(c) for c in
                      ("n_input", "n_solution", "n_fields_ok", "n_nbest", "n_first_nonempty", "n_mismatch")],
                    passed.cast("bigint").alias("passed"))
