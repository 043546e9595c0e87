"""Joins of the evaluation and data-preparation family.

No join here forces a broadcast: the small side of every join is derived from
the data (distinct forms, a model with one row per form), so its size is not
bounded up front. AQE turns a join into a broadcast at runtime when the
measured side is under ``spark.sql.autoBroadcastJoinThreshold`` and splits
skewed partitions otherwise. The large sides are collapsed to distinct keys
before they reach a join wherever the operator allows it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .filters import drop_punct, truncate
from .runs import join_runs


def predict_mfl(model: DataFrame, df: DataFrame, form: str = "lform", out: str = "plemma") -> DataFrame:
    """lemma = most frequent training lemma of the form, else the form itself.

    ``model`` has one row per form: (lform, mfl_lemma, ...)."""
    m = model.select(F.col("lform").alias("_mf"), F.col("mfl_lemma").alias("_ml"))
    j = df.join(m, df[form] == m["_mf"], "left")
    return j.withColumn(out, F.coalesce(F.col("_ml"), F.col(form))) \
            .withColumn("seen", F.col("_mf").isNotNull()).drop("_mf", "_ml")


def merge_gold(gold: DataFrame, pred: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pair prediction rows with gold rows on their position key.

    Gold punctuation is dropped; gold lemma/pos/feats/misc overwrite the
    prediction's own columns (the prediction keeps form, plemma, ppos, pfeats)."""
    own = {"lemma": "_gl", "xpostag": "_gp"} | {c: f"_g{c[0]}" for c in ("feats", "misc") if c in gold.columns}
    g = drop_punct(gold).select(*keys, *[F.col(c).alias(a) for c, a in own.items()])
    p = pred.drop(*[c for c in ("lemma", "pos", "feats", "misc") if c in pred.columns])
    j = join_runs(p, g, keys)
    def from_gold(c):
        return F.col(own[c]) if c in own else F.lit(None).cast("string")
    return j.select(*[F.col(c) for c in p.columns], from_gold("lemma").alias("lemma"), from_gold("xpostag").alias("pos"),
                    from_gold("feats").alias("feats"), from_gold("misc").alias("misc"))


def by_position(df: DataFrame, order: Sequence[str], out: str = "position", chunk=None) -> DataFrame:
    """The running position (from 1) of each row in ``order``, the key of tables
    that only share their order: ``merge_gold`` on it then pairs the n-th word
    with the n-th prediction."""
    from .windows import running_number
    return running_number(df, [], list(order), out, chunk=chunk)


def merge_audit(gold: DataFrame, pred: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts of paired, gold-only and prediction-only rows (a positional zip drops them silently)."""
    g = drop_punct(gold).select(*keys).withColumn("_g", F.lit(1))
    p = pred.select(*keys).withColumn("_p", F.lit(1))
    j = g.join(p, list(keys), "full_outer")
    return j.agg(
        F.sum(F.when(F.col("_g").isNotNull() & F.col("_p").isNotNull(), 1).otherwise(0)).cast("bigint").alias("paired"),
        F.sum(F.when(F.col("_p").isNull(), 1).otherwise(0)).cast("bigint").alias("gold_only"),
        F.sum(F.when(F.col("_g").isNull(), 1).otherwise(0)).cast("bigint").alias("pred_only"))


def mark_seen(test: DataFrame, train: DataFrame, col: str = "lform") -> DataFrame:
    """Flag test rows whose form occurs in training (left join on distinct forms)."""
    forms = train.select(F.col(col).alias("_sf")).distinct()
    j = test.join(forms, test[col] == forms["_sf"], "left")
    return j.withColumn("seen", F.col("_sf").isNotNull()).drop("_sf")


def noisy_merge(pred: DataFrame, lem: DataFrame, keys: Sequence[str], seg: str = "pseg",
                width: int | None = None) -> DataFrame:
    """J4 + P7: replace the gold segmentation of each lemma-task row by the predicted
    one (cut to ``width`` characters where given). Both sides must pair one to one;
    ``assert_true`` fails the job otherwise."""
    p = pred.select(*keys, (F.col(seg) if width is None else truncate(F.col(seg), width)).alias("_ps"), F.lit(1).alias("_pp"))
    l = lem.withColumn("_lp", F.lit(1))
    j = l.join(p, list(keys), "full_outer")
    j = j.withColumn("_chk", F.assert_true(F.col("_pp").isNotNull() & F.col("_lp").isNotNull(),
                                           F.lit("noisy merge: row counts differ")))
    out = [c for c in lem.columns if c not in keys]
    return j.select(*keys, *[F.when(F.col("_chk").isNull(), F.col("_ps")).alias("base_forms") if c == "base_forms"
                             else F.col(c) for c in out])


def match_inflections(base: DataFrame, infl: DataFrame, n: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Base forms (base, base_pos) in listing order, optionally the first ``n``,
    joined with inflections (base, feats, inflected); also the base forms with no match."""
    b = base if n is None else base.filter(F.col("base_pos") <= n)
    matched = b.join(infl, "base", "inner")
    missing = b.join(infl.select("base").distinct(), "base", "left_anti")
    return matched, missing


def attach_predictions(test: DataFrame, pred: DataFrame, keys: Sequence[str] = ("lemma", "morph"),
                       pos_col: str = "pred_pos") -> DataFrame:
    """Attach predictions by (lemma, morph string); a dictionary keeps the last
    duplicate, so predictions are first reduced to the one with the largest
    position; rows without a prediction get ``ERROR``."""
    last = pred.groupBy(*keys).agg(F.max_by("prediction", pos_col).alias("_pred"))
    j = test.join(last, list(keys), "left")
    return j.withColumn("prediction", F.coalesce(F.col("_pred"), F.lit("ERROR"))).drop("_pred")


def check_nbest(nbest: DataFrame, greedy: DataFrame, k: int) -> DataFrame:
    """Candidate 0 of n-best group ``pos // k`` must equal greedy line ``pos // k``.

    nbest(pos, line), greedy(pos, line) -> the groups where they differ."""
    first = nbest.filter(F.col("pos") % k == 0).select(
        F.floor(F.col("pos") / k).cast("bigint").alias("grp"), F.col("line").alias("nbest_line"))
    g = greedy.select(F.col("pos").cast("bigint").alias("grp"), F.col("line").alias("greedy_line"))
    j = first.join(g, "grp", "full_outer")
    return j.filter(~F.col("nbest_line").eqNullSafe(F.col("greedy_line")))
