"""Lemmatisation baselines and evaluators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .joins import mark_seen, predict_mfl
from .scoring import DIGITS, collapse, ratio, score, score_collapsed


def eval_copy(words: DataFrame, by: Sequence[str] = ("split",)) -> DataFrame:
    """A3: predict lemma = lower(form); accuracy and mean distance over wrong rows."""
    return score(words, by, "lemma", "lform")


def fit_mfl(train: DataFrame) -> DataFrame:
    """A4: per lower-cased form the lemma seen most often; ties go to the lemma
    seen first (smallest (doc_id, sent_id, tok_id)).

    Both aggregations have a map-side partial step (sort-based, as their buffers
    hold structs), so a hot form never gathers its rows in one task; no window
    is needed."""
    c = train.groupBy("lform", "lemma").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.struct("doc_id", "sent_id", "tok_id")).alias("first"))
    key = F.struct((-F.col("n")).alias("negn"), F.col("first").alias("first"))
    return c.groupBy("lform").agg(F.min_by("lemma", key).alias("mfl_lemma"),
                                  F.sum("n").cast("bigint").alias("n_form"))


def token_counts(words: DataFrame, splits: Sequence[str], by: Sequence[str] = (), train: str = "train",
                 materialised: bool = True) -> DataFrame:
    """One aggregate over the words: per (by, lform, lemma) the count in each
    split (``n_<split>``) and the first training position.

    Every consumer (the model, the held-out pairs, the tag universe) reads
    this one table: the corpus is scanned and tokenised once."""
    aggs = [F.sum(F.when(F.col("split") == s, 1).otherwise(0)).alias(f"n_{s}") for s in splits]
    aggs.append(F.min(F.when(F.col("split") == train, F.struct("doc_id", "sent_id", "tok_id"))).alias("first_train"))
    counts = words.groupBy(*by, "lform", "lemma").agg(*aggs)
    # Consumers prune different columns, so their plans would not share this
    # aggregate's shuffle; the table is small (distinct forms x lemmas), so it
    # is written once to the checkpoint folder and every branch reads it.
    return materialise(counts) if materialised else counts


def fit_mfl_counts(counts: DataFrame, n_col: str = "n_train", first_col: str = "first_train") -> DataFrame:
    """A4 from ``token_counts``: same result as ``fit_mfl`` on the training rows."""
    c = counts.filter(F.col(n_col) > 0).groupBy("lform", "lemma").agg(
        F.sum(n_col).alias("n"), F.min(first_col).alias("first"))
    key = F.struct((-F.col("n")).alias("negn"), F.col("first").alias("first"))
    return c.groupBy("lform").agg(F.min_by("lemma", key).alias("mfl_lemma"),
                                  F.sum("n").cast("bigint").alias("n_form"))


def held_out_pairs(counts: DataFrame, split: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, lform, lemma, n) of one split from ``token_counts``."""
    c = F.col(f"n_{split}")
    return counts.filter(c > 0).select(*by, "lform", "lemma", c.cast("bigint").alias("n"))


def eval_mfl(model: DataFrame, test: DataFrame, by: Sequence[str] = ("split",)) -> DataFrame:
    """A5: J1 on a held-out table, then the A3 scorer.

    The test side is collapsed to distinct (by, form, lemma) before the join."""
    pairs = collapse(test, by, "lform", "lemma")
    pred = predict_mfl(model, pairs)
    return score_collapsed(pred.select(*by, "lemma", "plemma", "n"), by, "lemma", "plemma")


def eval_pred(merged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy and wrong-only distance of merged predictions (gold ``lemma`` vs ``plemma``)."""
    return score(merged, by, "lemma", "plemma")


def eval_by_pos(words: DataFrame, train: str = "train", test: str = "test", pos: str = "xpostag") -> DataFrame:
    """Accuracy and wrong-only distance by POS x seen/unseen, with a ``TOTAL``
    row (``rollup``) and the overall accuracy/distance; empty cells are null (N/A).

    ``words`` holds both splits (column ``split``). Predictions come from the
    most-frequent-lemma model fitted on ``train``; since the model has one row
    per training form, the same join marks a test form as seen (J3). Model,
    test pairs and the tag universe all come from one ``token_counts`` pass."""
    counts = token_counts(words, (train, test), by=(pos,), train=train)
    model = fit_mfl_counts(counts, f"n_{train}")
    pairs = held_out_pairs(counts, test, by=(pos,))
    pred = predict_mfl(model, pairs)
    # POS tags that occur only in training still get a row (all N/A).
    tags = counts.filter((F.col(f"n_{train}") + F.col(f"n_{test}")) > 0).select(pos).distinct()
    return _pos_table(pred, tags, pos)


def eval_predictions_by_pos(test: DataFrame, pred: DataFrame, train: DataFrame, keys: Sequence[str],
                            pos: str = "xpostag", form: str = "lform") -> DataFrame:
    """A7 over a prediction table: ``test`` (gold words: keys, ``form``, ``lemma``,
    ``pos``), ``pred`` (keys, ``plemma``) and the training words that decide
    seen/unseen. Rows pair on ``keys`` (a position, see ``joins.by_position``, where
    the tables share only their order); test words without a prediction count as
    predicted by nothing, so as wrong. Output as ``eval_by_pos``."""
    p = pred.select(*keys, F.col("plemma"))
    rows = test.select(*keys, form, "lemma", pos).join(p, list(keys), "left").withColumn("plemma", F.coalesce("plemma", F.lit("")))
    pairs = rows.groupBy(pos, form, "lemma", "plemma").agg(F.count(F.lit(1)).alias("n"))
    tags = train.select(pos).unionAll(test.select(pos)).distinct()
    return _pos_table(mark_seen(pairs, train, form), tags, pos)


def _pos_table(pred: DataFrame, tags: DataFrame, pos: str) -> DataFrame:
    """Rows (pos, lemma, plemma, seen, n) -> the table by POS x seen/unseen; ``tags``
    are the POS that get a row besides ``TOTAL``."""
    ok = F.col("lemma") == F.col("plemma")
    dist = F.levenshtein(F.col("plemma"), F.col("lemma"))
    n = F.col("n")

    def cell(seen: bool):
        s = F.col("seen") if seen else ~F.col("seen")
        tag = "seen" if seen else "unseen"
        return [F.sum(F.when(s, n).otherwise(0)).alias(f"{tag}_n"),
                F.sum(F.when(s & ok, n).otherwise(0)).alias(f"{tag}_right"),
                F.sum(F.when(s & ~ok, n).otherwise(0)).alias(f"{tag}_wrong"),
                F.sum(F.when(s & ~ok, dist * n).otherwise(0)).alias(f"{tag}_dist")]

    agg = pred.rollup(pos).agg(*cell(True), *cell(False), F.grouping(pos).alias("_g"))
    agg = agg.withColumn(pos, F.when(F.col("_g") == 1, F.lit("TOTAL")).otherwise(F.col(pos)))
    universe = tags.union(tags.sparkSession.range(1).select(F.lit("TOTAL").alias(pos)))
    j = universe.join(agg, pos, "left").na.fill(0, subset=[c for c in agg.columns if c not in (pos, "_g")])
    c = F.col
    return j.select(
        c(pos),
        c("seen_n").cast("bigint").alias("seen_n"),
        ratio(c("seen_right"), c("seen_n")).alias("seen_accuracy"),
        ratio(c("seen_dist"), c("seen_wrong")).alias("seen_distance"),
        c("unseen_n").cast("bigint").alias("unseen_n"),
        ratio(c("unseen_right"), c("unseen_n")).alias("unseen_accuracy"),
        ratio(c("unseen_dist"), c("unseen_wrong")).alias("unseen_distance"),
        ratio(c("seen_right") + c("unseen_right"), c("seen_n") + c("unseen_n")).alias("accuracy"),
        ratio(c("seen_dist") + c("unseen_dist"), c("seen_wrong") + c("unseen_wrong")).alias("distance"))


# ------------------------------------------------------------------ ROUGE

def chars(s: Column) -> Column:
    return F.when(F.length(s) > 0, F.split(s, "")).otherwise(F.array().cast("array<string>"))


def ngrams(s: Column, k: int) -> Column:
    """Distinct character k-grams of s."""
    if k == 1:
        return F.array_distinct(chars(s))
    return F.when(F.length(s) >= k, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.length(s) - (k - 1)), lambda i: F.substring(s, i, k)))
    ).otherwise(F.array().cast("array<string>"))


#: Bits of a word of the row state: a sum of two words and a carry fits a long.
WORD = 62
_FULL = (1 << WORD) - 1


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _match_bits(letters: Column, c: Column) -> Column:
    """Bits of the places where ``letters`` (at most a word of them) are ``c``."""
    places = F.lit([1 << i for i in range(WORD)])
    return F.aggregate(F.transform(letters, lambda x, i: F.when(x == c, places[i]).otherwise(0)), F.lit(0).cast("long"), lambda s, x: s + x)


def _unmatched(v: Column, letters: Column) -> Column:
    """How many of the first ``size(letters)`` bits are set: places outside the LCS."""
    return F.bit_count(v.bitwiseAND(F.lit([(1 << i) - 1 for i in range(WORD + 1)])[F.size(letters)]))


def _lcs_short(x: Column, common: Column, y: Column) -> Column:
    """``x`` of at most a word: the row is one long. A letter c turns it into
    (V + (V & M)) | (V - (V & M)), M the places of c; its unset bits count the LCS."""
    def fold(masks):
        def step(v, c):
            return _let(v.bitwiseAND(masks[F.array_position(common, c).cast("int") - 1]), lambda u:
                        (v + u).bitwiseOR(v - u).bitwiseAND(F.lit(_FULL)))
        return F.aggregate(y, F.lit(_FULL), step, lambda v: F.size(x) - _unmatched(v, x))
    return _let(F.transform(common, lambda c: _match_bits(x, c)), fold)


def _lcs_long(x: Column, common: Column, y: Column) -> Column:
    """The same with an array of words, the carry going from word to word."""
    state = "struct<carry:long,out:array<long>>"

    def folded(words):
        def fold(masks):
            def step(v, c):
                def word(s, k):
                    m = masks[F.array_position(common, c).cast("int") - 1][k]
                    return _let(v[k].bitwiseAND(m), lambda u: _let(v[k] + u + s["carry"], lambda t: F.struct(
                        F.shiftright(t, WORD).alias("carry"),
                        F.concat(s["out"], F.array(t.bitwiseAND(F.lit(_FULL)).bitwiseOR(v[k] - u))).alias("out")).cast(state)))
                begin = F.struct(F.lit(0).alias("carry"), F.array().cast("array<long>").alias("out")).cast(state)
                return F.aggregate(F.sequence(F.lit(0), F.size(v) - 1), begin, word, lambda s: s["out"])

            def total(v):
                left = F.zip_with(v, words, _unmatched)
                return F.size(x) - F.aggregate(left, F.lit(0), lambda s, n: s + n)
            return F.aggregate(y, F.transform(words, lambda w: F.lit(_FULL)), step, total)
        return _let(F.transform(common, lambda c: F.transform(words, lambda w: _match_bits(w, c))), fold)
    cuts = F.sequence(F.lit(0), F.floor((F.size(x) - 1) / WORD).cast("int"))
    return _let(F.transform(cuts, lambda k: F.slice(x, k * WORD + 1, WORD)), folded)


def lcs_length(a: Column, b: Column) -> Column:
    """Character LCS length (null counts as empty). Where one string begins with the
    other, as most wrong lemmas do, it is the shorter one; else a bit-parallel fold, one step for
    each letter of ``b`` that ``a`` has, whose row state holds a bit for each letter of
    ``a``. All of it stays in the JVM."""
    def of_chars(x, y):
        def of_common(common):
            kept = F.filter(y, lambda c: F.array_contains(common, c))
            return (F.when(F.size(common) == 0, F.lit(0)).when(F.size(x) <= WORD, _lcs_short(x, common, kept))
                    .otherwise(_lcs_long(x, common, kept)))
        return _let(F.array_intersect(x, y), of_common)
    a, b = (F.coalesce(s, F.lit("")) for s in (a, b))
    fold = _let(chars(a), lambda x: _let(chars(b), lambda y: of_chars(x, y)))
    return F.when(a.startswith(b) | b.startswith(a), F.least(F.length(a), F.length(b))).otherwise(fold).cast("int")


def _rpf(overlap: Column, n_ref: Column, n_hyp: Column, tag: str) -> list[Column]:
    r = F.when(n_ref > 0, overlap / n_ref).otherwise(F.lit(0.0))
    p = F.when(n_hyp > 0, overlap / n_hyp).otherwise(F.lit(0.0))
    f = F.when(r + p > 0, 2 * r * p / (r + p)).otherwise(F.lit(0.0))
    return [r.alias(f"{tag}_r"), p.alias(f"{tag}_p"), f.alias(f"{tag}_f")]


def rouge(pairs: DataFrame, gold: str = "lemma", pred: str = "plemma", by: Sequence[str] = (),
          weight: str | None = None) -> DataFrame:
    """ROUGE-1/2 on distinct character n-gram sets and ROUGE-L on the character
    LCS (recall, precision, F1), averaged over rows. Computed once per distinct
    (gold, pred) pair and weighted by its count."""
    c = collapse(pairs, by, gold, pred, weight)
    g, h = F.col(gold), F.col(pred)
    # staged: grams, then their overlaps, then the ratios, each computed once and used by name
    grams = c.select(*by, "n", g.alias("_g"), h.alias("_h"), *[
        ngrams(x, k).alias(f"_{tag}{k}") for k in (1, 2) for tag, x in (("g", g), ("h", h))])
    sizes = grams.select(*by, "n", F.length("_g").alias("_gl"), F.length("_h").alias("_hl"), lcs_length(F.col("_h"), F.col("_g")).alias("_l"), *[
        x for k in (1, 2) for x in (F.size(F.array_intersect(f"_g{k}", f"_h{k}")).alias(f"_o{k}"),
                                    F.size(f"_g{k}").alias(f"_gs{k}"), F.size(f"_h{k}").alias(f"_hs{k}"))])
    cols = []
    for k in (1, 2):
        cols += _rpf(F.col(f"_o{k}").cast("double"), F.col(f"_gs{k}"), F.col(f"_hs{k}"), f"rouge{k}")
    cols += _rpf(F.col("_l").cast("double"), F.col("_gl"), F.col("_hl"), "rougel")
    per = sizes.select(*by, "n", *cols)
    metrics = [x for x in per.columns if x.startswith("rouge")]
    return per.groupBy(*by).agg(
        F.sum("n").cast("bigint").alias("n_rows"),
        *[F.round(F.sum(F.col(m) * F.col("n")) / F.sum("n"), DIGITS).alias(m) for m in metrics])


# ------------------------------------------------- clusters, marks, error lists

def micro_macro(scored: DataFrame, key: str, ok: str = "ok", weight: str | None = None) -> DataFrame:
    """Accuracy per cluster, then the macro mean and the example-weighted micro mean.
    ``weight`` names a row-multiplicity column of pre-collapsed input."""
    w = F.col(weight) if weight else F.lit(1)
    per = scored.groupBy(key).agg(F.sum(w).alias("n"),
                                  F.sum(F.col(ok).cast("int") * w).alias("right"))
    per = per.withColumn("acc", F.col("right") / F.col("n"))
    return per.agg(F.count(F.lit(1)).cast("bigint").alias("n_clusters"),
                   F.sum("n").cast("bigint").alias("n_rows"),
                   F.round(F.avg("acc"), DIGITS).alias("macro_accuracy"),
                   F.round(F.sum(F.col("n") * F.col("acc")) / F.sum("n"), DIGITS).alias("micro_accuracy"))


def mark(pred: Column, gold: Column, step: str = "^") -> Column:
    """``V`` when the prediction (step symbols removed) equals the gold word, else ``X``."""
    return F.when(F.translate(pred, step, "") == gold, F.lit("V")).otherwise(F.lit("X"))


def error_report(gold: DataFrame, pred: DataFrame, keys: Sequence[str], morph: str = "morph") -> DataFrame:
    """The wrong rows grouped by morph string, one row per distinct
    (morph, source, gold, prediction) with its count and the morph's
    error total. The lemmas of both sides must agree (``assert_true``).

    Rows are counted, never collected into one list per morph string, so a
    morph string holding most of the errors still spreads over tasks."""
    g = gold.select(*keys, morph, F.col("lemma").alias("_gl"), F.col("word").alias("gold"))
    p = pred.select(*keys, F.col("lemma").alias("_pl"), F.col("word").alias("prediction"))
    j = g.join(p, list(keys), "inner")
    j = j.withColumn("_chk", F.assert_true(F.col("_gl").eqNullSafe(F.col("_pl")), F.lit("lemma mismatch")))
    wrong = j.filter(F.col("_chk").isNull() & ~F.col("gold").eqNullSafe(F.col("prediction")))
    rows = wrong.groupBy(morph, F.col("_gl").alias("source"), "gold", "prediction").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"))
    totals = rows.groupBy(morph).agg(F.sum("n").cast("bigint").alias("morph_errors"))
    return rows.join(totals, morph, "inner")


def compare_errors(a: DataFrame, b: DataFrame, cols: Sequence[str], buckets: Sequence[str],
                   morph: str = "morph") -> DataFrame:
    """Compare two error lists (one row per error, duplicates allowed).

    ``both`` = distinct errors in both; ``only_first`` / ``only_second`` keep
    duplicates (anti join against the other side's distinct rows). Each row is
    counted under ``ALL`` and under every bucket whose text occurs in its morph
    string (a row may fall in several). Output (kind, bucket, n)."""
    # distinct errors with their counts, written once: each list is made once, not for every set
    a, b = (materialise(x.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))) for x in (a, b))
    both = a.select(*cols).intersect(b.select(*cols)).select(*cols, F.lit(1).cast("bigint").alias("_n"), F.lit("both").alias("kind"))
    only_a = a.join(b.select(*cols), list(cols), "left_anti").withColumn("kind", F.lit("only_first"))
    only_b = b.join(a.select(*cols), list(cols), "left_anti").withColumn("kind", F.lit("only_second"))
    allrows = both.unionByName(only_a).unionByName(only_b)
    bk = F.array(*[F.lit(x) for x in buckets])
    tagged = allrows.select("kind", "_n", F.explode(F.concat(
        F.array(F.lit("ALL")), F.filter(bk, lambda x: F.instr(F.col(morph), x) > 0))).alias("bucket"))
    return tagged.groupBy("kind", "bucket").agg(F.sum("_n").cast("bigint").alias("n"))
