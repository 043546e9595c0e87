"""Feature bundles: clusters, morph types, change profiles, vocabulary and
encoding (A10-A12, A16, A18, T11)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import MISSING, chars, morph_string, parse_feats
from ..session import materialise
from .scoring import DIGITS
from .windows import range_chunks, running_number

NULL_VALUE = "NULL"


def feature_types(ex: DataFrame, feats: str = "feats") -> DataFrame:
    """Known feature names as one row ``keys: array<string>`` (sorted). The
    result has one row whatever the data size; consumers attach it as a
    scalar subquery (``DataFrame.scalar``), not with a join."""
    # bundles are far fewer than rows: each is taken apart once a task
    d = ex.select(F.col(feats).alias("_f")).distinct()
    k = d.select(F.explode(F.map_keys(parse_feats(F.col("_f")))).alias("k")).distinct()
    return k.agg(F.array_sort(F.collect_list("k")).alias("keys"))


def with_morph(ex: DataFrame, keys: DataFrame, feats: str = "feats", out: str = "morph") -> DataFrame:
    """T7 applied to every row, with the feature names inferred from ``keys``."""
    # bind the scalar subquery to a column first: lambdas may not hold subqueries
    j = ex.withColumn("_keys", keys.select("keys").scalar())
    return j.withColumn(out, morph_string(parse_feats(F.col(feats)), F.col("_keys"))).drop("_keys")


def cluster_sizes(ex: DataFrame, key: str = "pos", feats: str = "feats", single: bool = False) -> DataFrame:
    """A10: examples per ``pos=X`` cluster (``pos=%`` when missing) plus an
    ``ALL`` total row (``rollup``); ``single`` puts everything in one cluster ``all``."""
    if single:
        c = F.lit("all")
    else:
        c = F.concat(F.lit(f"{key}="), F.coalesce(F.try_element_at(parse_feats(F.col(feats)), F.lit(key)), F.lit(MISSING)))
    g = ex.select(c.alias("cluster")).rollup("cluster").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), F.grouping("cluster").alias("_g"))
    return g.select(F.when(F.col("_g") == 1, F.lit("ALL")).otherwise(F.col("cluster")).alias("cluster"), "n")


def morph_type_stats(ex: DataFrame, feats: str = "feats") -> DataFrame:
    """Number of morph types (canonical morph strings), mean examples per
    type (Q5: not the mean key length), number of feature types."""
    # bundles with their counts are written once; names, morph strings and totals come from them
    d = materialise(ex.groupBy(feats).agg(F.count(F.lit(1)).alias("n")))
    keys = feature_types(d, feats)
    m = with_morph(d, keys, feats)
    per = m.groupBy("morph").agg(F.sum("n").alias("n"))
    stats = per.agg(F.count(F.lit(1)).cast("bigint").alias("morph_types"),
                    F.sum("n").cast("bigint").alias("examples"),
                    F.round(F.avg("n"), DIGITS).alias("examples_per_type"))
    return stats.withColumn("feature_types", keys.select(F.size("keys").cast("bigint")).scalar())


def change_profile(pairs: DataFrame, inner: str, outer: str, cluster: str) -> DataFrame:
    """Per cluster and overall (``AGG``): same / prefix / suffix /
    circumfix / other counts, mean edit distance and mean number of inner
    characters missing from the outer string, over all rows.

    ``inner`` in ``outer``: removing every occurrence of inner leaves r; prefix
    when r + inner = outer, suffix when inner + r = outer (both can fire),
    circumfix when neither. Computed once per distinct (cluster, inner, outer)."""
    d = pairs.groupBy(cluster, inner, outer).agg(F.count(F.lit(1)).alias("n"))
    i, o, n = F.col(inner), F.col(outer), F.col("n")
    same = i == o
    inside = ~same & o.contains(i)
    r = F.replace(o, i, F.lit(""))
    pre = inside & (F.concat(r, i) == o)
    suf = inside & (F.concat(i, r) == o)
    circ = inside & ~pre & ~suf
    other = ~same & ~inside
    dels = F.when(same, 0).otherwise(F.size(F.filter(chars(i), lambda c: ~o.contains(c))))
    dist = F.when(same, 0).otherwise(F.levenshtein(i, o))
    s = d.select(cluster, n, (same.cast("int") * n).alias("same"), (pre.cast("int") * n).alias("prefix"),
                 (suf.cast("int") * n).alias("suffix"), (circ.cast("int") * n).alias("circumfix"),
                 (other.cast("int") * n).alias("other"), (dist * n).alias("dist"), (dels * n).alias("dels"))
    g = s.rollup(cluster).agg(
        F.sum("n").cast("bigint").alias("n"),
        *[F.sum(c).cast("bigint").alias(c) for c in ("prefix", "suffix", "same", "circumfix", "other")],
        F.round(F.sum("dist") / F.sum("n"), DIGITS).alias("mean_distance"),
        F.round(F.sum("dels") / F.sum("n"), DIGITS).alias("mean_deleted"),
        F.grouping(cluster).alias("_g"))
    return g.withColumn(cluster, F.when(F.col("_g") == 1, F.lit("AGG")).otherwise(F.col(cluster))).drop("_g")


def profile(ex: DataFrame, tags: Sequence[str] = ("pos=V", "pos=N"), feats: str = "feats") -> DataFrame:
    """Examples, distinct morph types, and morph types containing each tag."""
    # morph strings are made of distinct bundles
    ex = ex.groupBy(feats).agg(F.count(F.lit(1)).alias("_n"))
    m = with_morph(ex, feature_types(ex, feats), feats)
    aggs = [F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("examples"),
            F.count_distinct("morph").cast("bigint").alias("morph_types")]
    for t in tags:
        aggs.append(F.count_distinct(F.when(F.col("morph").contains(t), F.col("morph"))).cast("bigint")
                    .alias("types_" + t.replace("=", "_").lower()))
    return m.agg(*aggs)


def build_vocab(ex: DataFrame, word_cols: Sequence[str] = ("lemma", "word"), feats: str = "feats") -> DataFrame:
    """symbols = distinct letters of the words, ``k=v`` features and
    ``k=NULL`` for each feature name; 1-based index in symbol order. The index
    is a running number over range partitions of the symbols, so no single task
    sorts the whole symbol set, whatever prefixes its feature values share."""
    # one explode of one combined array per distinct row: the example table is read once
    ex = ex.select(*dict.fromkeys([*word_cols, feats])).distinct()
    fm = parse_feats(F.col(feats))
    kv = F.transform(F.map_entries(fm), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    kn = F.transform(F.map_keys(fm), lambda k: F.concat(k, F.lit("=" + NULL_VALUE)))
    arr = F.concat(*[chars(F.col(c)) for c in word_cols], kv, kn)
    syms = ex.select(F.explode(arr).alias("symbol")).distinct()
    return running_number(range_chunks(syms, ["symbol"]), [], ["symbol"], "idx", chunk=F.col("_range")).drop("_range")


def encode(ex: DataFrame, vocab: DataFrame, word: str, feats: str = "feats",
           keys: DataFrame | None = None) -> DataFrame:
    """Letters of ``word`` -> index array; features -> index array over the
    known feature names in sorted order, ``k=NULL`` where a name is missing.
    An unknown symbol fails the job (``raise_error``).

    Distinct words and feature bundles are taken apart, their symbols meet the
    vocabulary in a join, and their index arrays come back to the rows: the
    vocabulary may hold as many feature values as there are, and no symbol that
    every row has is moved more than once a distinct word."""
    keys = keys if keys is not None else feature_types(ex, feats)

    def indexed(values: DataFrame, out: str) -> DataFrame:
        """``value`` and its array ``symbols`` -> ``value`` and the array of indices."""
        spots = values.select("value", F.posexplode("symbols").alias("_at", "symbol"))
        found = spots.join(vocab.select("symbol", "idx"), "symbol", "left")
        # the check stays beside the value it guards, so that no plan drops it
        idx = F.coalesce("idx", F.raise_error(F.concat(F.lit("unknown symbol: "), "symbol")).cast("bigint"))
        arrays = found.select("value", F.struct("_at", idx.alias("idx")).alias("_s")).groupBy("value").agg(
            F.transform(F.array_sort(F.collect_list("_s")), lambda x: x["idx"]).alias(out))
        return arrays

    # written once: the words, the bundles and their plans start from it
    known = materialise(ex.select(F.col(word).alias("_w"), F.coalesce(F.col(feats), F.lit("")).alias("_f")).distinct())
    words = known.select(F.col("_w").alias("value")).distinct().withColumn("symbols", chars(F.col("value")))
    bundles = known.select(F.col("_f").alias("value")).distinct().withColumn("_keys", materialise(keys).select("keys").scalar())
    fmap = parse_feats(F.col("value"))
    bundles = bundles.withColumn("symbols", F.transform(F.col("_keys"), lambda k: F.concat(
        k, F.lit("="), F.coalesce(F.try_element_at(fmap, k), F.lit(NULL_VALUE)))))
    pairs = known.join(indexed(words, "word_idx"), F.col("_w") == F.col("value"), "left").drop("value").join(
        indexed(bundles, "feat_idx"), F.col("_f") == F.col("value"), "left").drop("value")
    none = F.array().cast("array<bigint>")
    pairs = pairs.select("_w", "_f", F.when(F.col("_w").isNotNull(), F.coalesce("word_idx", none)).alias("word_idx"),
                         F.coalesce("feat_idx", none).alias("feat_idx"))
    return ex.join(pairs, F.col(word).eqNullSafe(F.col("_w")) & F.coalesce(F.col(feats), F.lit("")).eqNullSafe(F.col("_f")), "left").drop("_w", "_f")
