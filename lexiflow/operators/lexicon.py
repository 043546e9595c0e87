"""Morphological lexicon: variable-arity lines, analysis codes, coverage
(S11, T13, A17)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise

# Feature names an analysis code can fill, in output order.
ANALYSIS_KEYS = ["pos", "gen", "num", "per", "tense", "binyan", "def",
                 "poss_gen", "poss_num", "poss_per", "poss_binyan"]


def read_lexicon(lines: DataFrame, col: str = "line") -> DataFrame:
    """``word analysis lemma analysis lemma ...`` -> one row per
    (word, analysis, lemma) with its pair number; a trailing odd field is dropped."""
    f = F.split(F.trim(F.col(col)), r"\s+")
    n_pairs = F.floor((F.size(f) - 1) / 2).cast("int")
    idx = F.when(n_pairs > 0, F.sequence(F.lit(1), n_pairs)).otherwise(F.array().cast("array<int>"))
    e = lines.select(F.get(f, 0).alias("word"), F.explode(F.transform(idx, lambda i: F.struct(
        i.alias("pair"), F.get(f, 2 * i - 1).alias("analysis"), F.get(f, 2 * i).alias("lemma")))).alias("p"))
    return e.select("word", F.col("p.pair").cast("bigint").alias("pair"), "p.analysis", "p.lemma")


def analysis_type(code: Column) -> Column:
    groups = F.filter(F.split(code, ":"), lambda s: s != "")
    return F.get(F.split(F.get(groups, 0), "-"), 0)


def parse_analysis(code: Column) -> Column:
    """Analysis code -> feature map. Groups are ``:``-separated (empty ones
    ignored), positions ``-``-separated. One group: a 6-field VB* code gives
    pos/gen/num/per/tense/binyan; JJT*/JJ*/NN* with 3+ fields give pos/gen/num.
    Two groups: DEF* marks ``def`` and reads the second group (1 field: pos;
    2: pos, num; 3+: pos, gen, num, then per, binyan); NN* reads the first group
    (pos, gen, num, per, binyan) and the second as the possessor (gen, num, per,
    binyan from its fields 2-5). Missing values are dropped from the map."""
    groups = F.filter(F.split(code, ":"), lambda s: s != "")
    ng = F.size(groups)
    e0 = F.split(F.get(groups, 0), "-")
    e1 = F.split(F.get(groups, 1), "-")
    n0, n1 = F.size(e0), F.size(e1)
    t = F.get(e0, 0)

    def g(arr, i):
        return F.get(arr, i)

    one = ng == 1
    two = ng == 2
    vb = one & (n0 == 6) & t.startswith("VB")
    adj_noun = one & (t.startswith("JJ") | t.startswith("NN")) & (n0 >= 3)
    de = two & t.startswith("DEF")
    nn2 = two & t.startswith("NN")
    none = F.lit(None).cast("string")
    vals = {
        "pos": F.when(vb | adj_noun, g(e0, 0)).when(nn2 & (n0 >= 3), g(e0, 0)).when(de, g(e1, 0)),
        "gen": F.when(vb | adj_noun, g(e0, 1)).when(nn2 & (n0 >= 3), g(e0, 1)).when(de & (n1 >= 3), g(e1, 1)),
        "num": F.when(vb | adj_noun, g(e0, 2)).when(nn2 & (n0 >= 3), g(e0, 2))
                .when(de & (n1 == 2), g(e1, 1)).when(de & (n1 >= 3), g(e1, 2)),
        "per": F.when(vb, g(e0, 3)).when(nn2 & (n0 >= 4), g(e0, 3)).when(de & (n1 >= 4), g(e1, 3)),
        "tense": F.when(vb, g(e0, 4)),
        "binyan": F.when(vb, g(e0, 5)).when(nn2 & (n0 >= 5), g(e0, 4)).when(de & (n1 >= 5), g(e1, 4)),
        "def": F.when(de, F.lit("DEF")),
        "poss_gen": F.when(nn2 & (n1 >= 3), g(e1, 1)),
        "poss_num": F.when(nn2 & (n1 >= 3), g(e1, 2)),
        "poss_per": F.when(nn2 & (n1 >= 4), g(e1, 3)),
        "poss_binyan": F.when(nn2 & (n1 >= 5), g(e1, 4)),
    }
    m = F.create_map(*[x for k in ANALYSIS_KEYS for x in (F.lit(k), F.coalesce(vals[k], none))])
    return F.map_filter(m, lambda k, v: v.isNotNull())


def feature_string(m: Column) -> Column:
    """``k=v`` pairs of a map, sorted by key, comma-joined."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(m)),
                                    lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")


def lexicon_coverage(lex: DataFrame) -> DataFrame:
    """Entries per analysis type, entries per parsed POS, and the parsed
    share (a parse needs at least two features). Output (kind, key, n, percent)."""
    p = lex.withColumn("_m", parse_analysis(F.col("analysis"))).select(
        analysis_type(F.col("analysis")).alias("type"), (F.size("_m") > 1).alias("ok"), F.col("_m")["pos"].alias("pos"))
    # one pass; the table that the three reports come from has a row per (type, pos, ok)
    c = materialise(p.groupBy("type", "pos", "ok").agg(F.count(F.lit(1)).alias("n")))
    parsed = F.sum(F.when(F.col("ok"), F.col("n")).otherwise(0))
    none = F.lit(None).cast("double").alias("percent")
    by_type = c.groupBy("type").agg(F.sum("n").alias("n")).select(F.lit("type").alias("kind"), F.col("type").alias("key"), "n", none)
    by_pos = c.filter("ok").groupBy("pos").agg(F.sum("n").alias("n")).select(F.lit("pos").alias("kind"), F.col("pos").alias("key"), "n", none)
    tot = c.agg(parsed.alias("n"), F.round(parsed * 100.0 / F.sum("n"), 6).alias("percent")).select(
        F.lit("total").alias("kind"), F.lit("parsed").alias("key"), "n", "percent")
    return by_type.unionByName(by_pos).unionByName(tot).withColumn("n", F.col("n").cast("bigint"))
