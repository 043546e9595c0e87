"""Corpus statistics and profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tei import morph_texts
from .scoring import DIGITS

# Characters deleted before line statistics, and words not counted.
LINE_PUNCT = '.,;:()[]?¿!¡«»"'
NOT_WORDS = ("", " ", "-", "–", "—")


def word_stats(toks: DataFrame, pos: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """A1 over TEI word tokens (``inner`` markup kept): tokens, word tokens/types
    rebuilt by joining the lower-cased morphemes, lemma types, morpheme
    tokens/types, morphemes per word. ``pos`` keeps one tag (then untagged words
    drop out).

    Words are collapsed to distinct (lemma, morphemes) with their count first.
    Each distinct word is then exploded into its morphemes (``posexplode_outer``
    keeps words without any); word-level columns count only on the first
    morpheme row, so one aggregate with distinct counts gives everything."""
    w = toks.filter(F.col("inner").isNotNull())
    if pos is not None:
        w = w.filter(F.col("xpostag") == pos)
    # only the morpheme texts are needed: no attribute parsing
    w = w.select(*by, "lemma", F.transform(morph_texts(F.col("inner")), lambda t: F.lower(t)).alias("mtexts"))
    w = w.groupBy(*by, "lemma", "mtexts").agg(F.count(F.lit(1)).alias("n"))
    e = w.select(*by, "lemma", "n", F.lower(F.array_join("mtexts", "")).alias("rebuilt"),
                 F.posexplode_outer("mtexts").alias("mpos", "m"))
    first = F.col("mpos").isNull() | (F.col("mpos") == 0)
    g = e.groupBy(*by).agg(
        F.sum(F.when(first, F.col("n"))).alias("tokens"),
        F.count_distinct("rebuilt").alias("word_types"),
        (F.count_distinct("lemma") + F.max((first & F.col("lemma").isNull()).cast("int"))).alias("lemmas"),
        F.coalesce(F.sum(F.when(F.col("m").isNotNull(), F.col("n"))), F.lit(0)).alias("morpheme_tokens"),
        F.count_distinct("m").alias("morpheme_types"))
    return g.select(*by, F.col("tokens").cast("bigint").alias("tokens"),
                    F.col("tokens").cast("bigint").alias("reconstructed_word_tokens"),
                    F.col("word_types").cast("bigint").alias("reconstructed_word_types"),
                    F.col("lemmas").cast("bigint").alias("lemmas"),
                    F.col("morpheme_tokens").cast("bigint").alias("morpheme_tokens"),
                    F.col("morpheme_types").cast("bigint").alias("morpheme_types"),
                    F.round(F.col("morpheme_tokens") / F.col("tokens"), DIGITS).alias("morpheme_word_ratio"))


def line_words(lines: DataFrame, col: str = "line") -> DataFrame:
    """A2 word list: delete the punctuation set, lower-case, split on single
    spaces, drop empty and dash-only words."""
    cleaned = F.lower(F.translate(F.col(col), LINE_PUNCT, ""))
    e = lines.select("*", F.explode(F.split(cleaned, " ", -1)).alias("word"))
    return e.filter(~F.col("word").isin(*NOT_WORDS))


def line_stats(lines: DataFrame, col: str = "line", by: Sequence[str] = ()) -> DataFrame:
    """A2: lines, word tokens and word types."""
    n_lines = lines.groupBy(*by).agg(F.count(F.lit(1)).cast("bigint").alias("lines"))
    ws = line_words(lines, col).groupBy(*by).agg(F.count(F.lit(1)).cast("bigint").alias("word_tokens"),
                                                 F.count_distinct("word").cast("bigint").alias("word_types"))
    if by:
        j = n_lines.join(ws, list(by), "left")
    else:
        # both sides are single rows: attach the word counts as scalar subqueries
        j = n_lines.select("lines", F.coalesce(ws.select("word_tokens").scalar(), F.lit(0)).alias("word_tokens"),
                           F.coalesce(ws.select("word_types").scalar(), F.lit(0)).alias("word_types"))
    return j.na.fill(0, subset=["word_tokens", "word_types"])


def count_values(df: DataFrame, col: str | Column, name: str = "value") -> DataFrame:
    """Value counts, most frequent first."""
    c = F.col(col) if isinstance(col, str) else col
    return df.groupBy(c.alias(name)).agg(F.count(F.lit(1)).cast("bigint").alias("n")) \
             .orderBy(F.col("n").desc(), F.col(name))
