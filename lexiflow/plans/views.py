"""Spark views derived from the driver tables, shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure
from ..sources.corpus import SUFFIX_TYPES, corpus_tokens, words
from ..sources.tables import table


def documents(spark: SparkSession, sf: str) -> DataFrame:
    configure(spark)
    return table(spark, sf, "documents")


def tok(spark: SparkSession, sf: str) -> DataFrame:
    return corpus_tokens(documents(spark, sf).select("doc_id", "lang", "source", "text"))


def wtok(spark: SparkSession, sf: str) -> DataFrame:
    """Non-punctuation tokens with ``lform``."""
    return words(tok(spark, sf))


def suffix_type(lform, lemma):
    suf = F.substring(lform, F.length(lemma) + 1, 1 << 30)
    t = F.lit(None).cast("string")
    for s, ty in SUFFIX_TYPES.items():
        t = F.when(suf == s, F.lit(ty)).otherwise(t)
    return t


def examples(spark: SparkSession, sf: str) -> DataFrame:
    """Inflection examples (task 1 layout) from the word tokens:
    lemma, feats ``pos=..,lang=..[,sfx=..]``, word = lower-cased form, plus keys."""
    w = wtok(spark, sf)
    feats = F.concat_ws(",", F.concat(F.lit("pos="), F.col("xpostag")),
                        F.concat(F.lit("lang="), F.col("lang")),
                        F.concat(F.lit("sfx="), suffix_type(F.col("lform"), F.col("lemma"))))
    return w.select("doc_id", "sent_id", "tok_id", "split", "lemma", feats.alias("feats"),
                    F.col("lform").alias("word"), "xpostag")


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """A prediction table in the 8-column layout (keys kept): the suffix-strip
    predictor, i.e. the noun rule applied to every word (punctuation copied)."""
    from ..sources.corpus import strip_suffix
    t = tok(spark, sf)
    plemma = F.when(F.col("xpostag") == "PUNCT", F.col("form")).otherwise(strip_suffix(F.lower("form")))
    return t.select("doc_id", "sent_id", "tok_id", "split", "form",
                    F.lit(None).cast("string").alias("lemma"), plemma.alias("plemma"),
                    F.lit(None).cast("string").alias("pos"), F.col("xpostag").alias("ppos"),
                    F.lit(None).cast("string").alias("feats"), F.lit(None).cast("string").alias("pfeats"))
