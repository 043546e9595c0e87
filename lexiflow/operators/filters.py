"""Projections and predicates over token tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let


def drop_punct(tok: DataFrame, col: str = "xpostag", also_empty: bool = False) -> DataFrame:
    """Drop PUNCT rows by ``xpostag`` (one evaluator tests ``upostag``); the
    format converter also drops the empty tag ``_``."""
    c = F.col(col)
    cond = c.isNull() | (c != "PUNCT")
    if also_empty:
        cond = cond & (c.isNull() | (c != "_"))
    return tok.filter(cond)


def keep_pos(tok: DataFrame, pos: str | None, col: str = "xpostag") -> DataFrame:
    """Keep one POS; ``None`` keeps everything, untagged words included."""
    return tok if pos is None else tok.filter(F.col(col).eqNullSafe(F.lit(pos)))


def mark_foreign(tok: DataFrame, lang: str | Column, word_lang: str = "word_lang",
                 par_lang: str = "lang") -> DataFrame:
    """Keep paragraphs of the target language; inside them words of another
    language stay and get ``foreign_lang`` set."""
    tl = F.lit(lang) if isinstance(lang, str) else lang
    kept = tok.filter(F.col(par_lang) == tl)
    return kept.withColumn("foreign_lang", F.when(F.col(word_lang) != tl, F.col(word_lang)))


def casefold(tok: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Lower-case the given columns (the form only, or every field)."""
    return tok.select(*[F.lower(F.col(c)).alias(c) if c in cols else F.col(c) for c in tok.columns])


def parse_misc(misc: Column, form: Column, legacy: bool = False) -> Column:
    """P5: MISC ``origText=..,baseForms=a|b[,wordLang=..]`` -> struct(orig_text,
    base_forms array, word_lang). An empty base-form list becomes [form] (Q8).
    ``legacy`` keeps a trailing ``,wordLang=..`` inside the base forms, as the
    original converter's split did."""
    orig = F.nullif(F.regexp_extract(misc, r"(?:^|,)origText=(.*?)(?:,baseForms=|,wordLang=|$)", 1), F.lit(""))
    if legacy:
        bf = F.regexp_extract(misc, r"baseForms=(.*)$", 1)
    else:
        bf = F.regexp_extract(misc, r"baseForms=(.*?)(?:,wordLang=[^,]*)?$", 1)
    wl = F.nullif(F.regexp_extract(misc, r",wordLang=([^,]*)$", 1), F.lit(""))
    bfs = let(bf, lambda b: F.when(F.length(b) > 0, F.split(b, r"\|", -1)).otherwise(F.array(form)))
    return F.struct(orig.alias("orig_text"), bfs.alias("base_forms"), wl.alias("word_lang"))


def seg_lem(tok: DataFrame, keys: Sequence[str] = (), legacy: bool = False) -> tuple[DataFrame, DataFrame]:
    """Segmentation pairs (form, ``pos=X``, base forms) and lemma pairs
    (base forms, ``pos=X``, lemma), lower-cased, from one scan. Punctuation,
    the empty tag and null forms are dropped."""
    t = drop_punct(tok, also_empty=True).filter(F.col("form").isNotNull() & (F.length("form") > 0))
    pm = parse_misc(F.col("misc"), F.col("form"), legacy)
    base = t.select(*keys, "form", "lemma", "xpostag", F.array_join(pm["base_forms"], "|").alias("_bf"))
    pos = F.concat(F.lit("pos="), F.col("xpostag"))
    seg = base.select(*keys, F.lower("form").alias("source"), pos.alias("pos"), F.lower("_bf").alias("target"))
    lem = base.select(*keys, F.lower("_bf").alias("source"), pos.alias("pos"), F.lower("lemma").alias("target"))
    return seg, lem


def truncate(col: Column, width: int) -> Column:
    """Cut a (noisy) segmentation to ``width`` characters."""
    return F.substring(col, 1, width)
