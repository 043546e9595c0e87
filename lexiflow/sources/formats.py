"""Training-format sinks: parallel sentence lines (S14) and character files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import SPACE_MARK, computed, to_chars
from ..operators.runs import pack_runs, run_items


def to_parallel(tok: DataFrame, keys: Sequence[str] = ("doc_id", "sent_id"), order: str = "tok_id",
                punct_col: str = "xpostag") -> DataFrame:
    """Per sentence, the source line (lower-cased forms, a space inside a
    form written ``_``), target line (lower-cased lemmas) and POS line; tokens
    joined by a space, punctuation dropped. Neighbouring tokens are joined before the
    one shuffle on the sentence key, so a sentence moves as one row or a few; a sentence
    is one line of text, so each group is small."""
    # a word without a tag stays, its tag is written ``_``: the lines keep their lengths
    words = tok.select(
        *keys, F.col(order).alias("_o"),
        F.coalesce(F.replace(F.lower("form"), F.lit(" "), F.lit(SPACE_MARK)), F.lit("_")).alias("src"),
        F.coalesce(F.lower("lemma"), F.lit("_")).alias("tgt"), F.coalesce("xpostag", F.lit("_")).alias("pos"),
        (~F.col(punct_col).eqNullSafe(F.lit("PUNCT"))).alias("_keep"))
    names = ["src", "tgt", "pos"]
    runs = pack_runs(words, keys, "_o", names, keep="_keep")
    g = runs.groupBy(*keys).agg(F.collect_list(F.when(F.size("_o") > 0, F.struct("_o", *names))).alias("_r"))
    # a lone run is in order; the rows of several are sorted
    several = F.when(F.size("_r") > 1, F.array_sort(F.flatten(F.transform("_r", lambda r: run_items(r, "_o", names)))))
    g = computed(g, [*keys, "_r"], _t=several)
    def field(name):
        return F.when(F.size("_r") > 1, F.array_join(F.transform("_t", lambda s: s[name]), " ")).otherwise(
            F.coalesce(F.get("_r", F.lit(0))[name], F.lit(""))).alias(name)
    return g.select(*keys, *[field(c) for c in names])


def char_lines(df: DataFrame, col: str) -> DataFrame:
    """T3 file rows: one ``<w> c h a r <\\w>`` line per token of a sentence line."""
    e = df.select("*", F.posexplode(F.split(F.trim(F.col(col)), " +")).alias("tpos", "token"))
    return e.filter(F.length("token") > 0).withColumn("char_line", to_chars(F.col("token")))
