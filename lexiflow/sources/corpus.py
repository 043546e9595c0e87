"""Token corpus derived from the ``documents`` table.

The annotated corpus the operators expect (token rows with form, lemma and a
part-of-speech tag, sentences, documents, a train/valid/test split) is derived
from free text with fixed rules, so every job's work grows with the table:

* sentence = one line of ``text`` (``sent_id`` from 1);
* token = a run of letters/digits, or one other non-space character (``tok_id`` from 1);
* ``xpostag``: no letter/digit -> PUNCT; all digits -> NUM; capital first letter
  after the first token -> NP; at most 3 characters -> P; else N;
* ``lemma``: PUNCT and NUM keep the form, N strips one suffix from the
  lower-cased form when at least 3 characters stay, others are lower-cased;
* ``split``: ``doc_id % 10`` = 0 test, 1 valid, else train.

Nothing here shuffles: lines and tokens are produced by ``posexplode`` inside
the document's own task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let
from ..operators.filters import drop_punct

# Fixed values of the derived corpus (they must agree with the DuckDB oracle).
TOKEN_PATTERN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s\x0B]"
WORDCHAR_PATTERN = r"[\p{L}\p{N}]"
NUMBER_PATTERN = r"^\p{N}+$"
CAPITAL_PATTERN = r"^\p{Lu}"
SUFFIX_PATTERN = r"^(.{3,}?)(ing|tion|en|es|er|s)$"
# Morpheme type given to each stripped suffix in the TEI rendering.
SUFFIX_TYPES = {"ing": "ger", "tion": "nmz", "en": "ptcp", "es": "pl", "er": "agt", "s": "pl"}
# Language code given to number tokens inside a paragraph (marked as foreign words).
NUMBER_LANG = "zxx"


def xpostag(form: Column, tok_id: Column) -> Column:
    # a form that opens with an ASCII letter is a word and no number whatever follows:
    # its tag needs no pattern
    first = F.ascii(form)
    capital = first.between(65, 90)
    short = F.when(F.length(form) <= 3, F.lit("P")).otherwise(F.lit("N"))
    return (F.when(capital | first.between(97, 122), F.when((tok_id > 1) & capital, F.lit("NP")).otherwise(short))
             .when(~form.rlike(WORDCHAR_PATTERN), F.lit("PUNCT"))
             .when(form.rlike(NUMBER_PATTERN), F.lit("NUM"))
             .when((tok_id > 1) & form.rlike(CAPITAL_PATTERN), F.lit("NP"))
             .otherwise(short))


SUFFIXES_LONGEST_FIRST = sorted(SUFFIX_TYPES, key=lambda x: (-len(x), x))


def strip_suffix(lower_form: Column) -> Column:
    """Remove the longest listed suffix that leaves at least 3 characters (the
    same result as ``regexp_replace(SUFFIX_PATTERN, '$1')``, written with
    ``endswith`` so it stays in generated code without a backtracking regex)."""
    n = F.length(lower_form)
    out = lower_form
    for suf in reversed(SUFFIXES_LONGEST_FIRST):
        out = F.when(lower_form.endswith(suf) & (n >= len(suf) + 3),
                     F.substring(lower_form, 1, n - len(suf))).otherwise(out)
    return out


def lemma_of(form: Column, pos: Column, low: Column) -> Column:
    """``low``: the lower-cased form, computed by the caller (it is read many times)."""
    return (F.when(pos.isin("PUNCT", "NUM"), form)
             .when(pos == "N", strip_suffix(low))
             .otherwise(low))


def split_of(doc_id: Column) -> Column:
    m = F.pmod(doc_id, F.lit(10))
    return F.when(m == 0, F.lit("test")).when(m == 1, F.lit("valid")).otherwise(F.lit("train"))


def corpus_tokens(documents: DataFrame) -> DataFrame:
    """documents(doc_id, text, lang, source) -> one row per token.

    Columns: doc_id, lang, source, split, sent_id, tok_id, form, lemma, xpostag.
    """
    lines = documents.select(
        "doc_id", "lang", "source",
        F.posexplode(F.split(F.col("text"), "\n", -1)).alias("lpos", "line"))
    toks = lines.select(
        "doc_id", "lang", "source",
        (F.col("lpos") + 1).cast("bigint").alias("sent_id"),
        F.posexplode(F.regexp_extract_all(F.col("line"), F.lit(TOKEN_PATTERN), 0)).alias("tpos", "form"))
    # staged: tag and lower-cased form are computed once, then the lemma reads them by name
    toks = toks.select("doc_id", "lang", "source", "sent_id", "form",
                       (F.col("tpos") + 1).cast("bigint").alias("tok_id"))
    toks = toks.select("doc_id", "lang", "source", "sent_id", "tok_id", "form",
                       F.lower("form").alias("_low"), xpostag(F.col("form"), F.col("tok_id")).alias("xpostag"))
    return toks.select(
        "doc_id", "lang", "source", split_of(F.col("doc_id")).alias("split"),
        "sent_id", "tok_id", "form",
        lemma_of(F.col("form"), F.col("xpostag"), F.col("_low")).alias("lemma"),
        "xpostag")


def words(tok: DataFrame) -> DataFrame:
    """Non-punctuation tokens with the lower-cased form used by the scorers."""
    return drop_punct(tok).withColumn("lform", F.lower("form"))


# ---------------------------------------------------------------- TEI rendering

def xml_escape(c: Column) -> Column:
    c = F.replace(c, F.lit("&"), F.lit("&amp;"))
    c = F.replace(c, F.lit("<"), F.lit("&lt;"))
    c = F.replace(c, F.lit(">"), F.lit("&gt;"))
    return F.replace(c, F.lit('"'), F.lit("&quot;"))


def _token_xml(t: Column, pos: Column, lem: Column, lang: Column) -> Column:
    # a word is letters and digits (TOKEN_PATTERN): only punctuation has characters to escape
    n = F.length(lem)
    stem, suf = F.substring(t, 1, n), F.substring(t, n + 1, 1 << 30)
    types = F.create_map(*[F.lit(x) for pair in SUFFIX_TYPES.items() for x in pair])
    root_m = F.concat(F.lit('<m baseForm="'), lem, F.lit('" type="root">'), stem, F.lit("</m>"))
    suf_m = let(F.lower(suf), lambda low: F.concat(F.lit('<m baseForm="'), low, F.lit('" type="'),
                                                   F.try_element_at(types, low), F.lit('">'), suf, F.lit("</m>")))
    morphs = (F.when(pos == "NUM", F.concat(F.lit("<m>"), t, F.lit("</m>")))
               .when((pos == "N") & (n < F.length(t)), F.concat(root_m, suf_m))
               .otherwise(F.concat(F.lit('<m baseForm="'), lem, F.lit('" type="root">'), t, F.lit("</m>"))))
    wlang = F.when(pos == "NUM", F.lit(NUMBER_LANG)).otherwise(lang)
    word = F.concat(F.lit('<w xml:lang="'), wlang, F.lit('" lemma="'), lem,
                    F.lit('" pos="'), pos, F.lit('">'), morphs, F.lit("</w>"))
    return F.when(pos == "PUNCT", xml_escape(t)).otherwise(word)


def tei_documents(documents: DataFrame) -> DataFrame:
    """Render each document as a TEI file: one ``<p xml:lang n>`` per line, one
    ``<w lemma pos>`` with ``<m baseForm type>`` children per word, punctuation as
    bare text between words. Built row-locally with higher-order functions (no
    shuffle), in stages so that tags and lemmas are computed once per token;
    output (doc_id, lang, xml)."""
    lang = F.col("lang")
    d = documents.select("doc_id", "lang", F.transform(
        F.split(F.col("text"), "\n", -1),
        lambda line: F.regexp_extract_all(line, F.lit(TOKEN_PATTERN), 0)).alias("_toks"))
    d = d.select("doc_id", "lang", "_toks", F.transform("_toks", lambda ts: F.transform(
        ts, lambda t, j: xpostag(t, j + 1))).alias("_pos"))
    d = d.select("doc_id", "lang", "_toks", "_pos", F.zip_with("_toks", "_pos", lambda ts, ps: F.zip_with(
        ts, ps, lambda t, p: let(F.lower(t), lambda low: lemma_of(t, p, low)))).alias("_lem"))

    def par(ts, i):
        ps, ls = F.get(F.col("_pos"), i), F.get(F.col("_lem"), i)
        body = F.array_join(F.transform(ts, lambda t, j: _token_xml(t, F.get(ps, j), F.get(ls, j), lang)), " ")
        return F.concat(F.lit('<p xml:lang="'), lang, F.lit('" n="'), (i + 1).cast("string"),
                        F.lit('">'), body, F.lit("</p>"))

    pars = F.array_join(F.transform(F.col("_toks"), par), "\n")
    xml = F.concat(F.lit('<TEI><text xml:lang="'), lang, F.lit('"><body>\n'), pars,
                   F.lit("\n</body></text></TEI>"))
    return d.select("doc_id", "lang", xml.alias("xml"))
