"""DuckDB SQL mirroring the derived views, and SQL helpers for the oracles.

DuckDB's ``levenshtein`` counts bytes, Spark's counts characters, so the
oracles use ``lev_sql``: the same dynamic programme written with list lambdas.
"""

from __future__ import annotations

from ..sources.corpus import (CAPITAL_PATTERN, NUMBER_PATTERN, SUFFIX_PATTERN, SUFFIX_TYPES,
                              TOKEN_PATTERN, WORDCHAR_PATTERN)


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def chars_sql(a: str) -> str:
    return f"list_transform(range(1, length({a}) + 1), lambda i: substr({a}, i, 1))"


def lev_sql(a: str, b: str) -> str:
    """Character-level Levenshtein distance of two SQL expressions."""
    return (f"list_reduce({chars_sql(a)}, lambda prev, ca: list_reduce(range(1, length({b}) + 1), "
            f"lambda row, j: list_append(row, least(prev[j + 1] + 1, row[j] + 1, "
            f"prev[j] + CASE WHEN ca = substr({b}, j, 1) THEN 0 ELSE 1 END)), [prev[1] + 1]), "
            f"range(0, length({b}) + 1))[length({b}) + 1]")


def lcs_sql(a: str, b: str) -> str:
    """Character LCS length of two SQL expressions."""
    return (f"CASE WHEN length({b}) = 0 THEN 0 ELSE list_reduce({chars_sql(a)}, lambda prev, ca: "
            f"list_reduce(range(1, length({b}) + 1), lambda row, j: list_append(row, "
            f"CASE WHEN ca = substr({b}, j, 1) THEN prev[j] + 1 ELSE greatest(prev[j + 1], row[j]) END), [0]), "
            f"list_transform(range(0, length({b}) + 1), lambda x: 0))[length({b}) + 1] END")


def ratio_sql(num: str, den: str) -> str:
    return f"CASE WHEN ({den}) > 0 THEN round(CAST({num} AS DOUBLE) / ({den}), 6) END"


def suffix_type_sql(lform: str, lemma: str) -> str:
    suf = f"substr({lform}, length({lemma}) + 1)"
    whens = " ".join(f"WHEN {q(s)} THEN {q(t)}" for s, t in SUFFIX_TYPES.items())
    return f"CASE {suf} {whens} END"


_POS = (f"CASE WHEN NOT regexp_matches(form, {q(WORDCHAR_PATTERN)}) THEN 'PUNCT' "
        f"WHEN regexp_matches(form, {q(NUMBER_PATTERN)}) THEN 'NUM' "
        f"WHEN tok_id > 1 AND regexp_matches(form, {q(CAPITAL_PATTERN)}) THEN 'NP' "
        f"WHEN length(form) <= 3 THEN 'P' ELSE 'N' END")

# CTEs: lines_, tok0_, tok1_, tok, w (non-punctuation with lform), ex (examples).
TOK_CTES = f"""
lines_ AS (
  SELECT doc_id, lang, source,
         CAST(unnest(generate_series(1, len(string_split(text, chr(10))))) AS BIGINT) AS sent_id,
         unnest(string_split(text, chr(10))) AS line
  FROM documents),
tok0_ AS (
  SELECT doc_id, lang, source, sent_id,
         CAST(unnest(generate_series(1, len(regexp_extract_all(line, {q(TOKEN_PATTERN)})))) AS BIGINT) AS tok_id,
         unnest(regexp_extract_all(line, {q(TOKEN_PATTERN)})) AS form
  FROM lines_),
tok1_ AS (SELECT *, {_POS} AS xpostag FROM tok0_),
tok AS (
  SELECT doc_id, lang, source,
         CASE doc_id % 10 WHEN 0 THEN 'test' WHEN 1 THEN 'valid' ELSE 'train' END AS split,
         sent_id, tok_id, form,
         CASE WHEN xpostag IN ('PUNCT', 'NUM') THEN form
              WHEN xpostag = 'N' THEN regexp_replace(lower(form), {q(SUFFIX_PATTERN)}, '\\1')
              ELSE lower(form) END AS lemma,
         xpostag
  FROM tok1_),
w AS (SELECT *, lower(form) AS lform FROM tok WHERE xpostag <> 'PUNCT'),
ex AS (
  SELECT doc_id, sent_id, tok_id, split, lemma,
         concat_ws(',', 'pos=' || xpostag, 'lang=' || lang, 'sfx=' || {suffix_type_sql('lform', 'lemma')}) AS feats,
         lform AS word, xpostag
  FROM w)"""


def with_tok(*ctes: str) -> str:
    extra = "".join(",\n" + c for c in ctes)
    return "WITH " + TOK_CTES.strip() + extra + "\n"


def score_sql(src: str, by: list[str], gold: str, pred: str) -> str:
    """SQL twin of ``scoring.score``: src must expose the by columns, gold and pred."""
    bys = ", ".join(by)
    sel_by = (bys + ", ") if by else ""
    grp = f"GROUP BY {bys}" if by else ""
    return f"""
pairs_ AS (SELECT {sel_by}{gold} AS g_, {pred} AS p_, count(*) AS n FROM {src} {"GROUP BY ALL"}),
scored_ AS (SELECT *, (g_ IS NOT DISTINCT FROM p_) AS ok_,
                   CASE WHEN g_ IS DISTINCT FROM p_ THEN {lev_sql("coalesce(p_, '')", "coalesce(g_, '')")} END AS d_
            FROM pairs_),
agg_ AS (SELECT {sel_by}CAST(sum(n) AS BIGINT) AS n_rows,
                CAST(sum(CASE WHEN ok_ THEN n ELSE 0 END) AS BIGINT) AS n_right,
                CAST(sum(CASE WHEN NOT ok_ THEN n ELSE 0 END) AS BIGINT) AS n_wrong,
                CAST(coalesce(sum(d_ * n), 0) AS BIGINT) AS distance
         FROM scored_ {grp})"""


def score_select(by: list[str]) -> str:
    sel_by = (", ".join(by) + ", ") if by else ""
    return (f"SELECT {sel_by}n_rows, n_right, n_wrong, distance, "
            f"{ratio_sql('n_right', 'n_rows')} AS accuracy, {ratio_sql('distance', 'n_wrong')} AS mean_distance FROM agg_")


MFL_CTE = """
mflc_ AS (SELECT lform, lemma, count(*) AS n FROM w WHERE split = 'train' GROUP BY lform, lemma),
mflf_ AS (SELECT lform, lemma, doc_id, sent_id, tok_id,
                 row_number() OVER (PARTITION BY lform, lemma ORDER BY doc_id, sent_id, tok_id) AS rn
          FROM w WHERE split = 'train'),
mflr_ AS (SELECT c.lform, c.lemma, c.n,
                 row_number() OVER (PARTITION BY c.lform ORDER BY c.n DESC, f.doc_id, f.sent_id, f.tok_id) AS r,
                 sum(c.n) OVER (PARTITION BY c.lform) AS nf
          FROM mflc_ c JOIN mflf_ f ON f.lform = c.lform AND f.lemma = c.lemma AND f.rn = 1),
model AS (SELECT lform, lemma AS mfl_lemma, CAST(nf AS BIGINT) AS n_form FROM mflr_ WHERE r = 1)"""

PRED_CTE = f"""
pred AS (SELECT doc_id, sent_id, tok_id, split, form,
                CASE WHEN xpostag = 'PUNCT' THEN form ELSE regexp_replace(lower(form), {q(SUFFIX_PATTERN)}, '\\1') END AS plemma,
                xpostag AS ppos FROM tok)"""
