"""The registered queries: one per operator of the inventory, each run on the
driver tables (or views Spark derives from them), each paired where possible
with an exact DuckDB oracle over the same parquet files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import evaluate as ev
from ..operators import joins as jn
from ..sources.corpus import SUFFIX_PATTERN
from . import oracle as O
from . import views as V

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ------------------------------------------------------------ evaluation family

@register("a3_copy_baseline", O.with_tok(O.score_sql("w", ["split"], "lemma", "lform").strip())
          + O.score_select(["split"]))
def a3_copy_baseline(spark, sf):
    return ev.eval_copy(V.wtok(spark, sf), by=("split",))


@register("a4_mfl_model", O.with_tok(O.MFL_CTE.strip()) + "SELECT lform, mfl_lemma, n_form FROM model")
def a4_mfl_model(spark, sf):
    w = V.wtok(spark, sf)
    return ev.fit_mfl(w.filter(F.col("split") == "train"))


@register("a5_mfl_eval", O.with_tok(O.MFL_CTE.strip(), """
pred_ AS (SELECT w.split, w.lemma, coalesce(m.mfl_lemma, w.lform) AS plemma
          FROM w LEFT JOIN model m ON m.lform = w.lform WHERE w.split IN ('valid', 'test'))""",
          O.score_sql("pred_", ["split"], "lemma", "plemma").strip()) + O.score_select(["split"]))
def a5_mfl_eval(spark, sf):
    counts = ev.token_counts(V.wtok(spark, sf), ("train", "valid", "test"))
    model = ev.fit_mfl_counts(counts)
    pairs = ev.held_out_pairs(counts, "valid").withColumn("split", F.lit("valid")).unionByName(
        ev.held_out_pairs(counts, "test").withColumn("split", F.lit("test")))
    pred = jn.predict_mfl(model, pairs)
    return ev.score_collapsed(pred.select("split", "lemma", "plemma", "n"), ("split",), "lemma", "plemma")


@register("j1_predict_mfl", O.with_tok(O.MFL_CTE.strip()) + """
SELECT w.doc_id, w.sent_id, w.tok_id, w.lform, w.lemma, coalesce(m.mfl_lemma, w.lform) AS plemma,
       m.lform IS NOT NULL AS seen
FROM w LEFT JOIN model m ON m.lform = w.lform WHERE w.split = 'test'""")
def j1_predict_mfl(spark, sf):
    w = V.wtok(spark, sf)
    model = ev.fit_mfl(w.filter(F.col("split") == "train"))
    test = w.filter(F.col("split") == "test").select("doc_id", "sent_id", "tok_id", "lform", "lemma")
    return jn.predict_mfl(model, test)


def _by_pos_sql(plemma: str = "coalesce(m.mfl_lemma, w.lform)", seen: str = "m.lform IS NOT NULL", ctes: str = "",
                rows: str = "w LEFT JOIN model m ON m.lform = w.lform WHERE w.split = 'test'", of: str = "w") -> str:
    ok = f"({plemma} = {of}.lemma)"
    d = O.lev_sql(plemma, f"{of}.lemma")
    return O.with_tok(O.MFL_CTE.strip(), O.PRED_CTE.strip(), ctes.strip() + f"""
t_ AS (SELECT {of}.xpostag, {of}.lemma, {of}.lform, {seen} AS seen, {ok} AS ok,
              CASE WHEN NOT {ok} THEN {d} ELSE 0 END AS d
       FROM {rows}),
g_ AS (SELECT CASE WHEN grouping(xpostag) = 1 THEN 'TOTAL' ELSE xpostag END AS xpostag,
              sum(CASE WHEN seen THEN 1 ELSE 0 END) AS sn, sum(CASE WHEN seen AND ok THEN 1 ELSE 0 END) AS sr,
              sum(CASE WHEN seen AND NOT ok THEN 1 ELSE 0 END) AS sw, sum(CASE WHEN seen AND NOT ok THEN d ELSE 0 END) AS sd,
              sum(CASE WHEN NOT seen THEN 1 ELSE 0 END) AS un, sum(CASE WHEN NOT seen AND ok THEN 1 ELSE 0 END) AS ur,
              sum(CASE WHEN NOT seen AND NOT ok THEN 1 ELSE 0 END) AS uw, sum(CASE WHEN NOT seen AND NOT ok THEN d ELSE 0 END) AS ud
       FROM t_ GROUP BY ROLLUP (xpostag)),
u_ AS (SELECT DISTINCT xpostag FROM w WHERE split IN ('train', 'test') UNION SELECT 'TOTAL'),
j_ AS (SELECT u_.xpostag, coalesce(sn, 0) sn, coalesce(sr, 0) sr, coalesce(sw, 0) sw, coalesce(sd, 0) sd,
              coalesce(un, 0) un, coalesce(ur, 0) ur, coalesce(uw, 0) uw, coalesce(ud, 0) ud
       FROM u_ LEFT JOIN g_ ON g_.xpostag = u_.xpostag)""") + f"""
SELECT xpostag, CAST(sn AS BIGINT) AS seen_n, {O.ratio_sql('sr', 'sn')} AS seen_accuracy,
       {O.ratio_sql('sd', 'sw')} AS seen_distance, CAST(un AS BIGINT) AS unseen_n,
       {O.ratio_sql('ur', 'un')} AS unseen_accuracy, {O.ratio_sql('ud', 'uw')} AS unseen_distance,
       {O.ratio_sql('sr + ur', 'sn + un')} AS accuracy, {O.ratio_sql('sd + ud', 'sw + uw')} AS distance
FROM j_"""


@register("a7_eval_by_pos", _by_pos_sql())
def a7_eval_by_pos(spark, sf):
    return ev.eval_by_pos(V.wtok(spark, sf), "train", "test")


@register("a7_eval_predictions", _by_pos_sql("p.plemma", "p.seen", """
f_ AS (SELECT DISTINCT lform FROM w WHERE split = 'train'),
p_ AS (SELECT w.*, pred.plemma, f_.lform IS NOT NULL AS seen
       FROM w JOIN pred USING (doc_id, sent_id, tok_id) LEFT JOIN f_ ON f_.lform = w.lform),""", "p_ p WHERE p.split = 'test'", "p"))
def a7_eval_predictions(spark, sf):
    w = V.wtok(spark, sf)
    return ev.eval_predictions_by_pos(w.filter("split = 'test'"), V.predictions(spark, sf), w.filter("split = 'train'"),
                                      ["doc_id", "sent_id", "tok_id"])


@register("j2_merge_gold", O.with_tok(O.PRED_CTE.strip()) + """
SELECT p.doc_id, p.sent_id, p.tok_id, p.split, p.form, p.plemma, p.ppos, CAST(NULL AS VARCHAR) AS pfeats,
       t.lemma, t.xpostag AS pos, CAST(NULL AS VARCHAR) AS feats, CAST(NULL AS VARCHAR) AS misc
FROM pred p JOIN tok t USING (doc_id, sent_id, tok_id) WHERE t.xpostag <> 'PUNCT'""")
def j2_merge_gold(spark, sf):
    return jn.merge_gold(V.tok(spark, sf), V.predictions(spark, sf), ["doc_id", "sent_id", "tok_id"])


@register("j2_merge_audit", O.with_tok(O.PRED_CTE.strip()) + """
SELECT CAST(sum(CASE WHEN g.doc_id IS NOT NULL AND p.doc_id IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS paired,
       CAST(sum(CASE WHEN p.doc_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS gold_only,
       CAST(sum(CASE WHEN g.doc_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS pred_only
FROM (SELECT doc_id, sent_id, tok_id FROM w) g
FULL OUTER JOIN (SELECT doc_id, sent_id, tok_id FROM pred) p USING (doc_id, sent_id, tok_id)""")
def j2_merge_audit(spark, sf):
    return jn.merge_audit(V.tok(spark, sf), V.predictions(spark, sf), ["doc_id", "sent_id", "tok_id"])


@register("a6_eval_pred", O.with_tok(O.PRED_CTE.strip(), """
m_ AS (SELECT t.split, t.lemma, p.plemma FROM pred p JOIN tok t USING (doc_id, sent_id, tok_id)
       WHERE t.xpostag <> 'PUNCT')""", O.score_sql("m_", ["split"], "lemma", "plemma").strip())
          + O.score_select(["split"]))
def a6_eval_pred(spark, sf):
    # the prediction rows carry their split, so the merged rows are scored directly
    keys = ["doc_id", "sent_id", "tok_id"]
    merged = jn.merge_gold(V.tok(spark, sf).select(*keys, "lemma", "xpostag"),
                           V.predictions(spark, sf).select(*keys, "split", "plemma"), keys)
    return ev.eval_pred(merged, by=("split",))


@register("j3_mark_seen", O.with_tok() + """
SELECT t.doc_id, t.sent_id, t.tok_id, t.lform, t.lform IN (SELECT lform FROM w WHERE split = 'train') AS seen
FROM w t WHERE t.split <> 'train'""")
def j3_mark_seen(spark, sf):
    w = V.wtok(spark, sf)
    test = w.filter(F.col("split") != "train").select("doc_id", "sent_id", "tok_id", "lform")
    return jn.mark_seen(test, w.filter(F.col("split") == "train"))


@register("a8_rouge", O.with_tok(O.MFL_CTE.strip(), """
p_ AS (SELECT w.lemma AS g, coalesce(m.mfl_lemma, w.lform) AS h, count(*) AS n
       FROM w LEFT JOIN model m ON m.lform = w.lform WHERE w.split = 'test' GROUP BY ALL),
c_ AS (SELECT n, list_distinct(list_transform(range(1, length(g) + 1), lambda i: substr(g, i, 1))) AS g1,
              list_distinct(list_transform(range(1, length(h) + 1), lambda i: substr(h, i, 1))) AS h1,
              CASE WHEN length(g) >= 2 THEN list_distinct(list_transform(range(1, length(g)), lambda i: substr(g, i, 2))) ELSE [] END AS g2,
              CASE WHEN length(h) >= 2 THEN list_distinct(list_transform(range(1, length(h)), lambda i: substr(h, i, 2))) ELSE [] END AS h2,
              length(g) AS lg, length(h) AS lh, """ + O.lcs_sql("h", "g") + """ AS lcs FROM p_),
o_ AS (SELECT n, len(list_intersect(g1, h1)) AS o1, len(g1) AS r1n, len(h1) AS p1n,
              len(list_intersect(g2, h2)) AS o2, len(g2) AS r2n, len(h2) AS p2n, lcs, lg, lh FROM c_),
f_ AS (SELECT n,
  CASE WHEN r1n > 0 THEN o1 / r1n ELSE 0.0 END AS rouge1_r, CASE WHEN p1n > 0 THEN o1 / p1n ELSE 0.0 END AS rouge1_p,
  CASE WHEN r2n > 0 THEN o2 / r2n ELSE 0.0 END AS rouge2_r, CASE WHEN p2n > 0 THEN o2 / p2n ELSE 0.0 END AS rouge2_p,
  CASE WHEN lg > 0 THEN lcs / lg ELSE 0.0 END AS rougel_r, CASE WHEN lh > 0 THEN lcs / lh ELSE 0.0 END AS rougel_p FROM o_),
ff_ AS (SELECT *,
  CASE WHEN rouge1_r + rouge1_p > 0 THEN 2 * rouge1_r * rouge1_p / (rouge1_r + rouge1_p) ELSE 0.0 END AS rouge1_f,
  CASE WHEN rouge2_r + rouge2_p > 0 THEN 2 * rouge2_r * rouge2_p / (rouge2_r + rouge2_p) ELSE 0.0 END AS rouge2_f,
  CASE WHEN rougel_r + rougel_p > 0 THEN 2 * rougel_r * rougel_p / (rougel_r + rougel_p) ELSE 0.0 END AS rougel_f FROM f_)""")
          + "SELECT CAST(sum(n) AS BIGINT) AS n_rows, "
          + ", ".join(f"round(sum({m} * n) / sum(n), 6) AS {m}" for m in
                      [f"rouge{k}_{x}" for k in ("1", "2", "l") for x in "rpf"]) + " FROM ff_")
def a8_rouge(spark, sf):
    counts = ev.token_counts(V.wtok(spark, sf), ("train", "test"))
    pred = jn.predict_mfl(ev.fit_mfl_counts(counts), ev.held_out_pairs(counts, "test"))
    return ev.rouge(pred, "lemma", "plemma", weight="n")


@register("a13_micro_macro", O.with_tok(O.MFL_CTE.strip(), """
s_ AS (SELECT w.xpostag, (coalesce(m.mfl_lemma, w.lform) = w.lemma) AS ok
       FROM w LEFT JOIN model m ON m.lform = w.lform WHERE w.split = 'test'),
c_ AS (SELECT xpostag, count(*) AS n, sum(CAST(ok AS INT)) / count(*) AS acc FROM s_ GROUP BY xpostag)""") + """
SELECT CAST(count(*) AS BIGINT) AS n_clusters, CAST(sum(n) AS BIGINT) AS n_rows,
       round(avg(acc), 6) AS macro_accuracy, round(sum(n * acc) / sum(n), 6) AS micro_accuracy FROM c_""")
def a13_micro_macro(spark, sf):
    counts = ev.token_counts(V.wtok(spark, sf), ("train", "test"), by=("xpostag",))
    pred = jn.predict_mfl(ev.fit_mfl_counts(counts), ev.held_out_pairs(counts, "test", by=("xpostag",)))
    return ev.micro_macro(pred.withColumn("ok", F.col("plemma") == F.col("lemma")), "xpostag", weight="n")


@register("a14_score", O.with_tok(O.PRED_CTE.strip()) + """
SELECT t.split, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(sum(CASE WHEN replace(p.plemma, '^', '') = t.lemma THEN 1 ELSE 0 END) AS BIGINT) AS n_v,
       CAST(sum(CASE WHEN replace(p.plemma, '^', '') = t.lemma THEN 0 ELSE 1 END) AS BIGINT) AS n_x,
       round(avg(CASE WHEN replace(p.plemma, '^', '') = t.lemma THEN 1.0 ELSE 0.0 END), 6) AS accuracy
FROM w t JOIN pred p USING (doc_id, sent_id, tok_id) GROUP BY t.split""")
def a14_score(spark, sf):
    w = V.wtok(spark, sf).select("doc_id", "sent_id", "tok_id", "split", "lemma")
    p = V.predictions(spark, sf).select("doc_id", "sent_id", "tok_id", "plemma")
    m = jn.join_runs(w, p, ["doc_id", "sent_id", "tok_id"]).withColumn("mark", ev.mark(F.col("plemma"), F.col("lemma")))
    return m.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.when(F.col("mark") == "V", 1).otherwise(0)).cast("bigint").alias("n_v"),
        F.sum(F.when(F.col("mark") == "X", 1).otherwise(0)).cast("bigint").alias("n_x"),
        F.round(F.avg(F.when(F.col("mark") == "V", 1.0).otherwise(0.0)), 6).alias("accuracy"))


ERROR_BUCKETS = ("pos=N", "pos=NP", "pos=P")


def _mfl_errors(spark, sf):
    """Per test token: morph (feature bundle), source word, gold lemma, MFL prediction."""
    ex = V.examples(spark, sf)
    w = V.wtok(spark, sf)
    model = ev.fit_mfl(w.filter(F.col("split") == "train"))
    test = ex.filter(F.col("split") == "test").select("doc_id", "sent_id", "tok_id", F.col("feats").alias("morph"),
                                                      F.col("word").alias("lform"), "lemma")
    return jn.predict_mfl(model, test)


_ERR_SQL = O.MFL_CTE.strip() + """,
e1_ AS (SELECT ex.doc_id, ex.sent_id, ex.tok_id, ex.feats AS morph, ex.word AS source, ex.lemma AS gold,
               coalesce(m.mfl_lemma, ex.word) AS prediction
        FROM ex LEFT JOIN model m ON m.lform = ex.word WHERE ex.split = 'test'),
e2_ AS (SELECT ex.doc_id, ex.sent_id, ex.tok_id, ex.feats AS morph, ex.word AS source, ex.lemma AS gold,
               regexp_replace(ex.word, """ + O.q(SUFFIX_PATTERN) + """, '\\1') AS prediction
        FROM ex WHERE ex.split = 'test')"""


@register("a15_error_report", O.with_tok(_ERR_SQL, """
r_ AS (SELECT morph, source, gold, prediction, CAST(count(*) AS BIGINT) AS n FROM e1_
       WHERE gold <> prediction GROUP BY ALL)""") + """
SELECT r_.*, CAST(sum(n) OVER (PARTITION BY morph) AS BIGINT) AS morph_errors FROM r_""")
def a15_error_report(spark, sf):
    p = _mfl_errors(spark, sf)
    keys = ["doc_id", "sent_id", "tok_id"]
    gold = p.select(*keys, "morph", F.col("lform").alias("lemma"), F.col("lemma").alias("word"))
    pred = p.select(*keys, F.col("lform").alias("lemma"), F.col("plemma").alias("word"))
    return ev.error_report(gold, pred, keys)


@register("u3_compare_errors", O.with_tok(_ERR_SQL, """
a_ AS (SELECT morph, source, gold, prediction FROM e1_ WHERE gold <> prediction),
b_ AS (SELECT morph, source, gold, prediction FROM e2_ WHERE gold <> prediction),
all_ AS (SELECT 'both' AS kind, morph FROM (SELECT DISTINCT * FROM a_ INTERSECT SELECT DISTINCT * FROM b_)
         UNION ALL SELECT 'only_first', morph FROM a_ WHERE (morph, source, gold, prediction) NOT IN (SELECT (morph, source, gold, prediction) FROM b_)
         UNION ALL SELECT 'only_second', morph FROM b_ WHERE (morph, source, gold, prediction) NOT IN (SELECT (morph, source, gold, prediction) FROM a_)),
t_ AS (SELECT kind, unnest(list_concat(['ALL'], list_filter(""" + "[" + ", ".join(O.q(b) for b in ERROR_BUCKETS) + "]" + """, lambda x: instr(morph, x) > 0))) AS bucket FROM all_)""") + """
SELECT kind, bucket, CAST(count(*) AS BIGINT) AS n FROM t_ GROUP BY ALL""")
def u3_compare_errors(spark, sf):
    from ..sources.corpus import strip_suffix
    p = _mfl_errors(spark, sf)
    cols = ["morph", "source", "gold", "prediction"]
    a = p.filter(F.col("lemma") != F.col("plemma")).select(
        "morph", F.col("lform").alias("source"), F.col("lemma").alias("gold"), F.col("plemma").alias("prediction"))
    ex = V.examples(spark, sf).filter(F.col("split") == "test")
    b = ex.select(F.col("feats").alias("morph"), F.col("word").alias("source"), F.col("lemma").alias("gold"),
                  strip_suffix(F.col("word")).alias("prediction")).filter(F.col("gold") != F.col("prediction"))
    return ev.compare_errors(a, b, cols, ERROR_BUCKETS)


# ------------------------------------------------------------ extraction family

from ..operators import filters as P  # noqa: E402
from ..operators import stats as ST  # noqa: E402
from ..operators import windows as WN  # noqa: E402
from ..sources import tei as TEI  # noqa: E402
from ..sources.corpus import tei_documents  # noqa: E402
from ..sources.tables import table  # noqa: E402

LANGS = ["de", "en", "es", "fr"]


def _pages_pars(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", F.col("html").alias("xml"))
    return TEI.tei_paragraphs(pages, LANGS, key="page_id")


def _tei_tokens(spark, sf):
    docs = V.documents(spark, sf).select("doc_id", "lang", "text")
    return TEI.tei_tokens(TEI.tei_paragraphs(tei_documents(docs), None))


# The oracle splits the page at the start tags and cuts each piece at the first end
# it can have: another way than the scan's pattern, and none of its constants.
_ENDS = ("</p>", "</html>", "</body>", "</head>", "</div>", "</article>", "</section>", "</main>", "</header>", "</footer>", "</nav>",
         "</aside>", "</blockquote>", "</form>", "</ul>", "</ol>", "</li>", "</table>", "</tr>", "</td>", "</th>", "</text>", "</tei>")
_CUT_SQL = "least(" + ", ".join(f"CASE WHEN contains(low, {O.q(e)}) THEN strpos(low, {O.q(e)}) ELSE length(low) + 1 END" for e in _ENDS) + ")"
PAGES_PARS_SQL = f"""
pp0_ AS (SELECT page_id, string_split(html, '<html lang="')[2] AS root,
                string_split(replace(html, '<p>', '<p >'), '<p ') AS pieces FROM pages),
pp1_ AS (SELECT page_id, substr(root, 1, strpos(root, '"') - 1) AS root, unnest(generate_series(2, len(pieces))) AS i,
                unnest(pieces[2:]) AS piece FROM pp0_),
pp2_ AS (SELECT page_id, i, root, substr(piece, 1, strpos(piece, '>') - 1) AS a, substr(piece, strpos(piece, '>') + 1) AS rest,
                lower(substr(piece, strpos(piece, '>') + 1)) AS low FROM pp1_),
pp3_ AS (SELECT page_id, i, root AS lang, CAST(NULL AS VARCHAR) AS n, substr(rest, 1, {_CUT_SQL} - 1) AS body FROM pp2_),
pars AS (SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) AS BIGINT) AS par_id, lang, n, body
         FROM pp3_ WHERE lang IN ('de', 'en', 'es', 'fr'))"""


def _unescape_sql(x: str) -> str:
    for code, ch in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("copy", "\u00a9"), ("middot", "\u00b7"), ("amp", "&")):
        x = f"replace({x}, {O.q('&' + code + ';')}, {O.q(ch)})"
    return x


RAW_LINES_SQL = PAGES_PARS_SQL + f""",
raw AS (SELECT page_id, par_id, {_unescape_sql("regexp_replace(body, '<[^>]*>', '', 'g')")} AS line FROM pars)"""


@register("s2_tei_paragraphs", "WITH " + PAGES_PARS_SQL.strip() + "\nSELECT * FROM pars")
def s2_tei_paragraphs(spark, sf):
    return _pages_pars(spark, sf)


@register("s5_raw_lines", "WITH " + RAW_LINES_SQL.strip() + "\nSELECT * FROM raw")
def s5_raw_lines(spark, sf):
    return TEI.raw_lines(_pages_pars(spark, sf), key="page_id")


@register("a2_line_stats", "WITH " + RAW_LINES_SQL.strip() + f""",
lw_ AS (SELECT unnest(string_split(lower(translate(line, {O.q(ST.LINE_PUNCT)}, '')), ' ')) AS word FROM raw),
lwf_ AS (SELECT word FROM lw_ WHERE word NOT IN ({", ".join(O.q(x) for x in ST.NOT_WORDS)}))
SELECT (SELECT CAST(count(*) AS BIGINT) FROM raw) AS lines, CAST(count(*) AS BIGINT) AS word_tokens,
       CAST(count(DISTINCT word) AS BIGINT) AS word_types FROM lwf_""")
def a2_line_stats(spark, sf):
    return ST.line_stats(TEI.raw_lines(_pages_pars(spark, sf), key="page_id"))


_WORD_LANG_SQL = "CASE WHEN xpostag = 'PUNCT' THEN NULL WHEN xpostag = 'NUM' THEN 'zxx' ELSE lang END"


@register("s3_tei_tokens", O.with_tok() + f"""
SELECT doc_id, sent_id AS par_id, tok_id, form, lemma, xpostag, {_WORD_LANG_SQL} AS word_lang FROM tok""")
def s3_tei_tokens(spark, sf):
    return _tei_tokens(spark, sf).select("doc_id", "par_id", "tok_id", "form", "lemma", "xpostag", "word_lang")


_STRIPPED = "(xpostag = 'N' AND length(lemma) < length(form))"
_SUF = "substr(form, length(lemma) + 1)"
_MORPH_ROWS_SQL = f"""
mr_ AS (
  SELECT doc_id, sent_id AS par_id, tok_id, 1 AS m_id,
         CASE WHEN {_STRIPPED} THEN substr(form, 1, length(lemma)) ELSE form END AS text,
         CASE WHEN xpostag = 'NUM' THEN NULL ELSE lemma END AS base_form,
         CASE WHEN xpostag = 'NUM' THEN NULL ELSE 'root' END AS type, lemma, xpostag
  FROM w
  UNION ALL
  SELECT doc_id, sent_id, tok_id, 2, {_SUF}, lower({_SUF}), {O.suffix_type_sql('lower(form)', 'lemma')}, lemma, xpostag
  FROM w WHERE {_STRIPPED})"""


@register("s4_tei_morphemes", O.with_tok(_MORPH_ROWS_SQL.strip()) + """
SELECT doc_id, par_id, tok_id, CAST(m_id AS BIGINT) AS m_id, text, base_form, type FROM mr_""")
def s4_tei_morphemes(spark, sf):
    return TEI.tei_morphemes(_tei_tokens(spark, sf)).select(
        "doc_id", "par_id", "tok_id", "m_id", "text", "base_form", "type")


_MISC_SQL = f"""
cf_ AS (SELECT doc_id, sent_id AS par_id, tok_id, form, lemma, xpostag,
   CASE WHEN xpostag = 'PUNCT' THEN '_' WHEN {_STRIPPED} THEN coalesce({O.suffix_type_sql('lower(form)', 'lemma')}, '_') ELSE '_' END AS feats,
   CASE WHEN xpostag = 'PUNCT' THEN '_'
        ELSE 'origText=' || form || ',baseForms=' ||
             CASE WHEN xpostag = 'NUM' THEN 'None' WHEN {_STRIPPED} THEN lemma || '|' || lower({_SUF}) ELSE lemma END ||
             CASE WHEN xpostag = 'NUM' THEN ',wordLang=zxx' ELSE '' END END AS misc
   FROM tok)"""


def _conllu_rows(spark, sf):
    return TEI.conllu_fields(_tei_tokens(spark, sf))


@register("s4_conllu_fields", O.with_tok(_MISC_SQL.strip()) + "SELECT doc_id, par_id, tok_id, feats, misc FROM cf_")
def s4_conllu_fields(spark, sf):
    return _conllu_rows(spark, sf).select("doc_id", "par_id", "tok_id", "feats", "misc")


@register("a1_word_stats", O.with_tok(_MORPH_ROWS_SQL.strip(), """
ws_ AS (SELECT lang, CAST(count(*) AS BIGINT) AS tokens, CAST(count(DISTINCT lower(form)) AS BIGINT) AS wt,
               CAST(count(DISTINCT lemma) AS BIGINT) AS lemmas,
               CAST(sum(CASE WHEN xpostag = 'N' AND length(lemma) < length(form) THEN 2 ELSE 1 END) AS BIGINT) AS mtok
        FROM w GROUP BY lang),
mt_ AS (SELECT w.lang, CAST(count(DISTINCT lower(mr_.text)) AS BIGINT) AS mtypes
        FROM mr_ JOIN w USING (doc_id, tok_id) WHERE mr_.par_id = w.sent_id GROUP BY w.lang)""") + """
SELECT ws_.lang, tokens, tokens AS reconstructed_word_tokens, wt AS reconstructed_word_types, lemmas,
       mtok AS morpheme_tokens, mtypes AS morpheme_types, round(mtok / tokens, 6) AS morpheme_word_ratio
FROM ws_ JOIN mt_ USING (lang)""")
def a1_word_stats(spark, sf):
    docs = V.documents(spark, sf).select("doc_id", "lang", "text")
    return ST.word_stats(TEI.tei_words(TEI.tei_paragraphs(tei_documents(docs), None)), by=("lang",))


@register("p5_parse_misc", O.with_tok(_MISC_SQL.strip()) + """
SELECT doc_id, par_id, tok_id, form AS orig_text,
       CASE WHEN xpostag = 'NUM' THEN 'None' WHEN length(lemma) < length(form) AND xpostag = 'N' THEN lemma || '|' || lower(substr(form, length(lemma) + 1)) ELSE lemma END AS base_forms,
       CAST(CASE WHEN xpostag = 'N' AND length(lemma) < length(form) THEN 2 ELSE 1 END AS BIGINT) AS n_base_forms,
       CASE WHEN xpostag = 'NUM' THEN 'zxx' END AS word_lang
FROM cf_ WHERE misc <> '_'""")
def p5_parse_misc(spark, sf):
    c = _conllu_rows(spark, sf).filter(F.col("misc") != "_")
    pm = TX.computed(c, ["doc_id", "par_id", "tok_id"], pm=P.parse_misc(F.col("misc"), F.col("form")))
    return pm.select("doc_id", "par_id", "tok_id", F.col("pm.orig_text").alias("orig_text"),
                     F.array_join("pm.base_forms", "|").alias("base_forms"),
                     F.size("pm.base_forms").cast("bigint").alias("n_base_forms"),
                     F.col("pm.word_lang").alias("word_lang"))


_SEG_SQL = """
sl_ AS (SELECT doc_id, par_id, tok_id, lower(form) AS form_l, 'pos=' || xpostag AS pos, lower(lemma) AS lemma_l,
               lower(CASE WHEN xpostag = 'NUM' THEN 'None' WHEN xpostag = 'N' AND length(lemma) < length(form)
                          THEN lemma || '|' || lower(substr(form, length(lemma) + 1)) ELSE lemma END) AS bf
        FROM cf_ WHERE xpostag NOT IN ('PUNCT', '_') AND form IS NOT NULL AND length(form) > 0)"""


@register("p6_seg", O.with_tok(_MISC_SQL.strip(), _SEG_SQL.strip())
          + "SELECT doc_id, par_id, tok_id, form_l AS source, pos, bf AS target FROM sl_")
def p6_seg(spark, sf):
    return P.seg_lem(_conllu_rows(spark, sf), keys=("doc_id", "par_id", "tok_id"))[0]


@register("p6_lem", O.with_tok(_MISC_SQL.strip(), _SEG_SQL.strip())
          + "SELECT doc_id, par_id, tok_id, bf AS source, pos, lemma_l AS target FROM sl_")
def p6_lem(spark, sf):
    return P.seg_lem(_conllu_rows(spark, sf), keys=("doc_id", "par_id", "tok_id"))[1]


@register("j4_noisy_merge", O.with_tok(_MISC_SQL.strip(), _SEG_SQL.strip()) + f"""
SELECT doc_id, par_id, tok_id,
       substr(CASE WHEN length(regexp_replace(form_l, {O.q(SUFFIX_PATTERN)}, '\\1')) < length(form_l)
                   THEN regexp_replace(form_l, {O.q(SUFFIX_PATTERN)}, '\\1') || '|' || substr(form_l, length(regexp_replace(form_l, {O.q(SUFFIX_PATTERN)}, '\\1')) + 1)
                   ELSE form_l END, 1, 45) AS base_forms,
       pos, lemma_l AS target FROM sl_""")
def j4_noisy_merge(spark, sf):
    from ..sources.corpus import strip_suffix
    keys = ["doc_id", "par_id", "tok_id"]
    seg, lem = P.seg_lem(_conllu_rows(spark, sf), keys=keys)
    stem = strip_suffix(F.col("source"))
    pseg = F.when(F.length(stem) < F.length("source"),
                  F.concat(stem, F.lit("|"), F.substring(F.col("source"), F.length(stem) + 1, 1 << 30))
                  ).otherwise(F.col("source"))
    pred = seg.select(*keys, pseg.alias("pseg"))
    lem = lem.select(*keys, F.col("source").alias("base_forms"), "pos", "target")
    return jn.noisy_merge(pred, lem, keys, width=45)  # the reference data's cut


@register("w1_number_tokens", O.with_tok() + """
SELECT doc_id, sent_id, tok_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY sent_id, tok_id) AS BIGINT) AS running_id
FROM tok""")
def w1_number_tokens(spark, sf):
    return WN.number_tokens(V.tok(spark, sf).select("doc_id", "sent_id", "tok_id"))


@register("w2_split_sentences", O.with_tok("""
is_ AS (SELECT doc_id, sent_id, tok_id, form, CAST(coalesce(sum(CASE WHEN form = '.' AND xpostag = 'PUNCT' THEN 1 ELSE 0 END)
        OVER (PARTITION BY doc_id, sent_id ORDER BY tok_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1 AS BIGINT) AS sent_in_par
        FROM tok)""") + """
SELECT doc_id, sent_id, tok_id, form, sent_in_par,
       CAST(row_number() OVER (PARTITION BY doc_id, sent_id, sent_in_par ORDER BY tok_id) AS BIGINT) AS tok_in_sent FROM is_""")
def w2_split_sentences(spark, sf):
    return WN.split_sentences(V.tok(spark, sf).select("doc_id", "sent_id", "tok_id", "form", "xpostag")).drop("xpostag")


@register("s6_read_cell_xml", O.with_tok(_MISC_SQL.strip()) + """,
c_ AS (SELECT doc_id, par_id, tok_id, form, lemma, xpostag, feats, misc,
              CAST(row_number() OVER (PARTITION BY doc_id ORDER BY par_id, tok_id) AS BIGINT) AS line_id
       FROM cf_ WHERE xpostag <> 'PUNCT')
SELECT doc_id AS text_name, line_id, form, lemma, xpostag, feats,
       regexp_extract(misc, 'baseForms=([^,]*)', 1) AS base_forms
FROM c_ WHERE xpostag <> 'NUM'""")
def s6_read_cell_xml(spark, sf):
    t = _tei_tokens(spark, sf).filter(F.col("item").isNotNull())
    cells = t.select(F.col("doc_id").alias("text_name"), "par_id", "tok_id", "lang", F.col("item").alias("xml"))
    out = TEI.read_cell_xml(cells, F.col("lang"), order=("par_id", "tok_id"), chunk=F.col("par_id"))
    return out.select("text_name", "line_id", "form", "lemma", "xpostag", "feats", "base_forms")


# ------------------------------------------------------- spelling and formats

from ..functions import rules as R  # noqa: E402
from ..functions import text as TX  # noqa: E402


def orthography_of_source(source):
    """Driver documents carry no text ids; each source is given one of the six
    rule sets by its number."""
    num = F.coalesce(F.regexp_extract(source, r"([0-9]+)", 1).try_cast("int"), F.lit(0))
    return F.element_at(F.array(*[F.lit(o) for o in R.ORTHOGRAPHIES]), F.pmod(num, F.lit(6)) + 1)


_ORTH_SQL = ("list_extract([" + ", ".join(O.q(o) for o in R.ORTHOGRAPHIES) + "], "
             "(coalesce(TRY_CAST(regexp_extract(source, '([0-9]+)', 1) AS INTEGER), 0) % 6) + 1)")


def _map_sql(m: dict) -> str:
    return "MAP {" + ", ".join(f"{O.q(k)}: {O.q(m[k])}" for k in sorted(m)) + "}"


_FORMS_CTE = f"d_ AS (SELECT DISTINCT {_ORTH_SQL} AS orthography, form FROM w)"


def _normalise_sql() -> str:
    """Rows of ``_FORMS_CTE`` with the normalised form."""
    parts = []
    for o in R.ORTHOGRAPHIES:
        first, full = R.rewrite_maps(o)
        m1, m2 = _map_sql(first), _map_sql(full)
        p1, p2 = O.q(R.alternation(first.keys())), O.q(R.alternation(full.keys()))
        parts.append(f"""
SELECT orthography, form, CASE WHEN len(list_filter(pc1, lambda x: NOT map_contains({m1}, x))) = 0
                                AND len(list_filter(pc2, lambda x: NOT map_contains({m2}, x))) = 0
                               THEN array_to_string(list_transform(pc2, lambda x: {m2}[x]), '') ELSE form END AS normalised
FROM (SELECT *, regexp_extract_all(o1, {p2}) AS pc2 FROM
       (SELECT *, array_to_string(list_transform(pc1, lambda x: coalesce({m1}[x], '')), '') AS o1 FROM
         (SELECT orthography, form, regexp_extract_all(form, {p1}) AS pc1 FROM d_ WHERE orthography = {O.q(o)})))""")
    return "\nUNION ALL\n".join(parts)


@register("t1_normalise", O.with_tok(_FORMS_CTE) + _normalise_sql())
def t1_normalise(spark, sf):
    w = V.wtok(spark, sf)
    d = w.select(orthography_of_source(F.col("source")).alias("orthography"), "form").distinct()
    return d.select("orthography", "form", TX.normalise(F.col("form"), F.col("orthography")).alias("normalised"))


@register("s4_conllu_normalised", O.with_tok(_FORMS_CTE, f"norm_ AS ({_normalise_sql()})", _MISC_SQL.strip()) + f"""
SELECT cf_.doc_id, cf_.par_id, cf_.tok_id, CASE WHEN cf_.xpostag = 'PUNCT' THEN cf_.form ELSE norm_.normalised END AS form, cf_.misc
FROM cf_ JOIN documents USING (doc_id) LEFT JOIN norm_ ON norm_.orthography = {_ORTH_SQL} AND norm_.form = cf_.form""")
def s4_conllu_normalised(spark, sf):
    """FORM by the orthography of the document, ``origText`` as written."""
    docs = V.documents(spark, sf).select(
        F.struct("doc_id", orthography_of_source(F.col("source")).alias("orthography")).alias("doc_id"), "lang", "text")
    toks = TEI.tei_tokens(TEI.tei_paragraphs(tei_documents(docs), None))
    return TEI.conllu_fields(toks, orthography=F.col("doc_id.orthography")).select(
        "doc_id.doc_id", "par_id", "tok_id", "form", "misc")


@register("t2_preclean", O.with_tok() + f"""
SELECT form, translate(lower(translate({"".join("replace(" for _ in TX.PRECLEAN_MULTI)}form{"".join(f", {O.q(a)}, {O.q(b)})" for a, b in TX.PRECLEAN_MULTI)},
       {O.q(TX.PRECLEAN_FROM)}, {O.q(TX.PRECLEAN_TO)})), {O.q(TX.PRECLEAN_FROM)}, {O.q(TX.PRECLEAN_TO)}) AS cleaned
FROM (SELECT DISTINCT form FROM w)""")
def t2_preclean(spark, sf):
    d = V.wtok(spark, sf).select("form").distinct()
    return d.select("form", TX.preclean(F.col("form")).alias("cleaned"))


def _chars_sql(x: str) -> str:
    return f"array_to_string({O.chars_sql(x)}, ' ')"


@register("t3_to_chars", O.with_tok() + f"""
SELECT doc_id, sent_id, tok_id, '<w> ' || {_chars_sql("replace(lform, ' ', '_')")} || ' <\\w>' AS char_line FROM w""")
def t3_to_chars(spark, sf):
    w = V.wtok(spark, sf)
    return w.select("doc_id", "sent_id", "tok_id",
                    TX.to_chars(F.replace(F.col("lform"), F.lit(" "), F.lit(TX.SPACE_MARK))).alias("char_line"))


@register("t4_from_chars", O.with_tok("""
ch_ AS (SELECT doc_id, sent_id, tok_id, lform, lemma, xpostag,
               '<w> ' || """ + _chars_sql("lform") + """ || ' <\\w>' AS cf,
               '<w> ' || """ + _chars_sql("lemma") + """ || ' <\\w>' AS cl FROM w)""") + """
SELECT doc_id, sent_id, tok_id, xpostag AS pos,
       replace(array_to_string(list_slice(string_split(cf, ' '), 2, len(string_split(cf, ' ')) - 1), ''), '_', ' ') AS form,
       replace(array_to_string(list_slice(string_split(cl, ' '), 2, len(string_split(cl, ' ')) - 1), ''), '_', ' ') AS lemma,
       lform = replace(array_to_string(list_slice(string_split(cf, ' '), 2, len(string_split(cf, ' ')) - 1), ''), '_', ' ') AS round_trip
FROM ch_""")
def t4_from_chars(spark, sf):
    w = V.wtok(spark, sf)
    c = w.select("doc_id", "sent_id", "tok_id", "lform", "xpostag",
                 TX.to_chars(F.col("lform")).alias("cf"), TX.to_chars(F.col("lemma")).alias("cl"))
    return c.select("doc_id", "sent_id", "tok_id", F.col("xpostag").alias("pos"),
                    TX.from_chars(F.col("cf")).alias("form"), TX.from_chars(F.col("cl")).alias("lemma"),
                    (F.col("lform") == TX.from_chars(F.col("cf"))).alias("round_trip"))


@register("s14_to_parallel", O.with_tok() + """
SELECT doc_id, sent_id,
       coalesce(string_agg(replace(lower(form), ' ', '_'), ' ' ORDER BY tok_id) FILTER (WHERE xpostag <> 'PUNCT'), '') AS src,
       coalesce(string_agg(lower(lemma), ' ' ORDER BY tok_id) FILTER (WHERE xpostag <> 'PUNCT'), '') AS tgt,
       coalesce(string_agg(xpostag, ' ' ORDER BY tok_id) FILTER (WHERE xpostag <> 'PUNCT'), '') AS pos
FROM tok GROUP BY doc_id, sent_id""")
def s14_to_parallel(spark, sf):
    from ..sources.formats import to_parallel
    return to_parallel(V.tok(spark, sf))


# ------------------------------------------------------------ feature bundles

from ..operators import features as FT  # noqa: E402
from ..operators import sampling as SM  # noqa: E402
from ..operators import setops as SO  # noqa: E402


def _fval_sql(feats: str, k: str) -> str:
    return f"nullif(regexp_extract(',' || {feats} || ',', ',' || {k} || '=([^,]*),', 1), '')"


KEYS_CTE = """
keys_ AS (SELECT list_sort(list(DISTINCT k)) AS keys
          FROM (SELECT unnest(list_transform(string_split(feats, ','), lambda kv: split_part(kv, '=', 1))) AS k FROM ex))"""


def _morph_sql(feats: str) -> str:
    return (f"array_to_string(list_transform(keys, lambda k: k || '=' || coalesce({_fval_sql(feats, 'k')}, '%')), ':')")


@register("t6_parse_feats", O.with_tok() + f"""
SELECT feats, CAST(len(string_split(feats, ',')) AS BIGINT) AS n_keys, {_fval_sql('feats', "'pos'")} AS pos,
       {_fval_sql('feats', "'lang'")} AS lang, {_fval_sql('feats', "'sfx'")} AS sfx
FROM (SELECT DISTINCT feats FROM ex)""")
def t6_parse_feats(spark, sf):
    d = V.examples(spark, sf).select("feats").distinct()
    m = TX.parse_feats(F.col("feats"))
    return d.select("feats", F.size(m).cast("bigint").alias("n_keys"),
                    *[F.try_element_at(m, F.lit(k)).alias(k) for k in ("pos", "lang", "sfx")])


@register("t7_morph_string", O.with_tok(KEYS_CTE.strip()) + f"""
SELECT feats, {_morph_sql('feats')} AS morph FROM (SELECT DISTINCT feats FROM ex), keys_""")
def t7_morph_string(spark, sf):
    d = materialise(V.examples(spark, sf).select("feats").distinct())
    return FT.with_morph(d, FT.feature_types(d))


@register("t8_sort_feats", O.with_tok() + """
SELECT feats, array_to_string(list_sort(string_split(feats, ',')), ',') AS sorted_feats FROM (SELECT DISTINCT feats FROM ex)""")
def t8_sort_feats(spark, sf):
    d = V.examples(spark, sf).select("feats").distinct()
    return d.select("feats", TX.sort_feats(F.col("feats")).alias("sorted_feats"))


_SP = lambda x: f"array_to_string({O.chars_sql(x)}, ' ')"


@register("t9_morphtrans", O.with_tok(KEYS_CTE.strip(), f"""
mt_ AS (SELECT lemma, feats, word, '<s> ' || {_SP('lemma')} || ' </s>|<s> ' || {_SP('word')} || ' </s>|' || {_morph_sql('feats')} AS line
        FROM (SELECT DISTINCT lemma, feats, word FROM ex), keys_)""") + """
SELECT lemma, feats, word, line,
       trim(replace(replace(replace(string_split(line, '|')[1], '<s>', ''), '</s>', ''), ' ', '')) AS back_lemma,
       trim(replace(replace(replace(string_split(line, '|')[2], '<s>', ''), '</s>', ''), ' ', '')) AS back_word,
       array_to_string(list_sort(list_filter(string_split(replace(trim(string_split(line, '|')[3]), ':', ','), ','),
                                             lambda f: NOT contains(f, '%'))), ',') AS back_feats
FROM mt_""")
def t9_morphtrans(spark, sf):
    ex = V.examples(spark, sf)
    d = FT.with_morph(ex.select("lemma", "feats", "word").distinct(), FT.feature_types(ex))
    line = TX.to_morphtrans(F.col("lemma"), F.col("word"), F.col("morph"))
    b = TX.from_morphtrans(line)
    return d.select("lemma", "feats", "word", line.alias("line"), b["lemma"].alias("back_lemma"),
                    b["prediction"].alias("back_word"), b["feats"].alias("back_feats"))


@register("t10_med", O.with_tok() + f"""
SELECT lemma, feats, word,
       array_to_string(list_concat(list_sort(string_split(feats, ',')), {O.chars_sql('lemma')}), ' ') AS source,
       {_SP('word')} AS target, word AS back
FROM (SELECT DISTINCT lemma, feats, word FROM ex)""")
def t10_med(spark, sf):
    d = V.examples(spark, sf).select("lemma", "feats", "word").distinct()
    m = TX.to_med(F.col("lemma"), TX.parse_feats(F.col("feats")), F.col("word"))
    return d.select("lemma", "feats", "word", m["source"].alias("source"), m["target"].alias("target"),
                    TX.from_med(F.concat(m["target"], F.lit(" " + TX.MED_END))).alias("back"))


VOCAB_CTE = """
sy_ AS (SELECT unnest(""" + O.chars_sql("lemma") + """) AS symbol FROM ex
        UNION SELECT unnest(""" + O.chars_sql("word") + """) FROM ex
        UNION SELECT unnest(string_split(feats, ',')) FROM ex
        UNION SELECT split_part(unnest(string_split(feats, ',')), '=', 1) || '=NULL' FROM ex),
vocab AS (SELECT symbol, CAST(row_number() OVER (ORDER BY symbol) AS BIGINT) AS idx FROM (SELECT DISTINCT symbol FROM sy_))"""


@register("a16_vocab", O.with_tok(VOCAB_CTE.strip()) + "SELECT symbol, idx FROM vocab")
def a16_vocab(spark, sf):
    return FT.build_vocab(V.examples(spark, sf))


@register("t11_encode", O.with_tok(VOCAB_CTE.strip(), KEYS_CTE.strip(), """
d_ AS (SELECT DISTINCT word, feats FROM ex),
vm_ AS (SELECT map_from_entries(list({'key': symbol, 'value': idx})) AS vm FROM vocab)""") + f"""
SELECT word, feats,
  array_to_string(list_transform({O.chars_sql('word')}, lambda c: vm[c]), ' ') AS word_idx,
  array_to_string(list_transform(keys, lambda k: vm[k || '=' || coalesce({_fval_sql('feats', 'k')}, 'NULL')]), ' ') AS feat_idx
FROM d_, keys_, vm_""")
def t11_encode(spark, sf):
    # the distinct examples are all that the vocabulary, the feature names and the encoding need
    ex = materialise(V.examples(spark, sf).select("lemma", "feats", "word").distinct())
    vocab = FT.build_vocab(ex)
    e = FT.encode(ex.select("word", "feats").distinct(), vocab, "word", keys=FT.feature_types(ex))
    return e.select("word", "feats", F.array_join("word_idx", " ").alias("word_idx"),
                    F.array_join("feat_idx", " ").alias("feat_idx"))


@register("a9_count_values", O.with_tok() + "SELECT feats AS value, CAST(count(*) AS BIGINT) AS n FROM ex GROUP BY feats")
def a9_count_values(spark, sf):
    return ST.count_values(V.examples(spark, sf), "feats")


@register("a10_cluster_sizes", O.with_tok() + f"""
SELECT CASE WHEN grouping(c) = 1 THEN 'ALL' ELSE c END AS cluster, CAST(count(*) AS BIGINT) AS n
FROM (SELECT 'pos=' || coalesce({_fval_sql('feats', "'pos'")}, '%') AS c FROM ex) GROUP BY ROLLUP (c)""")
def a10_cluster_sizes(spark, sf):
    return FT.cluster_sizes(V.examples(spark, sf))


@register("a11_morph_type_stats", O.with_tok(KEYS_CTE.strip(), f"""
m_ AS (SELECT {_morph_sql('feats')} AS morph FROM ex, keys_),
p_ AS (SELECT morph, count(*) AS n FROM m_ GROUP BY morph)""") + """
SELECT CAST(count(*) AS BIGINT) AS morph_types, CAST(sum(n) AS BIGINT) AS examples, round(avg(n), 6) AS examples_per_type,
       (SELECT CAST(len(keys) AS BIGINT) FROM keys_) AS feature_types FROM p_""")
def a11_morph_type_stats(spark, sf):
    return FT.morph_type_stats(V.examples(spark, sf))


@register("a12_change_profile", O.with_tok(f"""
d_ AS (SELECT 'pos=' || xpostag AS cluster, word AS xi, lemma AS xo, count(*) AS n FROM ex GROUP BY ALL),
f_ AS (SELECT cluster, n, xi = xo AS same,
              xi <> xo AND contains(xo, xi) AS inside,
              replace(xo, xi, '') AS r,
              CASE WHEN xi = xo THEN 0 ELSE len(list_filter({O.chars_sql('xi')}, lambda c: NOT contains(xo, c))) END AS dels,
              CASE WHEN xi = xo THEN 0 ELSE {O.lev_sql('xi', 'xo')} END AS dist, xi, xo FROM d_),
g_ AS (SELECT cluster, n, same, inside AND r || xi = xo AS pre, inside AND xi || r = xo AS suf,
              inside AND r || xi <> xo AND xi || r <> xo AS circ, NOT same AND NOT inside AS oth, dels, dist FROM f_)""") + """
SELECT CASE WHEN grouping(cluster) = 1 THEN 'AGG' ELSE cluster END AS cluster, CAST(sum(n) AS BIGINT) AS n,
       CAST(sum(CASE WHEN pre THEN n ELSE 0 END) AS BIGINT) AS prefix, CAST(sum(CASE WHEN suf THEN n ELSE 0 END) AS BIGINT) AS suffix,
       CAST(sum(CASE WHEN same THEN n ELSE 0 END) AS BIGINT) AS same, CAST(sum(CASE WHEN circ THEN n ELSE 0 END) AS BIGINT) AS circumfix,
       CAST(sum(CASE WHEN oth THEN n ELSE 0 END) AS BIGINT) AS other,
       round(sum(dist * n) / sum(n), 6) AS mean_distance, round(sum(dels * n) / sum(n), 6) AS mean_deleted
FROM g_ GROUP BY ROLLUP (cluster)""")
def a12_change_profile(spark, sf):
    ex = V.examples(spark, sf).withColumn("cluster", F.concat(F.lit("pos="), F.col("xpostag")))
    return FT.change_profile(ex, "word", "lemma", "cluster")


PROFILE_TAGS = ("pos=N", "pos=NP")


@register("a18_profile", O.with_tok(KEYS_CTE.strip(), f"""
m_ AS (SELECT {_morph_sql('feats')} AS morph FROM ex, keys_)""") + """
SELECT CAST(count(*) AS BIGINT) AS examples, CAST(count(DISTINCT morph) AS BIGINT) AS morph_types,
       CAST(count(DISTINCT CASE WHEN contains(morph, 'pos=N') THEN morph END) AS BIGINT) AS types_pos_n,
       CAST(count(DISTINCT CASE WHEN contains(morph, 'pos=NP') THEN morph END) AS BIGINT) AS types_pos_np
FROM m_""")
def a18_profile(spark, sf):
    return FT.profile(V.examples(spark, sf), PROFILE_TAGS)


# --------------------------------------------------- sets, samples, lookups

@register("u1_merge_splits", O.with_tok() + """
SELECT doc_id, sent_id, tok_id, split, lemma, feats, word FROM ex WHERE split IN ('train', 'valid')""")
def u1_merge_splits(spark, sf):
    ex = V.examples(spark, sf).select("doc_id", "sent_id", "tok_id", "split", "lemma", "feats", "word")
    return SO.merge_splits(ex.filter(F.col("split") == "train"), ex.filter(F.col("split") == "valid"))


@register("u2_mirror", O.with_tok("""
t2_ AS (SELECT DISTINCT 'form=lemma' AS source_feats, lemma AS source, feats AS target_feats, word AS target FROM ex)""") + """
SELECT source_feats, source, target_feats, target, false AS mirrored FROM t2_
UNION ALL SELECT target_feats, target, source_feats, source, true FROM t2_""")
def u2_mirror(spark, sf):
    ex = V.examples(spark, sf)
    t2 = ex.select(F.lit("form=lemma").alias("source_feats"), F.col("lemma").alias("source"),
                   F.col("feats").alias("target_feats"), F.col("word").alias("target")).distinct()
    return SO.mirror(t2, [("source", "target"), ("source_feats", "target_feats")])


SPLIT_SEED = 5


@register("w3_split_exact", O.with_tok("""
k_ AS (SELECT DISTINCT doc_id, sent_id FROM tok),
r_ AS (SELECT doc_id, sent_id, CAST(row_number() OVER (ORDER BY md5('""" + str(SPLIT_SEED) + """:' || doc_id || '_' || sent_id),
                                       CAST(doc_id AS VARCHAR) || '_' || CAST(sent_id AS VARCHAR)) AS BIGINT) AS rank,
              count(*) OVER () AS n FROM k_)""") + """
SELECT doc_id, sent_id, rank,
       CASE WHEN rank <= round_even(n * 0.1, 0) THEN 'test'
            WHEN rank <= round_even(n * 0.1, 0) + round_even(n * 0.1, 0) THEN 'valid' ELSE 'train' END AS split
FROM r_""")
def w3_split_exact(spark, sf):
    return SM.split_exact(V.tok(spark, sf), ["doc_id", "sent_id"], 0.1, 0.1, SPLIT_SEED)


@register("w3_split_select", O.with_tok("""
k_ AS (SELECT DISTINCT doc_id, sent_id FROM tok),
r_ AS (SELECT doc_id, sent_id, row_number() OVER (ORDER BY md5('""" + str(SPLIT_SEED) + """:' || doc_id || '_' || sent_id),
                                       CAST(doc_id AS VARCHAR) || '_' || CAST(sent_id AS VARCHAR)) AS rank,
              count(*) OVER () AS n FROM k_)""") + """
SELECT doc_id, sent_id,
       CASE WHEN rank <= round_even(n * 0.15, 0) THEN 'test'
            WHEN rank <= round_even(n * 0.15, 0) + round_even(n * 0.05, 0) THEN 'valid' ELSE 'train' END AS split
FROM r_""")
def w3_split_select(spark, sf):
    return SM.split_exact(V.tok(spark, sf), ["doc_id", "sent_id"], 0.15, 0.05, SPLIT_SEED, rank=False)


SAMPLE_SIZES = (500, 1000, 2000, 5000, 12000)


@register("w4_nested_samples", O.with_tok("""
r_ AS (SELECT doc_id, sent_id, tok_id, row_number() OVER (ORDER BY md5('""" + str(SPLIT_SEED) + """:' || doc_id || '_' || sent_id || '_' || tok_id),
                                       doc_id || '_' || sent_id || '_' || tok_id) AS rank FROM ex)""") + """
SELECT doc_id, sent_id, tok_id, CAST(rank AS BIGINT) AS rank, CAST(s AS INTEGER) AS sample_size
FROM r_, (SELECT unnest([""" + ", ".join(map(str, SAMPLE_SIZES)) + """]) AS s) sz WHERE rank <= s""")
def w4_nested_samples(spark, sf):
    ex = V.examples(spark, sf).select("doc_id", "sent_id", "tok_id")
    key = F.concat_ws("_", "doc_id", "sent_id", "tok_id")
    return SM.nested_samples(ex, key, SAMPLE_SIZES, SPLIT_SEED)


QUOTAS = {"N": (2500, 500, 500), "P": (2500, 500, 500), "NP": (750, 150, 150), "NUM": (100, 20, 20)}


@register("w5_split_stratified", O.with_tok("""
q_ AS (SELECT * FROM (VALUES """ + ", ".join(f"('{k}', {a}, {b}, {c})" for k, (a, b, c) in QUOTAS.items()) + """) AS t(xpostag, qa, qb, qc)),
r_ AS (SELECT doc_id, sent_id, tok_id, xpostag,
              row_number() OVER (PARTITION BY xpostag ORDER BY md5('""" + str(SPLIT_SEED) + """:' || doc_id || '_' || sent_id || '_' || tok_id),
                                 doc_id || '_' || sent_id || '_' || tok_id) AS rank FROM ex)""") + """
SELECT doc_id, sent_id, tok_id, xpostag, CAST(rank AS INTEGER) AS rank,
       CASE WHEN rank <= qa THEN 'train' WHEN rank <= qa + qb THEN 'dev' ELSE 'test' END AS role
FROM r_ JOIN q_ USING (xpostag) WHERE rank <= qa + qb + qc""")
def w5_split_stratified(spark, sf):
    ex = V.examples(spark, sf).select("doc_id", "sent_id", "tok_id", "xpostag")
    key = F.concat_ws("_", "doc_id", "sent_id", "tok_id")
    return SM.split_stratified(ex, "xpostag", key, QUOTAS, SPLIT_SEED)


@register("w6_head_per_group", """
SELECT label, vec_id, CAST(rn AS INTEGER) AS rn FROM (
  SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS rn FROM embeddings) WHERE rn <= 20""")
def w6_head_per_group(spark, sf):
    e = table(spark, sf, "embeddings").select("label", "vec_id")
    return SM.head_per_group(e, "label", ["vec_id"], 20)


@register("w7_top_k", O.with_tok() + """
SELECT lform, lemma, n, CAST(rank AS INTEGER) AS rank FROM (
  SELECT lform, lemma, n, row_number() OVER (PARTITION BY lform ORDER BY n DESC, lemma) AS rank
  FROM (SELECT lform, lemma, CAST(count(*) AS BIGINT) AS n FROM w WHERE split = 'train' GROUP BY ALL)) WHERE rank <= 3""")
def w7_top_k(spark, sf):
    c = V.wtok(spark, sf).filter(F.col("split") == "train").groupBy("lform", "lemma").agg(
        F.count(F.lit(1)).alias("n"))
    return SM.top_k(c, ["lform"], "n", 3, tie=[F.col("lemma")])


@register("w8_char_context", O.with_tok("""
d_ AS (SELECT DISTINCT word FROM ex),
c_ AS (SELECT word, """ + O.chars_sql("word") + """ AS cs FROM d_),
e_ AS (SELECT word, cs, unnest(generate_series(1, len(cs))) AS i FROM c_)""") + """
SELECT coalesce(cs[i - 1], '_') AS prev, cs[i] AS char, CASE WHEN i < len(cs) THEN cs[i + 1] ELSE '_' END AS next,
       CAST(count(*) AS BIGINT) AS n
FROM e_ GROUP BY ALL""")
def w8_char_context(spark, sf):
    d = V.examples(spark, sf).select("word").distinct()
    c = WN.char_context(d, "word")
    return c.groupBy("prev", "char", "next").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@register("j5_match_inflections", O.with_tok("""
b_ AS (SELECT DISTINCT lemma AS base FROM ex WHERE split = 'test'),
i_ AS (SELECT DISTINCT lemma AS base, feats, word AS inflected FROM ex WHERE split = 'train')""") + """
SELECT base, feats, inflected FROM b_ JOIN i_ USING (base)""")
def j5_match_inflections(spark, sf):
    ex = V.examples(spark, sf)
    base = ex.filter(F.col("split") == "test").select(F.col("lemma").alias("base")).distinct()
    infl = ex.filter(F.col("split") == "train").select(F.col("lemma").alias("base"), "feats",
                                                       F.col("word").alias("inflected")).distinct()
    return jn.match_inflections(base, infl)[0].select("base", "feats", "inflected")


@register("j5_missing_bases", O.with_tok("""
b_ AS (SELECT DISTINCT lemma AS base FROM ex WHERE split = 'test')""") + """
SELECT base FROM b_ WHERE base NOT IN (SELECT lemma FROM ex WHERE split = 'train')""")
def j5_missing_bases(spark, sf):
    ex = V.examples(spark, sf)
    base = ex.filter(F.col("split") == "test").select(F.col("lemma").alias("base")).distinct()
    infl = ex.filter(F.col("split") == "train").select(F.col("lemma").alias("base"), "feats",
                                                       F.col("word").alias("inflected"))
    return jn.match_inflections(base, infl)[1]


@register("j6_attach_predictions", O.with_tok("""
p_ AS (SELECT lemma, feats AS morph, word AS prediction FROM (
         SELECT lemma, feats, word, row_number() OVER (PARTITION BY lemma, feats ORDER BY doc_id DESC, sent_id DESC, tok_id DESC) AS r
         FROM ex WHERE split = 'train') WHERE r = 1)""") + """
SELECT t.doc_id, t.sent_id, t.tok_id, t.lemma, t.feats AS morph, coalesce(p_.prediction, 'ERROR') AS prediction
FROM ex t LEFT JOIN p_ ON p_.lemma = t.lemma AND p_.morph = t.feats WHERE t.split = 'test'""")
def j6_attach_predictions(spark, sf):
    ex = V.examples(spark, sf)
    test = ex.filter(F.col("split") == "test").select("doc_id", "sent_id", "tok_id", "lemma", F.col("feats").alias("morph"))
    pred = ex.filter(F.col("split") == "train").select(
        "lemma", F.col("feats").alias("morph"), F.col("word").alias("prediction"),
        F.struct("doc_id", "sent_id", "tok_id").alias("pred_pos"))
    return jn.attach_predictions(test, pred)


# ------------------------------------------------------- alignment jobs (M)

from ..operators import align as AL  # noqa: E402
from ..operators import lemmatiser as LM  # noqa: E402
from ..operators.projection import svd2  # noqa: E402


def _pairs(spark, sf):
    """Lemmatisation pairs: source = lower-cased form, target = lemma."""
    return V.examples(spark, sf).select(F.col("word").alias("source"), F.col("lemma").alias("target"),
                                        "split", "xpostag", "doc_id", "sent_id", "tok_id")


@register("m1_align_pad", O.with_tok() + """
SELECT source, target, rpad(source, CAST(greatest(length(source), length(target)) AS INTEGER), '~') AS aligned_source,
       rpad(target, CAST(greatest(length(source), length(target)) AS INTEGER), '~') AS aligned_target
FROM (SELECT DISTINCT word AS source, lemma AS target FROM ex)""")
def m1_align_pad(spark, sf):
    d = _pairs(spark, sf).select("source", "target").distinct()
    a, b = AL.align_pad(F.col("source"), F.col("target"))
    return d.select("source", "target", a.alias("aligned_source"), b.alias("aligned_target"))


@register("m2_align_med")
def m2_align_med(spark, sf):
    return AL.align_med(_pairs(spark, sf))


def _align_invariants(al):
    z = F.arrays_zip(TX.chars(F.col("aligned_source")).alias("x"), TX.chars(F.col("aligned_target")).alias("y"))
    mism = F.size(F.filter(z, lambda p: p["x"] != p["y"]))
    return al.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_pairs"),
        F.sum((F.replace(F.col("aligned_source"), F.lit("~"), F.lit("")) == F.col("source")).cast("int")).cast("bigint").alias("n_source_ok"),
        F.sum((F.replace(F.col("aligned_target"), F.lit("~"), F.lit("")) == F.col("target")).cast("int")).cast("bigint").alias("n_target_ok"),
        F.sum(F.col("cost")).cast("bigint").alias("total_cost"),
        F.sum((mism == F.col("cost")).cast("int")).cast("bigint").alias("n_cost_is_mismatches"))


@register("m2_align_invariants", O.with_tok("d_ AS (SELECT DISTINCT word AS source, lemma AS target FROM ex)") + f"""
SELECT CAST(count(*) AS BIGINT) AS n_pairs, CAST(count(*) AS BIGINT) AS n_source_ok, CAST(count(*) AS BIGINT) AS n_target_ok,
       CAST(sum({O.lev_sql('source', 'target')}) AS BIGINT) AS total_cost, CAST(count(*) AS BIGINT) AS n_cost_is_mismatches
FROM d_""")
def m2_align_invariants(spark, sf):
    return _align_invariants(AL.align_med(_pairs(spark, sf)))


@register("m3_align_corpus")
def m3_align_corpus(spark, sf):
    return AL.align_corpus(_pairs(spark, sf))


@register("m3_align_invariants", O.with_tok("d_ AS (SELECT DISTINCT word AS source, lemma AS target FROM ex)") + """
SELECT CAST(count(*) AS BIGINT) AS n_pairs, CAST(count(*) AS BIGINT) AS n_source_ok, CAST(count(*) AS BIGINT) AS n_target_ok,
       CAST(count(*) AS BIGINT) AS n_cost_is_columns, CAST(0 AS BIGINT) AS n_dearer_than_before
FROM d_""")
def m3_align_invariants(spark, sf):
    """Of the last round: unpadded sides equal the inputs, a pair's cost is the sum of
    its columns' prices, and no pair is dearer than it was aligned before, at the same
    prices (to 1e-9 of the cost: the sums run in another order)."""
    for counts, before, al in AL.corpus_rounds(_pairs(spark, sf)):
        pass
    own = AL.column_prices(al, counts).withColumnRenamed("price", "_own")
    old = AL.column_prices(before, counts).withColumnRenamed("price", "_old")
    slack = (F.abs("cost") + 1) * 1e-9
    j = al.join(own, ["source", "target"]).join(old, ["source", "target"])
    return j.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_pairs"),
        F.sum((F.replace(F.col("aligned_source"), F.lit("~"), F.lit("")) == F.col("source")).cast("int")).cast("bigint").alias("n_source_ok"),
        F.sum((F.replace(F.col("aligned_target"), F.lit("~"), F.lit("")) == F.col("target")).cast("int")).cast("bigint").alias("n_target_ok"),
        F.sum((F.abs(F.col("cost") - F.col("_own")) <= slack).cast("int")).cast("bigint").alias("n_cost_is_columns"),
        F.sum((F.col("cost") > F.col("_old") + slack).cast("int")).cast("bigint").alias("n_dearer_than_before"))


@register("m4_template_invariant", O.with_tok("d_ AS (SELECT DISTINCT word AS source, lemma AS target FROM ex)") + """
SELECT CAST(count(*) AS BIGINT) AS n_pairs, CAST(count(*) AS BIGINT) AS n_instantiate_ok FROM d_""")
def m4_template_invariant(spark, sf):
    t = LM.pair_templates(_pairs(spark, sf), "source", "target")
    return t.agg(F.count(F.lit(1)).cast("bigint").alias("n_pairs"),
                 F.sum((TX.instantiate(F.col("template"), F.col("source")) == F.col("target")).cast("int"))
                 .cast("bigint").alias("n_instantiate_ok"))


@register("m4_template_counts")
def m4_template_counts(spark, sf):
    p = _pairs(spark, sf)
    t = LM.pair_templates(p, "source", "target")
    rows = p.select("source", "target").join(t, ["source", "target"])
    return ST.count_values(rows, F.array_join("template", " "), "template")


@register("t12_instantiate", O.with_tok("""
d_ AS (SELECT DISTINCT word, lemma FROM ex),
t_ AS (SELECT word, lemma, list_concat(list_transform(range(0, length(lemma)), lambda i: CAST(i AS VARCHAR)), ['99', '#']) AS tpl FROM d_)""") + """
SELECT word, lemma, array_to_string(tpl, ' ') AS template,
       array_to_string(list_transform(tpl, lambda x: CASE WHEN regexp_matches(x, '^[0-9]+$')
            THEN (CASE WHEN CAST(x AS INTEGER) < length(word) THEN substr(word, CAST(x AS INTEGER) + 1, 1) ELSE '' END)
            ELSE x END), '') AS instantiated
FROM t_""")
def t12_instantiate(spark, sf):
    d = V.examples(spark, sf).select("word", "lemma").distinct()
    tpl = F.concat(F.transform(F.sequence(F.lit(0), F.length("lemma") - 1), lambda i: i.cast("string")),
                   F.array(F.lit("99"), F.lit("#")))
    tpl = F.when(F.length("lemma") > 0, tpl).otherwise(F.array(F.lit("99"), F.lit("#")))
    return d.select("word", "lemma", F.array_join(tpl, " ").alias("template"),
                    TX.instantiate(tpl, F.col("word")).alias("instantiated"))


def _replay(actions_col, source_col):
    """Replay an action sequence over the marked source; returns the written word."""
    marked = F.concat(F.lit("<"), source_col, F.lit(">"))
    init = F.struct(F.lit(0).alias("pos"), F.lit("").alias("out"))

    def step(st, a):
        pos, out = st["pos"], st["out"]
        is_num = a.rlike("^[0-9]+$")
        return F.struct(
            F.when(a == "^", pos + 1).otherwise(pos).alias("pos"),
            F.when((a == "^") | (a == ">"), out)
             .when(is_num, F.concat(out, F.substring(marked, F.when(is_num, a).cast("int") + 1, 1)))
             .otherwise(F.concat(out, a)).alias("out"))
    return F.aggregate(actions_col, init, step)["out"]


@register("m5_action_invariant", O.with_tok("d_ AS (SELECT DISTINCT word AS source, lemma AS target FROM ex)") + """
SELECT CAST(count(*) AS BIGINT) AS n_pairs, CAST(count(*) AS BIGINT) AS n_replay_ok FROM d_""")
def m5_action_invariant(spark, sf):
    acts = AL.actions_frame(AL.align_med(_pairs(spark, sf)))
    return acts.agg(F.count(F.lit(1)).cast("bigint").alias("n_pairs"),
                    F.sum((_replay(F.col("actions"), F.col("source")) == F.col("target")).cast("int"))
                    .cast("bigint").alias("n_replay_ok"))


@register("m5_actions")
def m5_actions(spark, sf):
    return AL.actions_frame(AL.align_med(_pairs(spark, sf))).select(
        "source", "target", F.array_join("actions", " ").alias("actions"))


@register("m6_vote", O.with_tok(O.MFL_CTE.strip(), """
c_ AS (SELECT w.doc_id, w.sent_id, w.tok_id, w.lform AS p FROM w WHERE w.split = 'test'
       UNION ALL SELECT w.doc_id, w.sent_id, w.tok_id, coalesce(m.mfl_lemma, w.lform) FROM w LEFT JOIN model m ON m.lform = w.lform WHERE w.split = 'test'
       UNION ALL SELECT doc_id, sent_id, tok_id, regexp_replace(lform, """ + O.q(SUFFIX_PATTERN) + """, '\\1') FROM w WHERE split = 'test'),
v_ AS (SELECT doc_id, sent_id, tok_id, p AS prediction, CAST(count(*) AS BIGINT) AS votes FROM c_ GROUP BY ALL)""") + """
SELECT doc_id, sent_id, tok_id, prediction, votes FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id, sent_id, tok_id
                               ORDER BY votes DESC, CASE WHEN votes = 1 THEN length(prediction) ELSE 0 END, prediction) AS r
  FROM v_) WHERE r = 1""")
def m6_vote(spark, sf):
    from ..sources.corpus import strip_suffix
    w = V.wtok(spark, sf)
    model = ev.fit_mfl(w.filter(F.col("split") == "train"))
    test = w.filter(F.col("split") == "test").select("doc_id", "sent_id", "tok_id", "lform")
    keys = ["doc_id", "sent_id", "tok_id"]
    # the three predictors of a token stand side by side: the vote needs no shuffle
    p = jn.predict_mfl(model, test).select(*keys, LM.vote_row(
        [F.col("lform"), F.col("plemma"), strip_suffix(F.col("lform"))]).alias("v"))
    return p.select(*keys, "v.prediction", "v.votes")


@register("m7_template_lemmatiser")
def m7_template_lemmatiser(spark, sf):
    p = _pairs(spark, sf)
    by_suffix, by_pos = LM.fit_templates(p.filter(F.col("split") == "train"), "source", "target", "xpostag")
    test = p.filter(F.col("split") == "test")
    pred = LM.apply_templates(test, "source", "xpostag", by_suffix, by_pos)
    return ev.micro_macro(pred.withColumn("ok", F.col("prediction") == F.col("target")), "xpostag")


@register("j7_template_coverage")
def j7_template_coverage(spark, sf):
    p = _pairs(spark, sf)
    return LM.template_coverage(p.filter(F.col("split") == "train"), p.filter(F.col("split") == "test"),
                                "source", "target")


@register("m8_svd2")
def m8_svd2(spark, sf):
    return svd2(table(spark, sf, "embeddings").select("vec_id", "label", "embedding"))


@register("m8_svd2_invariants", """
SELECT CAST(count(*) AS BIGINT) AS n_rows, true AS norms_are_singular_values, true AS columns_are_orthogonal, true AS descending
FROM embeddings""")
def m8_svd2_invariants(spark, sf):
    """Projected columns are orthogonal, their norms are the singular values (to 1e-6
    of the first), and those descend."""
    first, second = F.col("s")[0], F.col("s")[1]
    return m8_svd2(spark, sf).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"), F.sum(F.col("x1") * F.col("x1")).alias("a"), F.sum(F.col("x2") * F.col("x2")).alias("b"),
        F.sum(F.col("x1") * F.col("x2")).alias("ab"), F.first("singular_values").alias("s")).select(
        "n_rows", ((F.abs(F.sqrt("a") - first) <= first * 1e-6) & (F.abs(F.sqrt("b") - second) <= first * 1e-6)).alias("norms_are_singular_values"),
        (F.abs("ab") <= first * first * 1e-6).alias("columns_are_orthogonal"), (first >= second).alias("descending"))


@register("m10_report_invariants", O.with_tok("d_ AS (SELECT DISTINCT word AS source, lemma AS target FROM ex)") + """
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) AS BIGINT) AS n_index, CAST(1 AS BIGINT) AS first_index,
       CAST(count(*) AS BIGINT) AS last_index FROM d_""")
def m10_report_invariants(spark, sf):
    """The index of the report is dense: as many numbers as pairs, from 1 to their count."""
    return m10_alignment_report(spark, sf).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"), F.countDistinct("index").cast("bigint").alias("n_index"),
        F.min("index").alias("first_index"), F.max("index").alias("last_index"))


@register("m10_alignment_report")
def m10_alignment_report(spark, sf):
    return AL.alignment_report(AL.align_corpus(_pairs(spark, sf)))


# ------------------------------------------------------------------ lexicon

from ..operators import lexicon as LX  # noqa: E402


def analysis_code(lang, xpostag, sfx, tok_id):
    """Analysis codes given to the corpus words (a rule of ours): nouns
    ``NN-LANG-num`` (a sentence-initial bare noun gets a possessor group),
    suffixed verbs ``VB-LANG-S-3-SFX-QAL``, names ``DEF:NNP-LANG-S``,
    short words ``JJ-LANG-S``, numbers ``CD``."""
    L = F.upper(lang)
    return (F.when(xpostag == "NUM", F.lit("CD"))
             .when(xpostag == "NP", F.concat(F.lit("DEF:NNP-"), L, F.lit("-S")))
             .when(xpostag == "P", F.concat(F.lit("JJ-"), L, F.lit("-S")))
             .when(sfx.isin("ger", "ptcp", "agt"), F.concat(F.lit("VB-"), L, F.lit("-S-3-"), F.upper(sfx), F.lit("-QAL")))
             .when(sfx.isNotNull(), F.concat(F.lit("NN-"), L, F.when(sfx == "pl", F.lit("-P")).otherwise(F.lit("-S"))))
             .when(tok_id == 1, F.concat(F.lit("NN-"), L, F.lit("-S:S-"), L, F.lit("-P-3")))
             .otherwise(F.concat(F.lit("NN-"), L, F.lit("-S"))))


_ACODE_SQL = """CASE WHEN xpostag = 'NUM' THEN 'CD'
     WHEN xpostag = 'NP' THEN 'DEF:NNP-' || upper(lang) || '-S'
     WHEN xpostag = 'P' THEN 'JJ-' || upper(lang) || '-S'
     WHEN sfx IN ('ger', 'ptcp', 'agt') THEN 'VB-' || upper(lang) || '-S-3-' || upper(sfx) || '-QAL'
     WHEN sfx IS NOT NULL THEN 'NN-' || upper(lang) || CASE WHEN sfx = 'pl' THEN '-P' ELSE '-S' END
     WHEN tok_id = 1 THEN 'NN-' || upper(lang) || '-S:S-' || upper(lang) || '-P-3'
     ELSE 'NN-' || upper(lang) || '-S' END"""

LEX_CTE = f"""
la_ AS (SELECT DISTINCT lform AS word, {_ACODE_SQL} AS analysis, lemma
        FROM (SELECT *, {O.suffix_type_sql('lform', 'lemma')} AS sfx FROM w))"""


def _lexicon_lines(spark, sf):
    w = V.wtok(spark, sf)
    sfx = V.suffix_type(F.col("lform"), F.col("lemma"))
    a = w.select(F.col("lform").alias("word"), analysis_code(F.col("lang"), F.col("xpostag"), sfx, F.col("tok_id"))
                 .alias("analysis"), "lemma").distinct()
    g = a.groupBy("word").agg(F.array_sort(F.collect_list(F.struct("analysis", "lemma"))).alias("ps"))
    return g.select(F.concat_ws(" ", F.col("word"), F.array_join(
        F.transform("ps", lambda p: F.concat(p["analysis"], F.lit(" "), p["lemma"])), " ")).alias("line"))


@register("s11_read_lexicon", O.with_tok(LEX_CTE.strip()) + """
SELECT word, CAST(row_number() OVER (PARTITION BY word ORDER BY analysis, lemma) AS BIGINT) AS pair, analysis, lemma FROM la_""")
def s11_read_lexicon(spark, sf):
    return LX.read_lexicon(_lexicon_lines(spark, sf))


def _t13_sql(code: str) -> str:
    groups = f"list_filter(string_split({code}, ':'), lambda s: s <> '')"
    return f"""
SELECT analysis, g, string_split(g[1], '-') AS e0, CASE WHEN len(g) >= 2 THEN string_split(g[2], '-') ELSE [] END AS e1 FROM
  (SELECT analysis, {groups} AS g FROM (SELECT DISTINCT analysis FROM la_))"""


T13_SQL = O.with_tok(LEX_CTE.strip(), "a0_ AS (" + _t13_sql("analysis").strip() + ")", """
a1_ AS (SELECT analysis, len(g) AS ng, e0, e1, len(e0) AS n0, len(e1) AS n1, e0[1] AS t,
               len(g) = 1 AND len(e0) = 6 AND starts_with(e0[1], 'VB') AS vb,
               len(g) = 1 AND (starts_with(e0[1], 'JJ') OR starts_with(e0[1], 'NN')) AND len(e0) >= 3 AS an,
               len(g) = 2 AND starts_with(e0[1], 'DEF') AS de,
               len(g) = 2 AND starts_with(e0[1], 'NN') AS nn2 FROM a0_),
a2_ AS (SELECT analysis, e0[1] AS atype, list_filter([
   'binyan=' || CASE WHEN vb THEN e0[6] WHEN nn2 AND n0 >= 5 THEN e0[5] WHEN de AND n1 >= 5 THEN e1[5] END,
   'def=' || CASE WHEN de THEN 'DEF' END,
   'gen=' || CASE WHEN vb OR an THEN e0[2] WHEN nn2 AND n0 >= 3 THEN e0[2] WHEN de AND n1 >= 3 THEN e1[2] END,
   'num=' || CASE WHEN vb OR an THEN e0[3] WHEN nn2 AND n0 >= 3 THEN e0[3] WHEN de AND n1 = 2 THEN e1[2] WHEN de AND n1 >= 3 THEN e1[3] END,
   'per=' || CASE WHEN vb THEN e0[4] WHEN nn2 AND n0 >= 4 THEN e0[4] WHEN de AND n1 >= 4 THEN e1[4] END,
   'pos=' || CASE WHEN vb OR an THEN e0[1] WHEN nn2 AND n0 >= 3 THEN e0[1] WHEN de THEN e1[1] END,
   'poss_binyan=' || CASE WHEN nn2 AND n1 >= 5 THEN e1[5] END,
   'poss_gen=' || CASE WHEN nn2 AND n1 >= 3 THEN e1[2] END,
   'poss_num=' || CASE WHEN nn2 AND n1 >= 3 THEN e1[3] END,
   'poss_per=' || CASE WHEN nn2 AND n1 >= 4 THEN e1[4] END,
   'tense=' || CASE WHEN vb THEN e0[5] END], lambda x: x IS NOT NULL) AS fl FROM a1_)""")


@register("t13_parse_analysis", T13_SQL + """
SELECT analysis, array_to_string(fl, ',') AS features, CAST(len(fl) AS BIGINT) AS n_features FROM a2_""")
def t13_parse_analysis(spark, sf):
    codes = LX.read_lexicon(_lexicon_lines(spark, sf)).select("analysis").distinct()
    m = LX.parse_analysis(F.col("analysis"))
    return codes.select("analysis", LX.feature_string(m).alias("features"), F.size(m).cast("bigint").alias("n_features"))


@register("a17_lexicon_coverage", T13_SQL + """,
e_ AS (SELECT la_.word, la_.analysis, a2_.atype, a2_.fl,
              list_filter(a2_.fl, lambda x: starts_with(x, 'pos='))[1] AS posf FROM la_ JOIN a2_ USING (analysis))
SELECT 'type' AS kind, atype AS key, CAST(count(*) AS BIGINT) AS n, CAST(NULL AS DOUBLE) AS percent FROM e_ GROUP BY atype
UNION ALL
SELECT 'pos', substr(posf, 5), CAST(count(*) AS BIGINT), CAST(NULL AS DOUBLE) FROM e_ WHERE len(fl) > 1 GROUP BY posf
UNION ALL
SELECT 'total', 'parsed', CAST(sum(CASE WHEN len(fl) > 1 THEN 1 ELSE 0 END) AS BIGINT),
       round(sum(CASE WHEN len(fl) > 1 THEN 1 ELSE 0 END) * 100.0 / count(*), 6) FROM e_""")
def a17_lexicon_coverage(spark, sf):
    return LX.lexicon_coverage(LX.read_lexicon(_lexicon_lines(spark, sf)))


# ------------------------------------------------------ files and sinks

from ..session import materialise, shared_dir  # noqa: E402
from ..sources import conllu as CU  # noqa: E402
from ..sources import inflection as INF  # noqa: E402


@register("s12_s1_conllu_roundtrip", O.with_tok() + """
SELECT doc_id, sent_id, tok_id, form, lemma, CASE WHEN xpostag = 'PUNCT' THEN 'PUNCT' END AS upostag, xpostag FROM tok""")
def s12_s1_conllu_roundtrip(spark, sf):
    t = V.tok(spark, sf)
    rows = t.select("doc_id", "sent_id", "tok_id",
                    F.concat_ws("_", "doc_id", "sent_id", "tok_id").alias("id"), "form", "lemma",
                    F.when(F.col("xpostag") == "PUNCT", F.lit("PUNCT")).alias("upostag"), "xpostag",
                    *[F.lit(None).cast("string").alias(c) for c in ("feats", "head", "deprel", "deps", "misc")])
    path = shared_dir(spark, "conllu")
    CU.write_conllu(rows, path, compression="gzip")
    back = CU.read_conllu(spark, path)
    return back.select(F.col("text_id").cast("bigint").alias("doc_id"), F.col("line_id").alias("sent_id"),
                       "tok_id", "form", "lemma", "upostag", "xpostag")


@register("s7_predictions_roundtrip", O.with_tok(O.PRED_CTE.strip()) + """
SELECT doc_id, CAST(dense_rank() OVER (PARTITION BY doc_id ORDER BY sent_id) AS BIGINT) AS sent_ord, tok_id AS id,
       form, plemma, ppos FROM pred""")
def s7_predictions_roundtrip(spark, sf):
    p = V.predictions(spark, sf).withColumnRenamed("tok_id", "id")
    path = shared_dir(spark, "pred")
    CU.write_predictions_table(p, path, compression="gzip")
    back = CU.read_predictions(spark, path)
    return back.select(F.col("doc").cast("bigint").alias("doc_id"), F.col("sent_ord"), "id", "form", "plemma", "ppos")


def _task_lines(ex):
    """Shared-task lines from the examples: test rows covered (no target);
    nouns at token 2 carry an extra field before the features (to be repaired)."""
    extra = (F.col("xpostag") == "N") & (F.col("tok_id") == 2)
    return ex.select("doc_id", "sent_id", "tok_id", "split",
                     F.when(F.col("split") == "test", F.concat_ws("\t", "lemma", "feats"))
                      .when(extra, F.concat_ws("\t", "lemma", F.lit("extra"), "feats", "word"))
                      .otherwise(F.concat_ws("\t", "lemma", "feats", "word")).alias("line"))


@register("s8_task2", O.with_tok() + """
SELECT doc_id, sent_id, tok_id, feats AS source_feats, word AS source, 'pos=LEMMA' AS target_feats, lemma AS target FROM ex""")
def s8_task2(spark, sf):
    lines = V.examples(spark, sf).select("doc_id", "sent_id", "tok_id", F.concat_ws("\t", "feats", "word", F.lit("pos=LEMMA"), "lemma").alias("line"))
    rows, _ = INF.parse_inflections(lines, task=2)
    return rows.select("doc_id", "sent_id", "tok_id", "source_feats", "source", "target_feats", "target")


@register("s8_task3", O.with_tok() + """
SELECT doc_id, sent_id, tok_id, word AS source, feats, lemma AS target, false AS repaired FROM ex""")
def s8_task3(spark, sf):
    lines = V.examples(spark, sf).select("doc_id", "sent_id", "tok_id", F.concat_ws("\t", "word", "feats", "lemma").alias("line"))
    rows, _ = INF.parse_inflections(lines, task=3)
    return rows.select("doc_id", "sent_id", "tok_id", "source", "feats", "target", "repaired")


@register("s8_read_inflections", O.with_tok() + """
SELECT doc_id, sent_id, tok_id, lemma AS source, feats, CASE WHEN split = 'test' THEN 'COVERED' ELSE word END AS target,
       split <> 'test' AND xpostag = 'N' AND tok_id = 2 AS repaired FROM ex""")
def s8_read_inflections(spark, sf):
    lines = _task_lines(V.examples(spark, sf))
    tr, _ = INF.parse_inflections(lines.filter(F.col("split") != "test"), task=1)
    te, _ = INF.parse_inflections(lines.filter(F.col("split") == "test"), task=1, covered=True)
    te = te.withColumn("repaired", F.lit(False))
    cols = ["doc_id", "sent_id", "tok_id", "source", "feats", "target", "repaired"]
    return tr.select(*cols).unionByName(te.select(*cols))


@register("s9_read_wiktionary", O.with_tok() + "SELECT DISTINCT lemma AS base, feats AS features, word AS inflected FROM ex")
def s9_read_wiktionary(spark, sf):
    ex = V.examples(spark, sf).select("lemma", "feats", "word").distinct()
    csv_rows = ex.select(F.col("word").alias("inflected"), F.col("lemma").alias("base"),
                         F.replace(F.replace("feats", F.lit("="), F.lit(" = ")), F.lit(","), F.lit(":")).alias("features"))
    return INF.wiktionary_rows(csv_rows)


@register("s10_read_folds", O.with_tok() + """
SELECT word AS lemma, 'pos=' || xpostag AS feats, lemma AS word, CAST(sent_id % 3 AS VARCHAR) AS fold,
       CASE split WHEN 'valid' THEN 'dev' ELSE split END AS role FROM ex""")
def s10_read_folds(spark, sf):
    ex = V.examples(spark, sf)
    rows = ex.select(F.col("xpostag").alias("type"), F.lit("0500").alias("size"),
                     F.pmod(F.col("sent_id"), F.lit(3)).cast("string").alias("fold"),
                     F.when(F.col("split") == "valid", F.lit("dev")).otherwise(F.col("split")).alias("role"),
                     F.concat_ws(" ", "word", "lemma").alias("value"))
    path = shared_dir(spark, "folds")
    rows.write.partitionBy("type", "size", "fold", "role").text(path)
    return INF.read_folds(spark, path)


@register("s13_text_from_words", O.with_tok() + """
SELECT doc_id, sent_id AS par_id, tok_id,
       form || ',' || xpostag || ',' || CASE WHEN xpostag = 'N' AND length(lemma) < length(form) THEN '2' ELSE '1' END || ',' ||
       CASE WHEN xpostag = 'NUM' THEN 'MISSING_TYPE ' WHEN xpostag = 'N' AND length(lemma) < length(form)
            THEN 'root ' || """ + O.suffix_type_sql("lower(form)", "lemma") + """ || ' ' ELSE 'root ' END AS line
FROM w""")
def s13_text_from_words(spark, sf):
    from ..sources.sinks import words_dump
    return words_dump(_tei_tokens(spark, sf))


@register("s15_prediction_lines", O.with_tok("""
p_ AS (SELECT lemma, feats AS morph, word AS prediction FROM (
         SELECT lemma, feats, word, row_number() OVER (PARTITION BY lemma, feats ORDER BY doc_id DESC, sent_id DESC, tok_id DESC) AS r
         FROM ex WHERE split = 'train') WHERE r = 1)""") + """
SELECT t.doc_id, t.sent_id, t.tok_id, t.lemma || chr(9) || t.feats || chr(9) || coalesce(p_.prediction, 'ERROR') AS line
FROM ex t LEFT JOIN p_ ON p_.lemma = t.lemma AND p_.morph = t.feats WHERE t.split = 'test'""")
def s15_prediction_lines(spark, sf):
    a = j6_attach_predictions(spark, sf)
    return a.select("doc_id", "sent_id", "tok_id",
                    INF.prediction_line(F.col("lemma"), F.col("morph"), F.col("prediction")).alias("line"))


# ------------------------------------------------- n-best and solution checks

def _test_positions(spark, sf):
    w = V.wtok(spark, sf).filter(F.col("split") == "test").select("doc_id", "sent_id", "tok_id", "lform", "lemma")
    return WN.running_number(w, [], ["doc_id", "sent_id", "tok_id"], "p", chunk=F.floor(F.col("doc_id") / 64)) \
             .withColumn("p", F.col("p") - 1)


def _nbest_greedy(spark, sf, k=3):
    w = V.wtok(spark, sf)
    test = _test_positions(spark, sf)
    model = ev.fit_mfl(w.filter(F.col("split") == "train"))
    greedy = jn.predict_mfl(model, test).select(F.col("p").alias("pos"), F.col("plemma").alias("line"))
    counts = w.filter(F.col("split") == "train").groupBy("lform", "lemma").agg(F.count(F.lit(1)).alias("n"))
    top = SM.top_k(counts, ["lform"], "n", k, tie=[F.col("lemma")])
    slots = test.select("p", "lform", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("rank"))
    nb = slots.join(top.select("lform", "rank", F.col("lemma").alias("cand")), ["lform", "rank"], "left") \
              .select((F.col("p") * k + F.col("rank") - 1).alias("pos"),
                      F.coalesce(F.col("cand"), F.when(F.col("rank") == 1, F.col("lform")).otherwise(F.lit("")))
                      .alias("line"))
    return nb, greedy, test


_NBEST_SQL = O.MFL_CTE.strip() + """,
tp_ AS (SELECT *, row_number() OVER (ORDER BY doc_id, sent_id, tok_id) - 1 AS p FROM w WHERE split = 'test'),
gr_ AS (SELECT tp_.p AS pos, coalesce(m.mfl_lemma, tp_.lform) AS line FROM tp_ LEFT JOIN model m ON m.lform = tp_.lform),
tk_ AS (SELECT lform, lemma, row_number() OVER (PARTITION BY lform ORDER BY n DESC, lemma) AS rank
        FROM (SELECT lform, lemma, count(*) AS n FROM w WHERE split = 'train' GROUP BY ALL)),
sl_ AS (SELECT p, lform, unnest([1, 2, 3]) AS rank FROM tp_),
nb_ AS (SELECT sl_.p * 3 + sl_.rank - 1 AS pos,
               coalesce(tk_.lemma, CASE WHEN sl_.rank = 1 THEN sl_.lform ELSE '' END) AS line
        FROM sl_ LEFT JOIN tk_ ON tk_.lform = sl_.lform AND tk_.rank = sl_.rank),
mm_ AS (SELECT * FROM (SELECT CAST(floor(pos / 3) AS BIGINT) AS grp, line AS nbest_line FROM nb_ WHERE pos % 3 = 0) a
        FULL OUTER JOIN (SELECT CAST(pos AS BIGINT) AS grp, line AS greedy_line FROM gr_) b USING (grp)
        WHERE nbest_line IS DISTINCT FROM greedy_line)"""


@register("j8_check_nbest", O.with_tok(_NBEST_SQL) + "SELECT grp, nbest_line, greedy_line FROM mm_")
def j8_check_nbest(spark, sf):
    nb, greedy, _ = _nbest_greedy(spark, sf)
    return jn.check_nbest(nb, greedy, 3)


@register("m9_check_solution", O.with_tok(_NBEST_SQL, """
so_ AS (SELECT tp_.lform || chr(9) || 'pos' || chr(9) || coalesce(m.mfl_lemma, tp_.lform) AS line
        FROM tp_ LEFT JOIN model m ON m.lform = tp_.lform)""") + """
SELECT CAST((SELECT count(*) FROM tp_) AS BIGINT) AS n_input, CAST((SELECT count(*) FROM gr_) AS BIGINT) AS n_solution,
       CAST((SELECT count(*) FROM so_ WHERE len(string_split(line, chr(9))) = 3) AS BIGINT) AS n_fields_ok, CAST((SELECT count(*) FROM nb_) AS BIGINT) AS n_nbest,
       CAST((SELECT count(*) FROM nb_ WHERE pos % 3 = 0 AND length(line) > 0) AS BIGINT) AS n_first_nonempty,
       CAST((SELECT count(*) FROM mm_) AS BIGINT) AS n_mismatch,
       CAST(CASE WHEN (SELECT count(*) FROM so_ WHERE len(string_split(line, chr(9))) = 3) = (SELECT count(*) FROM so_) THEN 1 ELSE 0 END
          + CASE WHEN (SELECT count(*) FROM so_) = (SELECT count(*) FROM tp_) THEN 1 ELSE 0 END
          + CASE WHEN (SELECT count(*) FROM nb_) = 3 * (SELECT count(*) FROM tp_) THEN 1 ELSE 0 END
          + CASE WHEN (SELECT count(*) FROM nb_ WHERE pos % 3 = 0 AND length(line) > 0) = (SELECT count(*) FROM tp_) THEN 1 ELSE 0 END
          + CASE WHEN (SELECT count(*) FROM mm_) = 0 THEN 1 ELSE 0 END AS BIGINT) AS passed""")
def m9_check_solution(spark, sf):
    nb, greedy, test = _nbest_greedy(spark, sf)
    sol = jn.predict_mfl(ev.fit_mfl(V.wtok(spark, sf).filter(F.col("split") == "train")), test) \
        .select(F.concat_ws("\t", "lform", F.lit("pos"), "plemma").alias("line"))
    return LM.check_solution(sol, test, nb, jn.check_nbest(nb, greedy, 3), 3)


# ------------------------------------------------------ predicates

@register("p1_drop_punct", O.with_tok() + "SELECT doc_id, sent_id, tok_id, xpostag FROM tok WHERE xpostag <> 'PUNCT'")
def p1_drop_punct(spark, sf):
    return P.drop_punct(V.tok(spark, sf).select("doc_id", "sent_id", "tok_id", "xpostag"), also_empty=True)


@register("p2_keep_pos", O.with_tok() + "SELECT doc_id, sent_id, tok_id, form FROM tok WHERE xpostag = 'NP'")
def p2_keep_pos(spark, sf):
    return P.keep_pos(V.tok(spark, sf), "NP").select("doc_id", "sent_id", "tok_id", "form")


@register("p3_mark_foreign", O.with_tok() + f"""
SELECT doc_id, sent_id AS par_id, tok_id, form, CASE WHEN xpostag = 'NUM' THEN 'zxx' END AS foreign_lang FROM tok WHERE xpostag <> 'PUNCT'""")
def p3_mark_foreign(spark, sf):
    t = _tei_tokens(spark, sf).filter(F.col("inner").isNotNull())
    return P.mark_foreign(t, F.col("lang")).select("doc_id", "par_id", "tok_id", "form", "foreign_lang")


@register("p4_casefold", O.with_tok() + "SELECT DISTINCT form, lower(form) AS lform FROM tok")
def p4_casefold(spark, sf):
    t = V.tok(spark, sf).select("form", F.col("form").alias("lform")).distinct()
    return P.casefold(t, ["lform"])


@register("s13_text_from_lines", "WITH " + RAW_LINES_SQL.strip() + f""",
lw_ AS (SELECT unnest(string_split(lower(translate(line, {O.q(ST.LINE_PUNCT)}, '')), ' ')) AS word FROM raw)
SELECT word FROM lw_ WHERE word NOT IN ({", ".join(O.q(x) for x in ST.NOT_WORDS)})""")
def s13_text_from_lines(spark, sf):
    from ..sources.sinks import lines_dump
    return lines_dump(TEI.raw_lines(_pages_pars(spark, sf), key="page_id"))


@register("s13_write_lines", "WITH " + RAW_LINES_SQL.strip() + """
SELECT page_id, unnest(string_split(line, chr(10))) AS line FROM raw""")
def s13_write_lines(spark, sf):
    from ..sources.sinks import write_lines
    path = shared_dir(spark, "lines")
    write_lines(TEI.raw_lines(_pages_pars(spark, sf), key="page_id"), path, doc="page_id")
    return spark.read.text(path).select(F.col("page_id").cast("bigint").alias("page_id"), F.col("value").alias("line"))
