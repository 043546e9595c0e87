"""Markup cut in one pass, and bundles and errors made once."""

import re

from pyspark.sql import functions as F

from lexiflow.operators import evaluate as ev
from lexiflow.operators import features as FT
from lexiflow.plans import catalog
from lexiflow.sources import tei as TEI


def _plan(df):
    return df._jdf.queryExecution().toString()


def _pars(spark, *bodies):
    rows = [(i, 1, None, "de", b) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "doc_id long, par_id long, n string, lang string, body string")


WORD = '<w lemma="größe" pos="N"><m baseForm="größ" type="root">Größ</m><m baseForm="e" type="pl">&#233;</m></w>'


def test_items_are_cut_in_one_pass(spark):
    toks = TEI.tei_tokens(_pars(spark, f"« {WORD} ."))
    assert "RLIKE(body" not in _plan(toks.select("form"))
    assert "RLIKE(body" not in _plan(TEI.tei_words(_pars(spark, WORD)).select("lemma"))


def test_plain_and_other_markup(spark):
    bodies = [f"« {WORD} &lt; .", f"a <hi>{WORD}</hi> 1 < 2", '<w lemma="日"/>日<w>x<seg>y</seg></w>', "", None]
    toks = TEI.tei_tokens(_pars(spark, *bodies))
    got = {}
    for r in toks.orderBy("doc_id", "tok_id").collect():
        got.setdefault(r.doc_id, []).append((r.form, r.lemma, r.xpostag, r.inner))
    inner = WORD[WORD.index(">") + 1:-4]
    assert got[0] == [("«", "«", "PUNCT", None), ("Größé", "größe", "N", inner), ("<", "<", "PUNCT", None), (".", ".", "PUNCT", None)]
    assert [t[0] for t in got[1]] == ["a", "1", "<", "2"]
    assert got[2] == [("", "日", None, ""), ("日", "日", "PUNCT", None), ("xy", None, None, "x<seg>y</seg>")]
    assert set(got) == {0, 1, 2}
    words = [(r.doc_id, r.lemma, r.xpostag, r.inner) for r in TEI.tei_words(_pars(spark, *bodies)).collect()]
    assert sorted(words, key=str) == sorted([(0, "größe", "N", inner), (1, "größe", "N", inner), (2, "日", None, ""),
                                             (2, None, None, "x<seg>y</seg>")], key=str)
    ms = TEI.tei_morphemes(toks).orderBy("m_id").select("text", "base_form", "type").collect()
    assert [tuple(m) for m in ms] == [("Größ", "größ", "root"), ("é", "e", "pl")]


def test_bundles_are_made_once(spark, tmp_path):
    rows = [(1, "de", "s0", "Runs fast runs"), (2, "en", "s1", "walking 12"), (3, None, None, None)]
    spark.createDataFrame(rows, "doc_id long, lang string, source string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    for name in ("a11_morph_type_stats", "t7_morph_string", "t11_encode"):
        assert "FileScan" not in _plan(catalog.QUERIES[name](spark, str(tmp_path))), name


def test_bundle_counts(spark):
    ex = spark.createDataFrame([("pos=N",), ("pos=N",), ("lang=x,pos=N",), (None,), (None,)], "feats string")
    assert FT.feature_types(ex).first().keys == ["lang", "pos"]
    assert tuple(FT.morph_type_stats(ex).first()) == (3, 5, round(5 / 3, 6), 2)
    words = ex.withColumn("lemma", F.lit("ab")).withColumn("word", F.lit("ba"))
    assert [r.symbol for r in FT.build_vocab(words).orderBy("idx").collect()] == ["a", "b", "lang=NULL", "lang=x", "pos=N", "pos=NULL"]


def test_errors_are_made_once(spark):
    cols = ["morph", "source", "gold", "prediction"]
    a = spark.createDataFrame([("pos=N", "x", "y", "z")] * 3 + [("pos=P", "x", "y", "z")] * 2 + [(None, "x", "y", "z")], "morph string, source string, gold string, prediction string")
    b = spark.createDataFrame([("pos=N", "x", "y", "z")] * 2 + [("pos=N", "q", "y", "z")] * 2, a.schema)
    out = ev.compare_errors(a, b, cols, ["pos=N", "pos=P"])
    assert {(r.kind, r.bucket): r.n for r in out.collect()} == {
        ("both", "ALL"): 1, ("both", "pos=N"): 1, ("only_first", "ALL"): 3, ("only_first", "pos=P"): 2,
        ("only_second", "ALL"): 2, ("only_second", "pos=N"): 2}
    # every list is read from its counts
    scans = re.findall(r"Scan ExistingRDD\[[^\]]*\]", _plan(out))
    assert scans and all("_n#" in s for s in scans)
