import os

from pyspark.sql import functions as F

from conftest import FIXTURES
from lexiflow.sources import conllu as CU
from lexiflow.sources import tei as TEI
from lexiflow.operators import filters as P


def test_read_conllu_fixture(spark):
    df = CU.read_conllu(spark, os.path.join(FIXTURES, "train_excerpt.conllu"))
    rows = df.orderBy("line_id", "tok_id").collect()
    assert len(rows) == 10                       # header skipped, blank line ends a sentence
    assert {r.line_id for r in rows} == {137, 97}
    first = [r for r in rows if r.line_id == 137][0]
    assert (first.text_id, first.tok_id, first.form, first.lemma) == ("1897LENZ-11-TAGGED", 1, "arol", "arol")
    assert first.upostag is None                 # '_' read as null
    punct = [r for r in rows if r.form == "."]
    assert all(r.xpostag == "PUNCT" for r in punct)


def test_read_predictions_fixture(spark):
    df = CU.read_predictions(spark, os.path.join(FIXTURES, "pred_excerpt.tsv"))
    rows = df.orderBy("sent_ord", "id").collect()
    assert [r.id for r in rows] == list(range(1, 9))
    assert rows[0].plemma == "nentuñmain" and rows[0].lemma is None
    assert rows[6].ppos == "PUNCT"


def test_conllu_round_trip(spark, tmp_path):
    df = CU.read_conllu(spark, os.path.join(FIXTURES, "train_excerpt.conllu"))
    rows = df.select(F.col("text_id").alias("doc"), F.col("line_id").alias("sent"), "tok_id", *CU.CONLLU_FIELDS)
    out = str(tmp_path / "rt")
    CU.write_conllu(rows, out, doc="doc", sent="sent")
    back = CU.read_conllu(spark, out)
    key = ["text_id", "line_id", "tok_id"] + CU.CONLLU_FIELDS
    assert sorted(map(tuple, df.select(*key).collect())) == sorted(map(tuple, back.select(*key).collect()))


def _tei(spark):
    with open(os.path.join(FIXTURES, "tei_excerpt.xml"), encoding="utf8") as f:
        xml = f.read()
    return spark.createDataFrame([("1897LENZ-5", xml)], "doc_id string, xml string")


def test_tei_paragraphs_language_and_numbering(spark):
    pars = TEI.tei_paragraphs(_tei(spark), "arn").orderBy("par_id").collect()
    assert [(p.par_id, p.n) for p in pars] == [(1, "1"), (2, None)]   # the spa paragraph is skipped
    lines = TEI.raw_lines(TEI.tei_paragraphs(_tei(spark), "spa")).collect()
    assert [l.line for l in lines] == ["Señor"]


def test_tei_tokens_keep_document_order(spark):
    toks = TEI.tei_tokens(TEI.tei_paragraphs(_tei(spark), "arn"))
    fields = TEI.conllu_fields(toks, "arn").orderBy("par_id", "tok_id").collect()
    p1 = [(r.form, r.lemma, r.xpostag) for r in fields if r.par_id == 1]
    assert p1 == [("moŋefúi", "mongen", "V"), (",", ",", "PUNCT"), ("DIOS", None, None), (".", ".", "PUNCT")]
    w = [r for r in fields if r.form == "moŋefúi"][0]
    assert w.feats == "bi|ind3"
    assert w.misc == "origText=moŋefúi,baseForms=monge|fu|iy"
    dios = [r for r in fields if r.form == "DIOS"][0]
    assert dios.misc == "origText=DIOS,baseForms=,wordLang=spa"
    p2 = [(r.form, r.xpostag) for r in fields if r.par_id == 2]
    # every non-space character outside a word is its own PUNCT token
    assert p2 == [("piŋe", "V"), ("-", "PUNCT"), ("inche", "PN"), ("¿", "PUNCT"), ("c", "PUNCT"),
                  ("h", "PUNCT"), ("e", "PUNCT"), ("m", "PUNCT"), ("?", "PUNCT")]


def test_morphemes_and_empty_morpheme(spark):
    toks = TEI.tei_tokens(TEI.tei_paragraphs(_tei(spark), "arn"))
    ms = TEI.tei_morphemes(toks).filter(F.col("lemma") == "pin").orderBy("m_id").collect()
    assert [(m.text, m.base_form, m.type) for m in ms] == [("pi", "pi", "root"), ("ŋe", "nge", "pass"), ("", "iy", "ind3s")]


def test_parse_misc_legacy_and_clean(spark):
    df = spark.createDataFrame([("amu", "origText=amu,baseForms=amu|ki,wordLang=spa"), ("x", "origText=x,baseForms=")],
                               "form string, misc string")
    clean = df.select(P.parse_misc(F.col("misc"), F.col("form")).alias("m")).collect()
    assert clean[0].m.base_forms == ["amu", "ki"] and clean[0].m.word_lang == "spa"
    assert clean[1].m.base_forms == ["x"]                       # empty -> the form
    legacy = df.select(P.parse_misc(F.col("misc"), F.col("form"), legacy=True).alias("m")).collect()
    assert legacy[0].m.base_forms == ["amu", "ki,wordLang=spa"]


def test_write_predictions_nbest_and_sidecar(spark, tmp_path):
    from lexiflow.sources import inflection as INF
    df = spark.createDataFrame([("walk", "pos=V", ["walked", "walkt"]), ("go", "pos=V", [None])],
                               "lemma string, morph string, cands array<string>")
    out = str(tmp_path / "pred")
    INF.write_predictions(df, out, nbest="cands", params={"k": 2})
    lines = sorted(r.value for r in spark.read.text(out).collect())
    assert lines == ["go\tpos=V\tERROR", "walk\tpos=V\twalked", "walk\tpos=V\twalkt"]
    assert spark.read.text(out + "_params").first().value == '{"k": 2}'


def test_read_folds_reference_layout(spark, tmp_path):
    from lexiflow.sources import inflection as INF
    for typ, fold, name, body in [("N", "0", "lemma-train.txt", "haus häuser\nkind kinder\n"),
                                  ("N", "0", "lemma-test.txt", "maus mäuse\n"),
                                  ("V", "1", "lemma-dev.txt", "gehen ging\n")]:
        d = tmp_path / typ / "0500" / fold
        d.mkdir(parents=True, exist_ok=True)
        (d / name).write_text(body, encoding="utf8")
    rows = sorted(tuple(r) for r in INF.read_folds(spark, str(tmp_path)).collect())
    assert rows == [("gehen", "pos=V", "ging", "1", "dev"), ("haus", "pos=N", "häuser", "0", "train"),
                    ("kind", "pos=N", "kinder", "0", "train"), ("maus", "pos=N", "mäuse", "0", "test")]


def test_read_wiktionary_csv(spark, tmp_path):
    from lexiflow.sources import inflection as INF
    p = tmp_path / "w.csv"
    p.write_text("walked,walk,type = participle:tense = past\n", encoding="utf8")
    r = INF.read_wiktionary(spark, str(p)).first()
    assert (r.base, r.features, r.inflected) == ("walk", "type=participle,tense=past", "walked")


def test_read_cell_csv_first_word_and_gaps(spark, tmp_path):
    from lexiflow.sources import inflection as INF  # noqa: F401
    p = tmp_path / "cells.csv"
    p.write_text('Word,Text name,XML\n'
                 'inche,T1,"<w xml:lang=""arn"" lemma=""iñche"" pos=""PN""><m baseForm=""iñche"" type=""1s"">inche</m></w>"\n'
                 'DIOS,T1,"<w xml:lang=""spa"">DIOS</w>"\n'
                 'pin,T1,"<w xml:lang=""arn"" lemma=""pin"" pos=""V""><m baseForm=""pi"" type=""root"">pi</m></w><w>x</w>"\n',
                 encoding="utf8")
    cells = TEI.read_cell_csv(spark, str(p))
    out = TEI.read_cell_xml(cells, "arn").orderBy("line_id").collect()
    assert [(r.line_id, r.form, r.lemma, r.feats) for r in out] == [(1, "inche", "iñche", "1s"), (3, "pi", "pin", "_")]
