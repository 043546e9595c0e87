"""Tag events: comments, block starts, nested and unclosed elements."""

import random

import pytest
from pyspark.sql import functions as F

from lexiflow.sources import tei as TEI


def pars(spark, html):
    return TEI.tei_paragraphs(spark.createDataFrame([(1, html)], "doc_id long, xml string"), None)


def bodies(spark, html):
    return [r.body for r in pars(spark, html).orderBy("par_id").collect()]


def forms(spark, html):
    return [r.form for r in TEI.tei_tokens(pars(spark, html)).orderBy("par_id", "tok_id").collect()]


def test_comments_open_nothing(spark):
    assert bodies(spark, "<p>a<!-- <p n='2'>no --> s</p><!-- <p>never") == ["a s"]
    assert forms(spark, "<p>a<!-- x > y --><w>b</w></p>") == ["a", "b"]


def test_block_starts_end_a_paragraph(spark):
    assert bodies(spark, "<p>aa<h2>head</h2>bb<p>cc<B>d</B></DIV>e") == ["aa", "cc<B>d</B>"]
    assert bodies(spark, "<p>a<lb/>b<param>c<hello>d</p>") == ["a<lb/>b<param>c<hello>d"]


@pytest.mark.parametrize("markup,want", [
    ("x <b>bold <b>in</b> out</b> y", ["x", "y"]),
    ("x <b>never closed <w>w</w> y", ["x"]),
    ("x <br>y<hi/>z", ["x", "y", "z"]),
    ("<w>a<w>b</w>c</w>d", ["abc", "d"]),
    ("<w>a", ["a"]),
    ("</w>a</b><w/>b", ["a", "", "b"]),
    ("<note><w>n</w></note><W lemma='q'>u</W>", ["u"]),
    ('<w lemma="a>b" pos="N">v</w>.', ["v", "."]),
    ("a < b &amp; &eacute;", ["a", "<", "b", "&", "é"]),
    ("<?pi x?><!DOCTYPE y>z", ["z"]),
])
def test_only_own_children(spark, markup, want):
    assert forms(spark, f"<p>{markup}</p>") == want


def test_quoted_bracket_and_nested_morphemes(spark):
    t = TEI.tei_tokens(pars(spark, '<p><w lemma="a>b" pos="N">s<m type="root" baseForm="x>y">a<m type="in"/>b</m><m>c<hi>d</hi></m></w></p>'))
    assert [(r.form, r.lemma, r.xpostag) for r in t.collect()] == [("sabcd", "a>b", "N")]
    ms = TEI.tei_morphemes(t).orderBy("m_id").collect()
    assert [(m.text, m.base_form, m.type) for m in ms] == [("ab", "x>y", "root"), ("", None, "in"), ("cd", None, None)]
    assert t.select(TEI.morph_texts(F.col("inner"))).first()[0] == ["ab", "", "cd"]


def test_words_at_any_depth(spark):
    w = TEI.tei_words(pars(spark, "<p lang='x'><hi><w lemma='a'>b</w></hi><w pos='N'>c<w>d</w></w><w/></p><p><w lemma=\"e\">f</w></p>")).collect()
    assert [(r.lemma, r.xpostag, r.inner) for r in w] == [("a", None, "b"), (None, "N", "c<w>d</w>"), (None, None, "d"), (None, None, ""), ("e", None, "f")]


def test_fold_equals_pattern_on_plain_markup(spark):
    """Both ways on random plain paragraphs, some longer than a block of events."""
    r = random.Random(4)
    rows = []
    for i in range(60):
        parts = []
        for _ in range(r.choice([0, 3, 40, 400])):
            parts.append(r.choice([" ", ".", "x&lt;", "é ", "<w>a</w>", '<w lemma="l" pos="P"><m type="root">q</m><m>r</m></w>', "<w><m></m>t</w>"]))
        rows.append((i, "".join(parts)))
    df = spark.createDataFrame(rows, "id long, body string")
    assert df.filter(~F.col("body").rlike(TEI.PLAIN_RE)).count() == 0
    both = df.select(TEI._plain_items(F.col("body")).alias("a"), TEI._fold_items(F.col("body")).alias("b"))
    assert both.filter(F.col("a") != F.col("b")).count() == 0


def brute_children(markup):
    """Direct children by a plain loop over tags."""
    import re

    out, name, depth, first = [], "", 0, 0
    events = re.findall(r"</?[a-z]+/?>|[^<]+", markup)
    for i, e in enumerate(events):
        if not name:
            if e[0] != "<":
                out += [c for c in e if not c.isspace()]
            elif e == "<w/>":
                out.append(e)
            elif not e.startswith("</") and not e.endswith("/>") and e != "<br>":
                name, depth, first = e[1:-1], 1, i
        elif e in (f"<{name}>", f"</{name}>"):
            depth += 1 if e[1] != "/" else -1
            if not depth:
                if name == "w":
                    out.append("".join(events[first:i + 1]))
                name = ""
    if name == "w":
        out.append("".join(events[first:]) + "</w>")
    return out


def test_fold_against_loop(spark):
    r = random.Random(9)
    rows = [(i, "".join(r.choice(["<w>", "</w>", "<b>", "</b>", "<i>", "</i>", "<br>", "<w/>", "<b/>", "a b", "."]) for _ in range(r.choice([1, 5, 30, 700]))))
            for i in range(200)]
    df = spark.createDataFrame(rows, "id long, body string")
    got = {x.id: x.items for x in df.select("id", TEI._fold_items(F.col("body")).alias("items")).collect()}
    assert got == {i: brute_children(b) for i, b in rows}


def test_long_and_empty(spark):
    assert bodies(spark, "") == [] and bodies(spark, None) == []
    assert forms(spark, "<p>" + "<b>x</b>y" * 30_000 + "</p>") == ["y"] * 30_000
    assert len(forms(spark, "<p>" + "<w>x</w>" * 60_000)) == 60_000


def test_form_normalised_and_raw_text_kept(spark):
    t = TEI.tei_tokens(pars(spark, "<p><w>moŋen</w>,ŋ<w>@@</w></p>"))
    rows = TEI.conllu_fields(t, orthography=F.lit("LENZ")).orderBy("tok_id").collect()
    assert [(r.form, r.misc.split(",")[0]) for r in rows] == [("mongen", "origText=moŋen"), (",", "_"), ("ŋ", "_"), ("@@", "origText=@@")]
    assert [r.form for r in TEI.conllu_fields(t, orthography=F.lit("none")).orderBy("tok_id").collect()][0] == "moŋen"
