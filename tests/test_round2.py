"""Markup edge cases, untagged words, strict reading, positional pairing, group heads."""

import random

import pytest
from pyspark.sql import functions as F

from lexiflow.operators import evaluate as ev
from lexiflow.operators import joins as jn
from lexiflow.operators import lemmatiser as LM
from lexiflow.operators import sampling as SM
from lexiflow.sources import conllu as CU
from lexiflow.sources import formats as FO
from lexiflow.sources import inflection as INF
from lexiflow.sources import sinks
from lexiflow.sources import tei as TEI

PAGE = """<html lang="arn"><body><p>one &copy; &#233;&#x20AC; &bogus; &amp;lt;
<P xml:lang='arn' n=7>two</P><div><p lang="x" title="a>b">three</div>four<p xml:lang="spa">no</p>
<p>tail <w lemma='l&amp;m' POS=V xml:lang='arn'><m baseform='b' type="root">ab</m></w>,<note>abc<w>zz</w></note> <hi/>."""


def _pars(spark, lang="arn"):
    return TEI.tei_paragraphs(spark.createDataFrame([(1, PAGE)], "doc_id long, xml string"), lang)


def test_paragraph_ends_and_attributes(spark):
    rows = _pars(spark).orderBy("par_id").collect()
    assert [r.body.strip()[:5] for r in rows] == ["one &", "two", "three", "tail "]
    assert rows[1].n == "7" and "three" not in rows[1].body and "four" not in rows[2].body


def test_entities(spark):
    line = TEI.raw_lines(_pars(spark)).filter("par_id = 1").first().line
    assert line.strip() == "one © é€ &bogus; &lt;"
    df = spark.createDataFrame([("&#0;&#xD800;&#1114112;&apos;&",), (None,), ("",)], "x string")
    assert [r.y for r in df.select(TEI.unescape(F.col("x")).alias("y")).collect()] == ["&#0;&#xD800;&#1114112;'&", None, ""]


def test_only_direct_children_are_tokens(spark):
    toks = TEI.tei_tokens(_pars(spark)).filter("par_id = 4").orderBy("tok_id").collect()
    assert [t.form for t in toks] == ["t", "a", "i", "l", "ab", ",", "."]
    assert (toks[4].lemma, toks[4].xpostag, toks[4].word_lang) == ("l&m", "V", "arn")


def test_untagged_words_stay(spark):
    tok = spark.createDataFrame([(1, 1, 1, "A b", "a", None), (1, 1, 2, ".", ".", "PUNCT"), (1, 1, 3, "C", None, "N")],
                                "doc_id long, sent_id long, tok_id long, form string, lemma string, xpostag string").withColumn(
        "upostag", F.lit(None).cast("string"))
    r = FO.to_parallel(tok).first()
    assert (r.src, r.tgt, r.pos) == ("a_b c", "a _", "_ N")
    r = FO.to_parallel(tok, punct_col="upostag").first()
    assert len(r.src.split(" ")) == len(r.tgt.split(" ")) == len(r.pos.split(" ")) == 3
    pred = tok.select("doc_id", "sent_id", "tok_id", F.lit("x").alias("plemma"))
    keys = ["doc_id", "sent_id", "tok_id"]
    assert jn.merge_gold(tok, pred, keys).count() == 2
    assert tuple(jn.merge_audit(tok, pred, keys).first()) == (2, 0, 1)


def test_strict_reading_fails(spark):
    lines = spark.createDataFrame([("a\tk=v\tb",), ("bad",)], "line string")
    rows, bad = INF.parse_inflections(lines)
    assert rows.count() == 1 and bad.count() == 1 and "_chk" not in rows.columns
    rows, _ = INF.parse_inflections(lines, strict=True)
    with pytest.raises(Exception, match="bad line: bad"):
        rows.collect()
    good, _ = INF.parse_inflections(lines.filter("line <> 'bad'"), strict=True)
    assert good.count() == 1


@pytest.mark.parametrize("task,line,want", [
    (2, "k=v a k=w b", ("k=v", "a", "k=w", "b")), (3, "a k=w b", ("a", "k=w", "b"))])
def test_other_tasks(spark, task, line, want):
    rows, bad = INF.parse_inflections(spark.createDataFrame([(line,), ("x",)], "line string"), task)
    cols = ["source_feats", "source", "target_feats", "target"] if task == 2 else ["source", "feats", "target"]
    assert tuple(rows.select(*cols).first()) == want and bad.count() == 1


def test_predictions_by_pos_hand_counted(spark, tmp_path):
    gold = "\n".join(["# h", "d_1_1\tAba\taba\t_\tN\t_\t_\t_\t_\t_", "d_1_2\t.\t.\tPUNCT\tPUNCT\t_\t_\t_\t_\t_", "",
                      "d_2_1\tcaca\tca\t_\tV\t_\t_\t_\t_\t_", "d_2_2\tdo\tdo\t_\tV\t_\t_\t_\t_\t_"])
    (tmp_path / "gold.conllu").write_text(gold + "\n")
    g = CU.read_conllu(spark, str(tmp_path / "gold.conllu"), positions=True)
    words = jn.by_position(g.filter("not xpostag <=> 'PUNCT'").withColumn("lform", F.lower("form")), ["block_start", "rec"], chunk=F.col("block_start"))
    pred = spark.createDataFrame([(1, "aba"), (2, "cac"), (3, "do")], "position long, plemma string")
    train = spark.createDataFrame([("aba", "N"), ("do", "V"), ("zu", "P")], "lform string, xpostag string")
    out = {r.xpostag: r for r in ev.eval_predictions_by_pos(words, pred, train, ["position"]).collect()}
    assert set(out) == {"N", "V", "P", "TOTAL"}
    assert (out["N"].seen_n, out["N"].seen_accuracy, out["N"].unseen_n) == (1, 1.0, 0)
    assert (out["V"].seen_accuracy, out["V"].unseen_n, out["V"].unseen_accuracy, out["V"].unseen_distance) == (1.0, 1, 0.0, 1.0)
    assert out["P"].accuracy is None and abs(out["TOTAL"].accuracy - 2 / 3) < 1e-5
    assert jn.merge_gold(words, pred, ["position"]).count() == 3


def test_conllu_without_blank_lines_splits(spark, tmp_path):
    n = 5000
    (tmp_path / "a.conllu").write_text("".join(f"t_1_{i}\tw{i}\tw\t_\tN\t_\t_\t_\t_\t_\n" for i in range(n)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        df = CU.read_conllu(spark, str(tmp_path / "a.conllu"))
        assert df.count() == n and df.select("tok_id").distinct().count() == n and df.rdd.getNumPartitions() > 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_vote_row_equals_vote(spark):
    r = random.Random(1)
    rows = [(i, *[r.choice(["a", "bb", "bbb", "c", ""]) for _ in range(3)]) for i in range(200)]
    df = spark.createDataFrame(rows, "k long, x string, y string, z string")
    long = df.select("k", F.explode(F.array("x", "y", "z")).alias("prediction"))
    want = {(x.k, x.prediction, x.votes) for x in LM.vote(long, ["k"]).select("k", "prediction", "votes").collect()}
    got = df.select("k", LM.vote_row([F.col("x"), F.col("y"), F.col("z")]).alias("v")).select("k", "v.*").collect()
    assert {(x.k, x.prediction, x.votes) for x in got} == want


def test_first_rows_of_hot_group(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("g"),
                                  F.pmod(F.col("id") * 7919, F.lit(5003)).alias("v"))
    got = SM.head_per_group(df, "g", ["v"], 200).collect()
    hot = sorted(r.v for r in df.filter("g = 'hot'").collect())[:200]
    assert sorted((r.rn, r.v) for r in got if r.g == "hot") == list(zip(range(1, 201), hot))
    assert sum(r.g != "hot" for r in got) == df.filter("g <> 'hot'").count()


def test_nested_samples_are_the_first_hashes(spark):
    df = spark.range(300).select(F.col("id").alias("k"))
    got = SM.nested_samples(df, F.col("k"), [5, 20], 3).collect()
    full = {r.k: r["rank"] for r in SM.seeded_rank(df, F.col("k"), 3).collect()}
    for size in (5, 20):
        assert {r.k: r["rank"] for r in got if r.sample_size == size} == {k: n for k, n in full.items() if n <= size}


def test_write_lines(spark, tmp_path):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 1, "c")], "doc_id long, par_id long, line string")
    sinks.write_lines(df, str(tmp_path / "out"))
    back = spark.read.text(str(tmp_path / "out")).collect()
    assert sorted((r.doc_id, r.value) for r in back) == [(1, "a"), (1, "b"), (2, "c")]
