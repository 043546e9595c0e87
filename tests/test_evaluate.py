import os

from pyspark.sql import functions as F

from conftest import FIXTURES
from lexiflow.operators import evaluate as EV
from lexiflow.sources import conllu as CU


def _words(spark):
    df = CU.read_conllu(spark, os.path.join(FIXTURES, "train_excerpt.conllu"))
    return df.filter(F.col("xpostag") != "PUNCT").withColumn("lform", F.lower("form")) \
             .withColumn("split", F.lit("x")).withColumnRenamed("line_id", "sent_id").withColumn("doc_id", F.lit(1))


def test_copy_baseline_fixture(spark):
    r = EV.eval_copy(_words(spark)).first()
    # arol, pichi, pod are copies; 7 words in the excerpt
    assert (r.n_rows, r.n_right, r.n_wrong) == (7, 3, 4)
    assert r.mean_distance == round(r.distance / 4, 6)


def test_mfl_ties_go_to_first_seen(spark):
    rows = [(1, 1, 1, "la", "a"), (1, 1, 2, "la", "b"), (1, 2, 1, "la", "b"), (1, 2, 2, "la", "a"),
            (1, 3, 1, "lo", "z")]
    df = spark.createDataFrame(rows, "doc_id long, sent_id long, tok_id long, lform string, lemma string")
    m = {r.lform: r.mfl_lemma for r in EV.fit_mfl(df).collect()}
    assert m == {"la": "a", "lo": "z"}


def test_eval_by_pos_has_total_and_na(spark):
    train = _words(spark).withColumn("split", F.lit("train"))
    test = train.filter(F.col("xpostag") == "V").withColumn("split", F.lit("test"))
    rows = {r.xpostag: r for r in EV.eval_by_pos(train.unionByName(test)).collect()}
    assert "TOTAL" in rows and "AJ" in rows
    assert rows["AJ"].seen_n == 0 and rows["AJ"].seen_accuracy is None     # N/A
    assert rows["TOTAL"].accuracy == 1.0                                     # seen forms, most frequent lemma
