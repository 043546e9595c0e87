"""Steps that move or read less for the same rows: runs of rows, tags, fold trees."""

import os

import pytest
from pyspark.sql import functions as F

from lexiflow.operators import joins as jn
from lexiflow.operators import runs as RN
from lexiflow.sources import corpus as C
from lexiflow.sources import formats as FO
from lexiflow.sources import inflection as INF

KEYS = ["doc_id", "sent_id", "tok_id"]
TOK = "doc_id long, sent_id long, tok_id long, form string, lemma string, xpostag string"


def plan(df):
    return df._jdf.queryExecution().toString()


def test_tags_of_forms(spark):
    forms = ["word", "Word", "wo", "W", "1", "12", "1a", "a1", "٣", "²", "é", "Éa", "Éau", "éaux", "漢字", ".", "_", "", "@a", None]
    first, later = (["N", "N", "P", "P", "NUM", "NUM", "P", "P", "NUM", "NUM", "P", "P", "P", "N", "P", "PUNCT", "PUNCT", "PUNCT", "P", None],
                    ["N", "NP", "P", "NP", "NUM", "NUM", "P", "P", "NUM", "NUM", "P", "NP", "NP", "N", "P", "PUNCT", "PUNCT", "PUNCT", "P", None])
    df = spark.createDataFrame([(i, f) for i, f in enumerate(forms)], "i int, form string").coalesce(1)
    for at, want in ((1, first), (2, later)):
        got = [r[0] for r in df.orderBy("i").select(C.xpostag(F.col("form"), F.lit(at))).collect()]
        assert got[:-1] == want[:-1]
    # a word that opens with an ASCII letter meets no pattern
    assert "ascii(" in plan(df.select(C.xpostag(F.col("form"), F.lit(1)).alias("t")))


def test_lines_of_scattered_words(spark):
    """Words in any order, repeated and null numbers, spaces and nulls in a text, a line of
    punctuation alone, null keys: as grouping word by word gives them."""
    rows = [(1, 1, t, f"W{t}", f"l{t}", "N") for t in (5, 6, 1, 2, 9, 3)] + [
        (1, 1, 4, ".", ".", "PUNCT"), (1, 2, 1, "!", "!", "PUNCT"), (1, 2, 2, "?", "?", "PUNCT"),
        (2, 1, 1, "New York", "new york", "NP"), (2, 1, 2, None, None, None), (2, 1, 2, "a", "b", "P"),
        (2, 1, None, "z", "z\x00", "P"), (None, 1, 2, "y", "y", "P"), (None, 1, 1, "x", "x", "P")]
    want = {(1, 1): ("w1 w2 w3 w5 w6 w9", "l1 l2 l3 l5 l6 l9", "N N N N N N"), (1, 2): ("", "", ""),
            (2, 1): ("z new_york _ a", "z\x00 new york _ b", "P NP _ P"), (None, 1): ("x y", "x y", "P P")}
    for parts in (1, 3):
        df = FO.to_parallel(spark.createDataFrame(rows, TOK).repartition(parts))
        got = {(r.doc_id, r.sent_id): (r.src, r.tgt, r.pos) for r in df.collect()}
        assert got == want
    # neighbouring words are one row before the shuffle
    assert "MapInArrow" in plan(FO.to_parallel(spark.createDataFrame(rows, TOK)))


def test_merge_gold_moves_runs(spark):
    tok = spark.createDataFrame([(1, s, t, f"f{t}", f"l{t}", "PUNCT" if t == 3 else "N") for s in (1, 2) for t in range(1, 40)], TOK)
    pred = tok.select(*KEYS, "form", F.col("lemma").alias("plemma"), F.lit(None).cast("string").alias("pfeats"))
    df = jn.merge_gold(tok, pred, KEYS)
    assert df.columns == [*KEYS, "form", "plemma", "pfeats", "lemma", "pos", "feats", "misc"]
    assert df.count() == 76 and df.filter("plemma = lemma AND pos = 'N' AND pfeats IS NULL AND misc IS NULL").count() == 76
    assert "MapInArrow" in plan(df)


def test_join_of_runs_is_the_join_of_rows(spark):
    left = [(d, 1, t, None if (t or 7) % 7 == 0 else f"a{t}", "x y" if t == 5 else "" if t == 6 else "\x00" if t == 8 else "b")
            for d in (1, 1, 2, None) for t in [*range(40), -3, None, 2, 2]]
    right = [(d, 1, t, f"c {t}" if t == 9 else f"c{t}") for d in (1, 2, 2, 3, None) for t in [*range(30, -1, -2), *range(31), -3, None]]
    a = spark.createDataFrame(left, "doc_id long, sent_id long, tok_id int, u string, v string")
    b = spark.createDataFrame(right, "doc_id long, sent_id long, tok_id int, w string")
    df, want = RN.join_runs(a, b, KEYS), a.join(b, KEYS)
    assert df.columns == want.columns and df.dtypes == want.dtypes
    assert sorted(map(repr, df.collect())) == sorted(map(repr, want.collect()))
    assert RN.join_runs(a, b, KEYS).count() > 0 and "MapInArrow" in plan(df)
    # columns that are no strings are joined row by row
    n = b.withColumn("w", F.length("w"))
    assert sorted(map(repr, RN.join_runs(a, n, KEYS).collect())) == sorted(map(repr, a.join(n, KEYS).collect()))


def test_fold_paths_are_searched_once(spark, tmp_path):
    for folder, name in (("noun/0500/3", "x_train.txt"), ("type=verb/size=0500/fold=1", "role=dev.txt"),
                         ("a/0500/b/0500/c", "test.txt"), ("other", "train.txt"), ("sp ace/0500/1", "dev.txt")):
        os.makedirs(tmp_path / folder)
        (tmp_path / folder / name).write_text("go went\n\n  be\tis  x\nalone\n\tq\nend\t \n")
    df = INF.read_folds(spark, str(tmp_path))
    got = {}
    for r in df.collect():
        got.setdefault((r.feats, r.fold, r.role), []).append((r.lemma, r.word))
    lines = [("go", "went"), ("be", "is"), ("alone", None), ("", "q"), ("end", "")]
    assert {k: sorted(map(repr, v)) for k, v in got.items()} == {k: sorted(map(repr, lines)) for k in [
        ("pos=noun", "3", "train"), ("pos=verb", "1", "dev"), ("pos=a", "b", "test"), ("pos=", "", ""), ("pos=sp%20ace", "1", "dev")]}
    assert "LeftOuter" in plan(df)
