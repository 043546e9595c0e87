"""Steps computed once a row, and files written with one shuffle."""

import os

from conftest import SMALL_SF

import __spark_entry__ as E
from lexiflow.sources import conllu as CU


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_misc_is_not_made_again_by_filters(spark):
    for name in ("p5_parse_misc", "p6_seg", "p6_lem"):
        assert _plan(E.queries()[name](spark, SMALL_SF)).count("origText=,") == 1, name


def test_line_is_not_made_again_by_filters(spark):
    assert _plan(E.queries()["s8_task2"](spark, SMALL_SF)).count("pos=LEMMA") == 1


def test_normalise_cuts_a_form_once_a_pass(spark):
    from pyspark.sql import functions as F
    from lexiflow.functions.text import normalise_with
    df = spark.createDataFrame([("Ŋa",), ("\u4e00",), ("",), (None,)], "form string")
    out = df.select(normalise_with(F.col("form"), "LENZ").alias("n"))
    assert _plan(out).count("regexp_extract_all") == 2
    assert [r.n for r in out.collect()] == ["nga", "\u4e00", "", None]


def test_sentence_text_takes_one_shuffle(spark):
    rows = spark.createDataFrame([(1, 1, 1, "h", "a")], "doc long, sent long, tok long, _head string, _line string")
    plan = CU.sentence_text(rows, "doc", "sent", "tok")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_conllu_text(spark, tmp_path):
    fields = ", ".join(f"{f} string" for f in CU.CONLLU_FIELDS)
    none = [None] * 7
    rows = [(d, s, t, f"{d}_{s}_{t}", f"f{t}", "l", *none, c) for d, s, t, c in
            [(1, 2, 2, "x"), (1, 2, 1, "x"), (1, 3, 1, None), (2, 1, 1, "y"), (2, 1, 1, "y")]] + [(None, 1, 1, "n", "f", "l", *none, "z")]
    df = spark.createDataFrame(rows, f"doc long, sent long, tok long, {fields}, note string")
    path = str(tmp_path / "c")
    CU.write_conllu(df, path, doc="doc", sent="sent", order="tok", comment="note")
    text = "".join(open(os.path.join(path, f), encoding="utf-8").read() for f in sorted(os.listdir(path)) if f.startswith("part-"))

    def line(d, s, t):
        return f"{d}_{s}_{t}\tf{t}\tl" + "\t_" * 7 + "\n"
    assert text == (CU.HEADER + "\n# x\n" + line(1, 2, 1) + line(1, 2, 2) + "\n" + line(1, 3, 1) + "\n"
                    + CU.HEADER + "\n# y\n" + line(2, 1, 1) * 2 + "\n")


def test_predictions_share_files(spark, tmp_path):
    fields = ", ".join(f"{f} string" for f in CU.PRED_FIELDS[1:])
    rows = [(d, s, t, f"f{d}", *[None] * 6) for d in range(40) for s, t in ((2, 1), (5, 1), (5, 2))] + [(None, 1, 1, "n", *[None] * 6)]
    df = spark.createDataFrame(rows, f"doc long, sent long, id long, {fields}")
    path = str(tmp_path / "p")
    CU.write_predictions_table(df, path, doc="doc", sent="sent")
    assert not [f for f in os.listdir(path) if os.path.isdir(os.path.join(path, f))]
    back = {(r.doc, r.sent_ord, r.id, r.form) for r in CU.read_predictions(spark, path).collect()}
    assert back == {(str(d), s, t, f"f{d}") for d in range(40) for s, t in ((1, 1), (2, 1), (2, 2))} | {(None, 1, 1, "n")}
