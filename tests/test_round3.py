"""Selection of cuts, heads in a tree, quota thresholds, encoding by join, literal index."""

import random

import pytest
from pyspark.sql import functions as F

from lexiflow.operators import features as FT
from lexiflow.operators import lemmatiser as LM
from lexiflow.operators import sampling as SM


@pytest.mark.parametrize("n, p, q", [(0, .1, .1), (1, .5, .5), (7, .1, .1), (1000, .1, .25), (1000, 0, .1), (50, .5, .5)])
def test_split_by_selection_equals_ranking(spark, n, p, q):
    df = spark.range(n).select((F.col("id") % 400).alias("a"), F.floor(F.col("id") / 400).alias("b"))
    want = SM.split_exact(df, ["a", "b"], p, q, 3).drop("rank")
    got = SM.split_exact(df.unionAll(df), ["a", "b"], p, q, 3, rank=False)
    assert sorted(got.collect()) == sorted(want.collect()) and got.count() == n


def test_heads_merge_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(SM, "FAN", 2)
    df = spark.range(3000).select(F.when(F.col("id") < 2500, "hot").otherwise(F.col("id").cast("string")).alias("g"), "id")
    got = SM.head_per_group(df, "g", ["id"], 7).collect()
    assert sorted(r.id for r in got if r.g == "hot") == list(range(7)) and len(got) == 507
    assert all(r.rn == r.id + 1 for r in got if r.g == "hot")
    assert SM.head_per_group(df.filter("id < 0"), "g", ["id"], 7).count() == 0


def test_quota_threshold_equals_full_order(spark):
    df = spark.range(5000).select(F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("s"), "id")
    quotas = {"s0": (30, 5, 5), "s1": (9000, 1, 1), "s9": (1, 1, 1)}
    got = SM.split_stratified(df, "s", F.col("id"), quotas, 4).collect()
    order = {}
    for r in df.withColumn("h", SM.seeded_hash(F.col("id"), 4)).orderBy("h").collect():
        order.setdefault(r.s, []).append(r.id)
    want = {(i, "train" if k < quotas[s][0] else "dev" if k < sum(quotas[s][:2]) else "test")
            for s in ("s0", "s1") for k, i in enumerate(order[s][:sum(quotas[s])])}
    assert {(r.id, r.role) for r in got} == want and len(got) == len(want)
    assert all(order[r.s][r.rank - 1] == r.id for r in got)


def test_encode_joins_a_large_vocabulary(spark):
    ex = spark.createDataFrame([("ab", "k=v1,m=x"), ("ba", "k=v2"), ("", "m=x"), (None, None), ("ab", "k=v1,m=x")], "w string, feats string")
    symbols = ["a", "b", "k=NULL", "m=NULL", "m=x"]
    vocab = spark.range(1_000_000).select(F.concat(F.lit("k=v"), F.col("id")).alias("symbol"), (F.col("id") + 100).alias("idx")).unionAll(
        spark.createDataFrame([(s, i) for i, s in enumerate(symbols)], "symbol string, idx long"))
    keys = spark.createDataFrame([(["k", "m"],)], "keys array<string>")
    got = FT.encode(ex, vocab, "w", keys=keys).select("w", "word_idx", "feat_idx").collect()
    assert sorted(map(repr, got)) == sorted(map(repr, [
        *[type(got[0])(w="ab", word_idx=[0, 1], feat_idx=[101, 4])] * 2, type(got[0])(w="ba", word_idx=[1, 0], feat_idx=[102, 3]),
        type(got[0])(w="", word_idx=[], feat_idx=[2, 4]), type(got[0])(w=None, word_idx=None, feat_idx=[2, 3])]))
    with pytest.raises(Exception, match="unknown symbol: z"):
        FT.encode(ex.unionAll(spark.createDataFrame([("z", "")], ex.schema)), vocab, "w", keys=keys).collect()


def _make(template, source):
    return "".join((source[int(x)] if int(x) < len(source) else "") if x.isdigit() else x for x in template)


def test_literal_index_bounds_candidates(spark):
    """All templates that make a pair are candidates; a candidate shares its rarest
    fixed letter with the pair, or fixes none."""
    r = random.Random(1)
    templates = [[str(i) if r.random() < .6 else r.choice("abx") for i in range(r.randrange(1, 6))] for _ in range(200)] + [["0", "1", "2"], ["0", "0"]]
    pairs = list({(("".join(r.choice("ab") for _ in range(r.randrange(5)))), "".join(r.choice("abx") for _ in range(r.randrange(5))))
                  for _ in range(300)})
    te = spark.createDataFrame([(s, t, 1) for s, t in pairs], "source string, target string, n long")
    ts = spark.createDataFrame([(t,) for t in templates], "template array<string>").distinct()
    found = {(tuple(x.template), x.source, x.target) for x in LM.literal_index(ts, te).collect()}
    hits = {(tuple(t), s, w) for t in templates for s, w in pairs if _make(t, s) == w}
    assert hits <= found
    for t, s, w in found:
        parts = [x for x in t if not x.isdigit() or int(x) < len(s)]
        assert len(parts) == len(w)
        fixed = [i for i, x in enumerate(parts) if not x.isdigit()]
        assert not fixed or any(parts[i] == w[i] for i in fixed)
    same_lengths = sum(len([x for x in t if not x.isdigit() or int(x) < len(s)]) == len(w) for t in {tuple(t) for t in templates} for s, w in pairs)
    assert len(found) < same_lengths / 2
    got = LM.covered_share(te, ts).first()
    assert got.covered == len({(s, w) for _, s, w in hits}) and got.total == len(pairs)
