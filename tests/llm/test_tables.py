"""Top-k search, url reputation, language model and the pipeline."""

import collections
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiflow.llm import lm, topk, urls
from lexiflow.llm.common import crc_mod
from lexiflow.llm.queries import ORACLE, QUERIES, URL_RULES

from .conftest import edge_texts


def brute_top(rows, k=5):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
          if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in ok:
        if q % 50 == 0:
            hits = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ok if i != q and len(a) == len(b))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(hits)]
    return sorted(out)


def test_topk_sends_no_copies_through_the_driver(spark, tmp_path):
    """The blocks' copies, one a group, are shuffled however small the written blocks are."""
    shards, blocks = str(tmp_path / "shards"), str(tmp_path / "blocks")
    rows = [(i, 2, bytes(16), bytes(32)) for i in range(3)]
    for path in (shards, blocks):
        spark.createDataFrame(rows, topk.PACKED).write.parquet(path)
    met = topk.meetings(spark.read.parquet(shards), spark.read.parquet(blocks), 3)
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert sorted((r.block, r.slot) for r in met.collect()) == [(b, s) for b in range(3) for s in range(3)]


@pytest.mark.parametrize("shard_rows,block_rows,fan_in", [(4096, 1024, 32), (16, 3, 2)])
def test_topk_brute_force(spark, shard_rows, block_rows, fan_in):
    r = random.Random(1)
    rows = [(i, [float(np.float32(r.gauss(0, 1))) for _ in range(6)]) for i in range(400)]
    rows += [(i, rows[7][1]) for i in range(400, 450)]  # ties
    rows += [(450, None), (500, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (550, [float("nan")] * 6), (600, []), (None, rows[3][1]),
             (650, [1.0, 2.0]), (651, [2.0, 1.0]), (701, rows[0][1]), (701, rows[0][1])]
    df = spark.createDataFrame([(i, v, "z", "z") for i, v in rows], "vec_id long, embedding array<float>, v string, slot string")
    got = topk.top_k(df.repartition(5), shard_rows=shard_rows, block_rows=block_rows, fan_in=fan_in).collect()
    assert sorted(map(tuple, got)) == brute_top(rows)
    assert topk.top_k(df.limit(0)).count() == 0


def test_products_are_exact():
    a = np.array([[2**30, 1], [3, -5]])
    assert topk.products(a, a).tolist() == [[2**60 + 1, 3 * 2**30 - 5], [3 * 2**30 - 5, 34]]


def test_url_parts(spark):
    cases = {None: ("", ""), "": ("", ""), "no-scheme/x": ("", ""), "http://A.Org": ("a.org", ""), "x://É.com:8/p?q#f": ("É.com:8", "/p"),
             "a://b://c/d": ("b:", "//c/d"), "http://h?x=/y": ("h", ""), "http://h#/y": ("h", ""), "http://h/a\nb#c": ("h", "/a\nb"), "://x/": ("x", "/")}
    df = spark.createDataFrame([(u,) for u in cases], "url string")
    host, path = urls.host_and_path(F.col("url"))
    assert {r.url: (r.h, r.p) for r in df.select("url", host.alias("h"), path.alias("p")).collect()} == cases


def test_url_rules_and_edges(spark):
    pages = spark.createDataFrame([
        (1, "http://a.example.org/es/x"), (2, "http://example.org/en/12"), (3, "http://example.org/fr"), (4, "http://example.org"),
        (5, "http://borg/"), (6, "http://x.com/fr/"), (7, "http://x.com/de/"), (8, None), (None, "http://bad.net/"), (9, "http://bad.net/1"),
        (9, "http://bad.net/1"), (10, "http://good.net/1")] + [(100 + i, f"http://{'bad' if i % 2 else 'good'}.net/{i}") for i in range(200)],
        "page_id long, url string").withColumn("host", F.lit("z")).withColumn("good", F.lit("z"))
    labels = spark.createDataFrame([(100 + i, 1 - i % 2) for i in range(200)] + [(9, None), (None, 1), (100, 1), (10, 5)], "doc_id long, quality int")
    got = urls.judge(pages, labels, URL_RULES).collect()
    assert len(got) == 212
    by = {r.page_id: (r.rule, r.verdict) for r in got if r.page_id}
    assert by[1] == ("example.org/es/", "block") and by[2] == ("example.org/en/1", "block") and by[3] == ("org/", "allow")
    assert by[4][0] is None and by[5][0] is None and by[6] == ("com/fr/", "allow") and by[7] == ("com/de/", "block")
    assert by[9] == (None, "block") and by[10] == (None, "allow")
    assert urls.judge(pages.limit(0), labels, URL_RULES).count() == 0
    assert urls.judge(pages, labels.limit(0), []).count() == 212


def brute_base(docs, held):
    tok = [([*(t or "").encode().lower().split(), b""]) for _, t in docs]
    c = collections.Counter(w for (k, _), ws in zip(docs, tok) if not held(k) for w in ws)
    n, v = sum(c.values()), len(c)
    return sorted((repr(k), held(k), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6))
                  for (k, _), ws in zip(docs, tok))


def held(k):
    return zlib.crc32(("" if k is None else str(k)).encode()) % 7 == 2


def test_lm_edges(edge, empty, monkeypatch):
    monkeypatch.setattr(lm, "CHUNK_WORDS", 5_000)
    got = lm.score(edge.repartition(2), crc_mod("doc_id", 7) == 2, rounds=1).collect()
    assert sorted((repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == brute_base(
        edge_texts(), held)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert lm.score(empty, crc_mod("doc_id", 7) == 2, rounds=1).count() == 0
    assert lm.score(edge, F.lit(True), rounds=1).count() == len(edge_texts())


def test_lm_gradients():
    r = np.random.default_rng(0)
    net = lm.Network.start(r.random(lm.OUTPUTS))
    net.w = {k: w.astype(np.float64) for k, w in net.w.items()}
    codes, mask = r.integers(0, lm.OUTPUTS, (3, 5)), np.ones((3, 5), bool)
    mask[2, 3:] = False
    h = np.zeros((3, lm.HIDDEN))
    grads, _, _ = net.window(h, codes, mask)
    for k, g in grads.items():
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        old, sides = net.w[k][at], []
        for e in (1e-4, -1e-4):
            net.w[k][at] = old + e
            sides.append(net.window(h, codes, mask)[1])
        net.w[k][at] = old
        assert abs((sides[0] - sides[1]) / 2e-4 - g[at]) < 1e-3 * abs(g[at]) + 1e-5


def test_lm_probabilities_and_windows():
    """Outputs sum to one; whole documents equal a step-by-step pass."""
    r = np.random.default_rng(2)
    net = lm.Network.start(r.random(lm.OUTPUTS))
    h = (r.standard_normal((1, lm.HIDDEN)) * 0.5).astype(np.float32)
    lp, _ = net.outputs(np.repeat(h, lm.OUTPUTS, axis=0), np.arange(lm.OUTPUTS))
    assert abs(np.exp(lp).sum() - 1) < 1e-4
    docs = [r.integers(0, lm.OUTPUTS, n) for n in (1, 100, 33, 0, 32, 100)]
    got = net.log_probability(docs)
    for d, total in zip(docs, got):
        h, want = np.zeros((1, lm.HIDDEN), dtype=np.float32), 0.0
        for c in d:
            want += net.outputs(h, np.array([c]))[0][0]
            h, _ = net.step(h, np.array([c]))
        assert abs(want - total) < 1e-3


def test_lm_learns_every_window(monkeypatch):
    """Every token of every document is learnt from once, with the state carried on."""
    r = np.random.default_rng(3)
    docs = [r.integers(0, lm.OUTPUTS, n) for n in (1, 16, 700, 64, 3, 65, 2000, 33)]
    seen, cold, window = Counter(), 0, lm.Network.window

    def spy(self, h, codes, mask):
        nonlocal cold
        seen.update(codes[mask].tolist())
        cold += int((~h.any(axis=1)).sum())
        return window(self, h, codes, mask)

    monkeypatch.setattr(lm.Network, "window", spy)
    monkeypatch.setattr(lm, "START", 3)
    _, learnt = lm._learn(lm.Network.start(r.random(lm.OUTPUTS)), docs, 0.01)
    assert seen == Counter(np.concatenate(docs).tolist()) and learnt == sum(map(len, docs))
    assert cold == len(docs)


def test_lm_windows_side_by_side():
    """Several windows taken together give the sum of their gradients, losses and the last state."""
    r = np.random.default_rng(4)
    net = lm.Network.start(r.random(lm.OUTPUTS))
    net.w = {k: w.astype(np.float64) for k, w in net.w.items()}
    codes = r.integers(0, lm.OUTPUTS, (3, 3 * lm.WINDOW))
    mask = np.arange(3 * lm.WINDOW) < np.array([[3 * lm.WINDOW], [lm.WINDOW + 5], [2]])
    state = r.standard_normal((3, lm.HIDDEN)) * 0.3
    grads, loss, last = net.window(state, codes, mask)
    want, total, h = {k: 0 for k in grads}, 0.0, state
    for at in range(0, 3 * lm.WINDOW, lm.WINDOW):
        g, one, h = net.window(h, codes[:, at:at + lm.WINDOW], mask[:, at:at + lm.WINDOW])
        want, total = {k: want[k] + g[k] for k in g}, total + one
    assert abs(loss - total) < 1e-9 and np.allclose(last, h)
    assert all(np.allclose(grads[k], want[k], atol=1e-9) for k in grads)


def test_lm_learns_held_out(spark):
    """On texts with order in them the network beats the unigram on held-out rows."""
    r = random.Random(5)
    cycle = [f"w{i}" for i in range(30)]
    rows = [(i, " ".join(cycle[(r.randrange(30) + j) % 30] for j in range(1)) + " " + " ".join(
        cycle[(s + j) % 30] for s in [r.randrange(30)] for j in range(60))) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = lm.score(docs, crc_mod("doc_id", 7) == 2).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > 0.7 * got[1]


def test_oracles_exist():
    assert set(ORACLE) == {"op5_topk", "op6_url_reputation", "op12_filter_interactions", "op13_merkle_manifest"}
    assert len(QUERIES) == 13


def test_pipeline(spark):
    import corpus_pipeline as p

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    now = docs
    for name, stage in p.STAGES[:-1]:
        before = now
        now = spark.createDataFrame(stage(spark, now, sf).collect(), docs.schema)
        assert now.columns == docs.columns
        assert now.join(before, "doc_id", "left_anti").count() == 0
    want = p.STAGES[-1][1](spark, now, sf).agg(F.sum("length"), F.countDistinct("doc_id")).first()
    assert p.run(spark, sf).agg(F.sum("length"), F.countDistinct("doc_id")).first() == want
    assert 0 < want[1] < docs.count()
