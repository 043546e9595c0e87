"""SimHash and BK-trees against direct computation."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lexiflow.llm import simhash
from lexiflow.llm.queries import QUERIES

from .conftest import edge_texts, prose


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", low)
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i:i + 4]).encode(), 42) for i in range(max(len(words) - 3, 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows, radius=4):
    """(doc_id, fingerprint, least reachable id) by comparing all with all."""
    marks = [(i, brute_fingerprint(t)) for i, t in rows]
    points = sorted({p for _, p in marks})
    group = {p: p for p in points}

    def root(p):
        while group[p] != p:
            p = group[p]
        return p

    for k, p in enumerate(points):
        for q in points[k + 1:]:
            if (p ^ q).bit_count() <= radius:
                group[root(q)] = root(p)
    ids = {}
    for i, p in marks:
        if i is not None:
            ids[root(p)] = min(ids.get(root(p), i), i)
    return sorted(((i, f"{p:016x}", ids.get(root(p))) for i, p in marks), key=repr)


def got(df, **options):
    out = simhash.near_duplicates(df, **options).select("doc_id", F.lpad(F.lower(F.hex("point")), 16, "0"), "component_id")
    return sorted(map(tuple, out.collect()), key=repr)


def test_edges(spark, edge, empty):
    assert got(edge) == brute(edge_texts())
    assert got(empty) == []


def test_near_copies(spark):
    r = random.Random(3)
    base = [prose(i, 300) for i in range(12)]
    rows = []
    for i in range(240):
        words = r.choice(base).split(" ")
        for _ in range(r.choice([0, 0, 1, 3, 9])):
            words[r.randrange(len(words))] = r.choice(["Ka", "lo", "É", "x"])
        rows.append((i, " ".join(words)))
    rows += [(None, rows[0][1]), (1000, "one two"), (1001, "ONE\x0btwo"), (None, "alone here"), (-5, rows[7][1])]
    df = spark.createDataFrame([(*x, "p", "c") for x in rows], "doc_id long, text string, point string, cut string")
    want = brute(rows)
    assert got(df.repartition(5)) == want
    assert len({c for _, _, c in want}) < 200  # there are links


@pytest.mark.parametrize("tree", [4, 64, 1024])
def test_links_of_dense_and_spread_points(spark, tree):
    """Chains, a dense ball and a hot block value, with trees cut and not cut."""
    r = random.Random(tree)
    points = {r.getrandbits(64) for _ in range(300)}
    hub = r.getrandbits(64)
    points |= {hub ^ 1 << r.randrange(64) ^ 1 << r.randrange(64) for _ in range(150)}
    at = r.getrandbits(64)
    for _ in range(80):
        for b in r.sample(range(64), 4):
            at ^= 1 << b
        points.add(at)
    points |= {(r.getrandbits(51) << 13) | 77 for _ in range(200)} | {0, 2**64 - 1, 1}
    points = sorted(points)
    group = {p: p for p in points}

    def root(g, p):
        while g[p] != p:
            p = g[p]
        return p

    for k, p in enumerate(points):
        for q in points[k + 1:]:
            if (p ^ q).bit_count() <= 4:
                group[root(group, q)] = root(group, p)
    df = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in points], "point long")
    links = simhash.near_links(df.repartition(4), tree=tree).collect()
    other = {p: p for p in points}
    for a, b in links:
        other[root(other, b % 2**64)] = root(other, a % 2**64)

    def classes(g):
        out = {}
        for p in points:
            out.setdefault(root(g, p), []).append(p)
        return sorted(out.values())

    assert classes(group) == classes(other)


def test_tree_is_that_of_insertion():
    r = np.random.default_rng(1)
    points = np.unique(r.integers(0, 2**63, 500, dtype=np.uint64) >> np.uint64(44))
    r.shuffle(points)
    children, parent = {int(points[0]): {}}, {}
    for p in points[1:].tolist():
        at = int(points[0])
        while True:
            d = (p ^ at).bit_count()
            if d not in children[at]:
                children[at][d], children[p], parent[p] = p, {}, (at, d)
                break
            at = children[at][d]
    nodes, up, edge = simhash.bk_tree(points)
    assert sorted(nodes.tolist()) == sorted(points.tolist())
    assert all(parent[int(n)] == (int(nodes[u]), e) for n, u, e in zip(nodes[1:], up[1:].tolist(), edge[1:].tolist()))
    hits = {(q, n) for a, b in simhash.Searcher(nodes, up, edge).links(points) for q, n in zip(points[a].tolist(), nodes[b].tolist())}
    assert hits == {(p, q) for p in points.tolist() for q in points.tolist() if (p ^ q).bit_count() <= 4}


def test_query(spark):
    out = QUERIES["op11_simhash"](spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, out.collect()), key=repr) == brute([tuple(d) for d in docs])
