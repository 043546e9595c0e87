"""Merkle manifest against a direct construction."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from lexiflow.llm import merkle
from lexiflow.llm.common import crc_mod


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row) -> str:
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(hashes):
    out = [hashes]
    while len(out[-1]) > 1:
        below = out[-1]
        out.append([sha("".join(below[i:i + 16])) for i in range(0, len(below), 16)])
    return out


def climb(built, at, value):
    """Siblings on the way up and the digest that ``value`` at leaf ``at`` leads to."""
    met = ""
    for level in built[:-1]:
        low = at // 16 * 16
        run = level[low:low + 16]
        met += "".join(run[:at - low] + run[at - low + 1:])
        value = sha("".join([*run[:at - low], value, *run[at - low + 1:]]))
        at //= 16
    return met, value


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    parts = {}
    for r in rows:
        low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
        bad = zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 5 == 0
        forged = leaf_of((*r[:4], r[4].translate(low) if bad and r[4] is not None else r[4]))
        parts.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf_of(r), forged, r[0]))
    order = sorted(parts, key=lambda p: (p is not None, (p or "").encode()))
    trees = {p: (sorted(parts[p]), levels([x[2] for x in sorted(parts[p])])) for p in order}
    top = levels([trees[p][1][-1][0] for p in order])
    out = []
    for at, p in enumerate(order):
        leaves, built = trees[p]
        for i, x in enumerate(leaves):
            met, value = climb(built, i, x[3])
            more, value = climb(top, at, value)
            out.append((x[4], x[2], built[-1][0], top[-1][0], sha(met + more), value, value == top[-1][0]))
    return sorted(out, key=repr)


def got(df):
    rows = merkle.prove(merkle.manifest_of(df, crc_mod("doc_id", 5) == 0)).collect()
    return sorted(map(tuple, rows), key=repr)


FIELDS = "doc_id", "source", "lang", "n_chars", "text"


def test_edges(spark, edge, empty):
    assert got(edge) == brute([tuple(r[c] for c in FIELDS) for r in edge.collect()])
    assert got(empty) == []
    assert got(edge.limit(1)) == brute([tuple(edge.first()[c] for c in FIELDS)])


@pytest.mark.parametrize("sources", [["only"], [None, "", "=", "a", "b", "é", "\U0001F600", "￿", *(f"s{i}" for i in range(20))]])
def test_deep_and_wide(spark, sources):
    r = random.Random(len(sources))
    rows = [(r.choice([None, *range(6000)]), r.choice([sources[0]] * 20 + sources), r.choice(["en", None]),
             r.choice([None, 5]), r.choice([None, "", "Ab C", "x", "É Z", str(i)])) for i in range(4500)]
    rows += [rows[3]] * 40
    df = spark.createDataFrame([(*x, "h", "p") for x in rows], "doc_id long, source string, lang string, n_chars long, text string, hash string, place string")
    assert got(df.repartition(7)) == brute(rows)


def test_nodes_are_linked(spark, edge):
    """Every inner node but the root names its parent, which holds its digest there."""
    m = merkle.manifest_of(edge.crossJoin(spark.range(30)).withColumn("source", F.concat(F.lit("s"), F.col("id") % 18)), F.lit(False))
    nodes = m.nodes
    up = nodes.select(*(F.col(c).alias("p_" + c) for c in ("tree", "level", "idx", "kids")))
    links = nodes.join(up, (nodes.up_tree == up.p_tree) & (nodes.up_level == up.p_level) & (nodes.up_idx == up.p_idx), "left")
    rows = links.collect()
    assert sum(x.up_tree is None for x in rows) == 1
    assert all(x.up_tree is None and x.hash == m.root or x.p_kids[64 * x.place:64 * x.place + 64] == x.hash for x in rows)
    assert merkle.prove(m).filter("verified").count() == edge.count() * 30
