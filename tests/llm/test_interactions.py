"""Filter interaction audit against direct application of every order."""

import itertools
import math
import random
import re
from collections import defaultdict

import pytest

from lexiflow.llm import interactions


def brute(rows, labels):
    """rows: (doc_id, part, text); labels: (doc_id, quality, toxic)."""
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    fails, parts = [], defaultdict(list)
    for at, (i, part, text) in enumerate(rows):
        text = text or ""
        words = re.findall("[^\x20\x09-\x0d]+", text)
        fails.append({f for f, bad in [
            ("A", len(words) < 50), ("B", 100 * len(set(words)) < 65 * len(words)),
            ("C", 100 * len(re.findall("[A-Z]", text)) > 5 * len(text)), ("D", bool(re.search("[#$%&*|]", text))),
            ("E", any(i is not None and j is not None and j < i and (u or "") == text for j, _, u in rows))] if bad})
        parts[part or ""].append(at)
    out = []
    for part, members in parts.items():
        shares = defaultdict(int)
        mine = []
        for order in itertools.permutations("ABCDE"):
            left = list(members)
            for step, f in enumerate(order, 1):
                here = [m for m in left if f in fails[m]]
                left = [m for m in left if f not in fails[m]]
                shares[f] += len(here)
                mine.append((f, (part, "".join(order), step, len(left), len(here), sum(f in fails[m] for m in members) - len(here),
                                 sum(fails[m] == {f} for m in members), sum(rows[m][0] in good for m in here),
                                 sum(rows[m][0] in toxic for m in here))))
        out += [(*r, shares[f]) for f, r in mine]
    return sorted(out)


def test_audit_brute_force(spark, edge, labels, empty, no_labels):
    r = random.Random(5)
    texts = ["ab " * n + x for n in (3, 49, 50, 80) for x in ("", "#", "AB CD", "é\x0bü")] + [" ".join(f"w{i}" for i in range(n)) for n in (50, 51)]
    rows = [(r.choice([None, *range(200)]), r.choice(["a", "b", "", None]), r.choice([None, "", *texts])) for _ in range(250)]
    marks = [(r.choice([None, *range(200)]), r.choice([0, 1, None, 7]), r.choice([0, 1, None])) for _ in range(200)]
    docs = spark.createDataFrame([(*x, "z", "z", "z") for x in rows], "doc_id long, source string, text string, mask string, digest string, part string")
    found = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = interactions.audit(interactions.failures(docs.repartition(4)), found)
    assert sorted(map(tuple, got.collect())) == brute(rows, marks)
    edges = [(x.doc_id, x.source, x.text) for x in edge.collect()]
    got = interactions.audit(interactions.failures(edge), labels)
    assert sorted(map(tuple, got.collect())) == brute(edges, [tuple(x) for x in labels.collect()])
    assert interactions.audit(interactions.failures(edge), no_labels).filter("good_lost + toxic_lost > 0").count() == 0
    assert interactions.audit(interactions.failures(empty), labels).count() == 0


@pytest.mark.parametrize("n", [2, 3, 5, 6])
def test_normal_equations_give_the_orders_sum(n):
    """Against the weighted sum over coalitions that defines the Shapley value."""
    r = random.Random(n)
    v = [0] + [r.randint(-50, 50) for _ in range((1 << n) - 1)]
    for f, row in enumerate(interactions.shapley_matrix(n)):
        direct = sum(math.factorial(s.bit_count()) * math.factorial(n - 1 - s.bit_count()) * (v[s | 1 << f] - v[s])
                     for s in range(1 << n) if not s >> f & 1)
        assert sum(a * b for a, b in zip(row, v)) == direct


def test_filters_checked(spark, labels):
    flags = spark.createDataFrame([(1, "a", 1)], "doc_id long, part string, mask int")
    got = interactions.audit(flags, labels, "XY").collect()
    assert sorted(tuple(x)[1:5] for x in got) == [("XY", 1, 0, 1), ("XY", 2, 0, 0), ("YX", 1, 1, 0), ("YX", 2, 0, 1)]
    with pytest.raises(ValueError):
        interactions.audit(flags, labels, "AA")
