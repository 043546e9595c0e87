"""Quality, toxicity, spans and near duplicates: rules by hand, brute force, edges."""

import itertools
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from lexiflow.llm import neardup, quality, spans, toxicity

from .conftest import EXTRA, edge_texts, prose


def test_base_counts_brute_force():
    r = random.Random(4)
    for _ in range(200):
        t = "".join(r.choice(["a", "b", "c|", " ", " ", "\n", "\t", "#", "é", "\x1c", "\u00a0"]) for _ in range(r.randint(0, 60)))
        words, now = [], ""
        for ch in t + " ":
            if ch in " \t\n\x0b\x0c\r":
                words += [now] if now else []
                now = ""
            else:
                now += ch
        seen, dup = set(), 0
        for line in t.split("\n"):
            if any(ch not in " \t\n\x0b\x0c\r" for ch in line):
                dup += line in seen
                seen.add(line)
        tri = Counter(zip(words, words[1:], words[2:]))
        inside = {i + k for i in range(len(words) - 2) if tri[tuple(words[i:i + 3])] > 1 for k in range(3)}
        assert quality.base_counts(t) == (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), dup, len(inside))


def test_quality_edges(edge, empty, labels, no_labels):
    model = quality.fit(edge, labels)
    got = quality.judge(edge, model).collect()
    assert len(got) == len(edge_texts())
    assert all(r.base_failed and not r.kept for r in got if r.n_words < 50)
    kept = quality.keep(edge, model)
    assert kept.columns == edge.columns and kept.count() == sum(r.kept for r in got)
    assert quality.judge(empty, quality.fit(empty, labels)).count() == 0
    plain = quality.fit(edge, no_labels)
    assert all(r.kept != r.base_failed for r in quality.judge(edge, plain).collect())


def junk(seed, n):
    r = random.Random(seed)
    return " ".join(w + r.choice(["###", "&&&", "$$$"]) for w in prose(seed, n).split())


def test_quality_separates(spark):
    rows = [(i, prose(i, 150) if i % 5 else junk(i, 150)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 > 0), 0) for i in range(150)], "doc_id long, quality int, toxic int")
    got = quality.judge(docs, quality.fit(docs, labels)).collect()
    assert all(r.kept == (r.doc_id % 5 > 0) for r in got)


def test_segments_brute_force():
    """A maximal segment: all its proper parts score less, and it lies in no longer such run."""
    r = random.Random(3)
    for _ in range(300):
        s = np.array([r.choice([-3, -2, -1, 1, 2, 4]) for _ in range(r.randint(1, 12))], dtype=float)
        n = len(s)

        def good(a, b):  # every proper prefix and suffix is positive
            return all(s[a:k].sum() > 0 for k in range(a + 1, b + 2)) and all(s[k:b + 1].sum() > 0 for k in range(a, b + 1))

        runs = [(a, b) for a in range(n) for b in range(a, n) if good(a, b)]
        want = {(a, b) for a, b in runs if not any((c, d) != (a, b) and c <= a and b <= d for c, d in runs)}
        found = toxicity.maximal_segments(s)
        assert {(a, b) for a, b, _ in found} == want
        assert all(abs(v - s[a:b + 1].sum()) < 1e-9 for a, b, v in found)


def test_toxicity_edges(edge, empty, labels, no_labels):
    for docs in (edge, empty):
        for lab in (labels, no_labels):
            model = toxicity.fit(docs, lab)
            got = toxicity.score(docs, model).collect()
            assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
            kept = toxicity.clean(docs, model)
            assert kept.columns == docs.columns and kept.count() == sum(r.score < 0.5 for r in got)


def test_toxicity_held_out(spark):
    r = random.Random(1)
    bad = ["grubhead", "slimeface", "foulness"]
    rows = []
    for i in range(600):
        words = prose(i, 200).split()
        if i % 6 == 0:
            for _ in range(6):
                words.insert(r.randrange(len(words)), r.choice(bad))
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i % 6 == 0)) for i in range(400)], "doc_id long, quality int, toxic int")
    got = toxicity.score(docs, toxicity.fit(docs, labels)).filter("doc_id >= 400").collect()
    assert all((x.score >= 0.5) == (x.doc_id % 6 == 0) for x in got)
    assert all(x.segments for x in got if x.doc_id % 6 == 0)


def test_toxicity_scores_every_occurrence():
    """A dense passage is found wherever it stands, each copy of it too."""
    model = toxicity.ToxicModel(forms={"=grub": (3.0, 9.0), "=slime": (3.0, 9.0)}, other=-1.0)
    far = " ".join(["grub slime" + " calm" * 30] * 3)
    passage = "grub slime grub slime"
    (n, alone), (_, late), (_, copies) = toxicity._segments(
        model, [passage, far + " " + passage, (passage + " calm" * 30 + " ") * 5], toxicity._Scores(model))
    assert n == 4 and alone == [(0, 3, 12.0)]
    assert (96, 99, 12.0) in late
    assert [s for _, _, s in copies] == [12.0] * 5


def brute_spans(docs, least):
    """Sentences covered by a run of at least ``least`` words, shortest from its
    start or to its end, that stands earlier too."""
    split = {k: [t[a:b].split() for a, b in spans.sentence_bounds(t)] for k, t in docs}
    first, found = {}, []
    for k in sorted(split):
        s = split[k]
        for a, b in itertools.combinations_with_replacement(range(len(s)), 2):
            size = sum(map(len, s[a:b + 1]))
            if size >= least and (size - len(s[a]) < least or size - len(s[b]) < least):
                words = tuple(map(tuple, s[a:b + 1]))
                found.append((k, a, b, words))
                first.setdefault(words, (k, a, b))
    gone = {k: set() for k in split}
    for k, a, b, words in found:
        if first[words] != (k, a, b):
            gone[k] |= set(range(a, b + 1))
    return gone


def test_spans_brute_force(spark):
    r = random.Random(9)
    passages = [prose(500 + i, 60).replace("\n", " ") for i in range(4)]
    docs = []
    for i in range(60):
        lines = prose(i, r.randint(0, 160)).split("\n")
        for _ in range(r.randint(0, 2)):
            lines.insert(r.randint(0, len(lines)), r.choice(passages))
        docs.append((i, "\n".join(lines)))
    docs.append((60, docs[3][1]))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute_spans(docs, 40)
    for x in spans.dedup(df).collect():
        t = dict(docs)[x.doc_id]
        bounds = spans.sentence_bounds(t)
        assert x.text == "".join(t[a:b] for i, (a, b) in enumerate(bounds) if i not in want[x.doc_id])
        assert x.dedup_info.removed == len(want[x.doc_id])
        assert "".join(t[a:b] for a, b in bounds) == t
    assert sum(map(len, want.values())) > 50


def test_spans_cut_sentences(spark):
    """A repeat of 51 words that starts and ends inside sentences loses its whole sentences."""
    words = [f"w{i}" for i in range(51)]
    words[11] += "."
    words[25] += "."
    words[38] += "."
    passage = " ".join(words)
    docs = [(1, f"one {passage} end."), (2, f"other words {passage} stop here.")]
    got = {r.doc_id: r for r in spans.dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[1].text == docs[0][1] and got[1].dedup_info.removed == 0
    assert got[2].dedup_info.removed == 2
    assert got[2].text == f"other words {' '.join(words[:12])} {' '.join(words[39:])} stop here."


def test_spans_edges(edge, empty):
    out = spans.dedup(edge)
    assert out.columns == [*edge.columns, "_dedup_info"] and out.count() == len(edge_texts())
    rows = {r.doc_id: r for r in out.filter("doc_id is not null").collect()}
    assert rows[1].text is None and rows[2].text == "" and rows[3].text == " \n\t "
    assert all(rows[4][c] == "z" for c in EXTRA)
    # the null key is first, so every other copy loses the passage
    assert rows[4].text == "" and rows[5].text == "" and rows[9].text == prose(3, 80) + "\n"
    assert rows[6].text == prose(2, 30_000)
    assert spans.dedup(empty).count() == 0


def test_alignment_brute_force():
    r = random.Random(6)
    for _ in range(200):
        a = r.sample(range(40), r.randint(1, 25))
        b = [x for x in a if r.random() < 0.93] or a[:1]
        for _ in range(r.randint(0, 2)):
            b.insert(r.randrange(len(b) + 1), r.randint(100, 200))
        b = list(dict.fromkeys(b))
        if r.random() < 0.3:
            i = r.randrange(len(b))
            b = b[i:] + b[:i]
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        long = best[-1][-1]
        s = long / (len(a) + len(b) - long)
        got = neardup.aligned_similarity(np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64))
        assert abs(got - (s if s >= 0.8 - 1e-12 else 0)) < 1e-9


def near_corpus():
    """Families: exact copies, near copies of a base that are not near each other, chains."""
    r, docs = random.Random(8), []
    for f in range(6):
        base = prose(1000 + f, 150).split(" ")
        docs.append(" ".join(base))
        docs += [" ".join(base)] * (f % 3)
        for _ in range(4 + 40 * (f == 0)):
            copy = list(base)
            for _ in range(r.randint(1, 5)):
                copy[r.randrange(len(copy))] = f"zz{r.randint(0, 10**6)}"
            docs.append(" ".join(copy))
        step = list(base)
        for _ in range(5):
            step[r.randrange(len(step))] = f"yy{r.randint(0, 10**6)}"
            docs.append(" ".join(step))
    docs += [prose(2000 + i, 100) for i in range(40)] + ["", "", "a b", "a b", "a c", "x y z w v", "x y z w v"]
    r.shuffle(docs)
    return list(enumerate(docs))


def brute_classes(docs):
    memo = neardup._WordHashes()
    seq = {k: neardup.shingles(t, memo) for k, t in docs}
    text, label = dict(docs), {k: k for k, _ in docs}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in itertools.combinations(sorted(seq), 2):
        if text[a] == text[b] or neardup.aligned_similarity(seq[a], seq[b]) > 0:
            ra, rb = root(a), root(b)
            label[max(ra, rb)] = min(ra, rb)
    return {k: root(k) for k in seq}


def test_near_duplicates_brute_force(spark, monkeypatch):
    docs = near_corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute_classes(docs)
    assert {r.doc_id: r.class_id for r in neardup.near_duplicates(df).collect()} == want
    monkeypatch.setattr(neardup, "TILE", 8)  # many tiles give the same classes
    assert {r.doc_id: r.class_id for r in neardup.near_duplicates(df).collect()} == want
    assert sorted(r.doc_id for r in neardup.first_of_each(df).collect()) == sorted(set(want.values()))


def test_near_duplicates_edges(edge, empty):
    got = neardup.near_duplicates(edge).collect()
    assert len(got) == len(edge_texts())
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by[4].class_id == by[5].class_id == 4 and by[1].class_id == by[2].class_id == 1
    assert by[6].class_id == 6 and by[2**60 + 1].class_id == 2**60 + 1
    first = neardup.first_of_each(edge)
    assert first.columns == edge.columns and first.count() == len({bytes(r.class_md5) for r in got})
    assert first.filter(F.col("text") == prose(1, 120)).count() == 1
    assert neardup.near_duplicates(empty).count() == 0 and neardup.first_of_each(empty).count() == 0
