"""Toxic passages by maximum-scoring segment search.

Every word has a log-odds score: how much more often it (or one of its leading
parts) occurs in toxic than in clean labelled documents, shrunk by a Dirichlet
prior that is centred on the pooled frequency. Words without a significant form
share the log-odds of the rest, which is below zero. A linear-time scan finds
all maximal scoring segments of a document; the chance that a clean document of
that length holds a segment as good follows an extreme-value law, whose two
parameters, lambda and K, are fitted together to the clean labelled documents. The
evidence of a document is the largest -log chance of its r best segments together,
by the sum statistic of that law. It gives the score through a logistic curve that
never falls, and a text without a segment has the least evidence at any length.

Near copies in the labelled rows say no more than one of them: of rows that share
their least shingle hash one is fitted on."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep_rows, prepare, text_of, written

#: Labelled rows of each class that the model is fitted on, at most.
SAMPLE_PER_CLASS = 8_000
#: Word forms the model keeps, at most (those with the largest z).
MODEL_FORMS = 20_000
#: Mass of the Dirichlet prior, in words.
PRIOR = 500.0
#: Added to each form's share of the prior, so that rare forms shrink too.
FLOOR = 0.5
#: Least |z| of a form that has a score of its own.
MIN_Z = 4.0
#: Least |log-odds| of a form that has a score of its own. Where many rows are fitted
#: on, small differences (a language's commonest words, where it has a few more toxic
#: texts than others) are significant too; scores of such words add up over any text of
#: that language, so that clean texts have segments as long as themselves.
MIN_ODDS = math.log(2)
#: A clean text's best segment says no more than this score when the law is fitted:
#: single texts that repeat a word hundreds of times would set lambda for all others.
LARGEST_BEST = 10.0
#: Documents of the sample that must hold a form.
MIN_DOCS = 5
#: Words of the shingles whose least hash tells near copies in the fitting sample.
SHINGLE = 5
#: Evidence of a text without a segment, and the least of one that has any.
NO_EVIDENCE, LEAST_EVIDENCE = -8.0, -7.5
#: Lengths of the leading parts of a word that are forms beside the whole word.
PREFIXES = (4, 5, 6, 7, 8)
OUTER = re.compile(r"^\W+|\W+$")


def word_forms(raw: bytes) -> list[str]:
    """The forms of a word as it stands between white space."""
    word = OUTER.sub("", raw.decode().lower())
    if not word:
        return []
    return ["=" + word, *(word[:k] for k in PREFIXES if len(word) >= k)]


@dataclass
class ToxicModel:
    forms: dict[str, tuple[float, float]] = field(default_factory=dict)  # form -> score, |z|
    other: float = -1e-3
    decay: float = 1.0      # lambda of the extreme-value law
    size: float = 1.0       # K
    curve: tuple[float, float] = (-20.0, 0.0)

    def word_score(self, raw: bytes) -> float:
        best = max((self.forms[f] for f in word_forms(raw) if f in self.forms), key=lambda x: x[1], default=None)
        return best[0] if best else self.other

    def evidence(self, n: int, segments: list[tuple[int, int, float]]) -> float:
        """-log chance of the r best segments in a clean text, for the r that makes it
        largest. The law counts the words outside segments, so one more toxic
        passage never lowers it."""
        if not segments:
            return NO_EVIDENCE
        outside = max(n - sum(b - a + 1 for a, b, _ in segments), 1)
        law = math.log(max(self.size * outside, 1e-9))
        best, total, factorials = LEAST_EVIDENCE, 0.0, 0.0
        for r, s in enumerate(sorted((x for _, _, x in segments), reverse=True), 1):
            surplus = self.decay * s - law
            if r > 1 and surplus <= 0:
                break
            total += surplus
            if r == 1:
                best = max(best, total)
            else:  # e^-T T^(r-1) / (r! (r-1)!), for T beyond r (r - 1)
                factorials += math.log(r) + math.log(r - 1)
                if total > r * (r - 1):
                    best = max(best, total - (r - 1) * math.log(total) + factorials)
        return min(best, 50.0)

    def probability(self, evidence: float) -> float:
        a, b = self.curve
        x = min(max(a + b * evidence, -40.0), 40.0)
        return 1.0 / (1.0 + math.exp(-x))

    def p_value(self, n: int, score: float) -> float:
        return -math.expm1(-self.size * n * math.exp(-self.decay * score))


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score) in one pass. Each open
    candidate links to the nearest one on its left with a smaller left sum, so a
    search never revisits what a later candidate has passed."""
    total = np.concatenate([[0.0], np.cumsum(scores)])
    found: list[list] = []  # first, last, left sum, right sum, link
    for i in np.flatnonzero(scores > 0).tolist():
        first, left, right = i, float(total[i]), float(total[i + 1])
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= left:
                j = found[j][4]
            if j < 0 or found[j][3] >= right:
                found.append([first, i, left, right, j])
                break
            first, left = found[j][0], found[j][2]
            del found[j:]
    return [(a, b, r - left) for a, b, left, r, _ in found]


def extreme_value_law(lengths: np.ndarray, best: np.ndarray) -> tuple[float, float]:
    """lambda and K of P(best <= s) = exp(-K n exp(-lambda s)) by maximum likelihood. A
    text without a segment says that its best is at most 0, one with a best above
    ``LARGEST_BEST`` that it is at least that. For a lambda the best K is known; lambda
    is the best of a grid."""
    found = best > 0
    if not found.any():
        return 1.0, 1.0 / max(float(lengths.sum()), 1.0)
    exact, best = int((found & (best <= LARGEST_BEST)).sum()), np.minimum(best, LARGEST_BEST)
    count, total = int(found.sum()), float(best[found].sum())
    top = (-math.inf, 1.0, 1.0)
    for decay in np.linspace(0.02, 3.0, 150).tolist():
        size = count / max(float((lengths * np.exp(-decay * best)).sum()), 1e-9)
        top = max(top, (exact * math.log(decay) + count * math.log(size) - decay * total, decay, size))
    return top[1], top[2]


def _least_shingle(text: str) -> int:
    """The least hash of the runs of ``SHINGLE`` words (a shorter text: of all)."""
    from xxhash import xxh3_64_intdigest

    words = text.lower().encode().split()
    return min(xxh3_64_intdigest(b" ".join(words[i:i + SHINGLE])) for i in range(max(len(words) - SHINGLE + 1, 1))) >> 1


class _Scores(dict):
    def __init__(self, model: ToxicModel):
        self.model = model

    def __missing__(self, raw: bytes) -> float:
        if len(self) > 150_000:
            self.clear()
        score = self[raw] = self.model.word_score(raw)
        return score


def _segments(model: ToxicModel, texts: list[str], memo: dict):
    """(words, segments) of each text."""
    for t in texts:
        words = t.encode().split()
        scores = np.fromiter(map(memo.__getitem__, words), dtype=np.float64, count=len(words))
        yield len(words), (maximal_segments(scores) if len(words) and scores.max() > 0 else [])


def _sample(labels: DataFrame, per_class: int) -> DataFrame:
    """At most ``per_class`` labelled rows of each class, by hash order."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter(
        F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).dropDuplicates(["doc_id"])
    parts = [rows.filter(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)]
    return parts[0].unionAll(parts[1])


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, key: str = "doc_id",
        text: str = "text") -> ToxicModel:
    """Fit on the labelled rows given (``doc_id``, ``toxic``), at most
    ``per_class`` of each class. Labels that are null or not 0 or 1 are left out,
    of repeated ones one counts. Without rows of both classes the model scores
    every document near 0."""
    prepare(docs.sparkSession)
    sample = _sample(labels, per_class)
    # at most 2 * per_class ids: a bounded broadcast. Of an id's rows the least text
    # counts, of near copies of one class the least id: at most as many rows as ids
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), text_of(docs, text).alias("text")).join(
        F.broadcast(sample), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))

    def shingle(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(map(_least_shingle, batch.column(2).to_pylist()), pa.int64())],
                                             ["doc_id", "toxic", "text", "shingle"])

    rows = written(rows.mapInArrow(shingle, "doc_id long, toxic int, text string, shingle long"), "toxic-sample", compression="zstd")
    one = rows.groupBy("shingle", "toxic").agg(F.min("doc_id").alias("doc_id"))
    rows = written(rows.join(one, ["shingle", "toxic", "doc_id"]).select("text", "toxic"), "toxic-sample", compression="zstd")

    def count(batches):
        import pyarrow as pa
        from collections import Counter, defaultdict

        forms = defaultdict(lambda: [0] * 5)
        for batch in batches:
            for t, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own: Counter = Counter()
                for w, n in Counter(t.encode().split()).items():
                    own[""] += n
                    for f in word_forms(w):
                        own[f] += n
                for f, n in own.items():
                    x = forms[f]
                    x[c] += n
                    x[2 + c] += n * n
                    x[4] += 1
        names = list(forms)
        for at in range(0, len(names), 50_000):
            part = names[at:at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), *(pa.array(x, pa.int64()) for x in zip(*(forms[f] for f in part)))],
                                             ["form", *numbers])

    # times in clean and toxic texts, both as sums of a text's squares, and texts
    numbers = ("clean", "toxic", "clean_squares", "toxic_squares", "docs")
    counts = written(rows.mapInArrow(count, "form string, " + ", ".join(f"{c} long" for c in numbers)).groupBy("form").agg(
        *(F.sum(c).alias(c) for c in numbers)).filter((F.col("form") == "") | (F.col("docs") >= MIN_DOCS)), "toxic-forms")
    totals = counts.filter(F.col("form") == "").select("clean", "toxic").first()
    n0, n1 = totals or (0, 0)
    if not n0 or not n1:
        return ToxicModel()
    prior = PRIOR * (F.col("clean") + F.col("toxic")) / (n0 + n1) + FLOOR
    y0, y1 = F.col("clean") + prior, F.col("toxic") + prior
    odds = F.log(y1 / (n1 + PRIOR - y1)) - F.log(y0 / (n0 + PRIOR - y0))
    # words come in bursts: a count varies by its texts' squares, not by itself, so one
    # document that repeats itself says little more than one that doesn't
    spread = (F.col("clean_squares") + prior) / (y0 * y0) + (F.col("toxic_squares") + prior) / (y1 * y1)
    best = (counts.filter("form != ''")
            .withColumn("odds", odds).withColumn("z", F.abs(odds) / F.sqrt(spread))
            .filter((F.col("z") >= MIN_Z) & (F.abs("odds") >= MIN_ODDS)).orderBy(F.desc("z"), "form").limit(MODEL_FORMS).collect())
    model = ToxicModel()
    if not best:
        return model
    model.forms = {r["form"]: (float(r["odds"]), float(r["z"])) for r in best}

    # second pass over the sample: share of scored words, then segments
    def own_share(batches):
        import pyarrow as pa

        memo, seen = _Scores(model), np.zeros((2, 2))
        for batch in batches:
            for t, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = t.encode().split()
                scores = np.fromiter(map(memo.__getitem__, words), dtype=np.float64, count=len(words))
                seen[c] += ((scores != model.other).sum(), len(words))
        yield pa.RecordBatch.from_pydict({"c": [0, 1], "own": seen[:, 0], "n": seen[:, 1]})

    share = {r["c"]: (r["own"] + 1) / (r["n"] + 2) for r in rows.mapInArrow(own_share, "c long, own double, n double")
             .groupBy("c").agg(F.sum("own").alias("own"), F.sum("n").alias("n")).collect()}
    model.other = min(math.log((1 - share[1]) / (1 - share[0])), -1e-3)

    def measure(batches):
        import pyarrow as pa

        memo = _Scores(model)
        for batch in batches:
            c = batch.column(1).to_pylist()
            got = list(_segments(model, batch.column(0).to_pylist(), memo))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int32()), pa.array([n for n, _ in got], pa.int64()),
                 pa.array([n - sum(b - a + 1 for a, b, _ in seg) for n, seg in got], pa.int64()),
                 pa.array([[v for _, _, v in seg] for _, seg in got], pa.list_(pa.float64()))], ["toxic", "n", "outside", "s"])

    # one row for each sampled id at most, of segment scores only
    measured = rows.mapInArrow(measure, "toxic int, n long, outside long, s array<double>").collect()
    clean = [(max(r["outside"], 1), max(r["s"], default=0.0)) for r in measured if r["toxic"] == 0 and r["n"]]
    model.decay, model.size = extreme_value_law(np.array([n for n, _ in clean], dtype=float), np.array([v for _, v in clean]))
    x = np.array([(1.0, model.evidence(max(r["outside"], 1), [(0, -1, v) for v in r["s"]])) for r in measured])
    y = np.array([float(r["toxic"]) for r in measured])
    both = {c: max(int((y == c).sum()), 1) for c in (0, 1)}
    kept = {r["toxic"]: r["count"] for r in labels.groupBy(F.col("toxic").cast("int").alias("toxic")).count().collect()}
    weight = np.where(y == 1, kept.get(1, 1) / both[1], kept.get(0, 1) / both[0])
    a, b = logistic(x, y, weight)
    model.curve = (a, b) if b > 0 else (math.log(max((weight * y).sum(), 1) / max((weight * (1 - y)).sum(), 1)), 0.0)
    return model


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2, steps: int = 30) -> list[float]:
    """Weighted, lightly ridged logistic regression by Newton steps."""
    x = np.clip(x, -50, 50)
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (y - p)) - ridge * w
        h = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w))
        w = w + np.linalg.solve(h, g)
    return w.tolist()


def score(docs: DataFrame, model: ToxicModel, key: str = "doc_id", text: str = "text", max_p: float = 0.05) -> DataFrame:
    """``doc_id``, ``score`` (0 to 1), ``n_words`` and the significant ``segments``
    (first and last word, score, chance in a clean text) of every row.

    Null and empty texts have no words and the score of a text without evidence.
    Null keys and repeated rows are scored like any other; an empty table gives
    no rows; columns other than the two named are not read. Texts are scanned
    whole, in time linear in their words."""
    prepare(docs.sparkSession)

    def run(batches):
        import pyarrow as pa

        memo = _Scores(model)
        kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64()), ("p", pa.float64())]))
        for batch in batches:
            got = list(_segments(model, batch.column(1).to_pylist(), memo))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([model.probability(model.evidence(n, s)) for n, s in got], pa.float64()),
                 pa.array([n for n, _ in got], pa.int64()),
                 pa.array([[{"first": a, "last": b, "score": v, "p": p} for a, b, v in s if (p := model.p_value(n, v)) <= max_p]
                           for n, s in got], kind)], ["doc_id", "score", "n_words", "segments"])

    return docs.select(F.col(key).cast("long").alias("doc_id"), text_of(docs, text).alias("text")).mapInArrow(
        run, "doc_id long, score double, n_words long, "
             "segments array<struct<first:bigint,last:bigint,score:double,p:double>>")


def clean(docs: DataFrame, model: ToxicModel, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``least``, with all their columns."""
    prepare(docs.sparkSession)

    def passes():
        memo = _Scores(model)

        def test(t: str) -> bool:
            (n, segments), = _segments(model, [t], memo)
            return model.probability(model.evidence(n, segments)) < least

        return test

    return keep_rows(docs, text, passes)
