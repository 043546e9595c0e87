"""Quality rules: base counts of a text, and a length-normalised log-likelihood
ratio between two hashed n-gram multinomials, of a trusted target and of the raw
corpus. A document stays when its mean log ratio reaches a fixed threshold."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep_rows, prepare, text_of

#: Hash buckets of the two multinomials.
BUCKETS = 1 << 17
#: Labelled rows of each class that trusted counts and the threshold are taken from, at most.
SAMPLE_PER_CLASS = 8_000
#: Share of the raw corpus' distribution mixed into the trusted one.
RAW_SHARE = 0.02
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
TOKEN = re.compile(r"\w+|[^\w\s]+")

BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


class _Ids(dict):
    def __missing__(self, key):
        self[key] = len(self)
        return self[key]


def repeated_words(ids: np.ndarray) -> int:
    """Words inside 3-word windows that the text holds at least twice."""
    n = len(ids) - 2
    if n < 2:
        return 0
    _, pair = np.unique(ids[:-2] * (int(ids.max()) + 1) + ids[1:-1], return_inverse=True)
    _, key, times = np.unique(pair.astype(np.int64) * (int(ids.max()) + 1) + ids[2:], return_inverse=True, return_counts=True)
    at = np.flatnonzero(times[key] > 1)
    covered = np.zeros(len(ids), dtype=bool)
    for k in range(3):
        covered[at + k] = True
    return int(covered.sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.encode().split()
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    ids = np.fromiter(map(_Ids().__getitem__, words), dtype=np.int64, count=len(words))
    return (len(words), len(text) - sum(map(text.count, SPACE)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(ids))


def base_failed(n_words, n_repeat_words):
    """The base rules, for numbers or columns."""
    return (n_words < 50) | (100 * n_repeat_words > 50 * n_words)


class _Hashes(dict):
    def __missing__(self, token: str) -> int:
        if len(self) > 150_000:
            self.clear()
        h = self[token] = zlib.crc32(token.encode())
        return h


def ngram_buckets(text: str, memo: dict, buckets: int) -> np.ndarray:
    """Hash buckets of all 1- and 2-grams of the text's tokens."""
    tokens = TOKEN.findall(text)
    h = np.fromiter(map(memo.__getitem__, tokens), dtype=np.uint64, count=len(tokens))
    both = np.concatenate([h * np.uint64(0x9E3779B97F4A7C15),
                           (h[:-1] * np.uint64(0xBF58476D1CE4E5B9)) ^ (h[1:] * np.uint64(0x94D049BB133111EB))])
    both = (both ^ (both >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return ((both >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


@dataclass
class QualityModel:
    ratios: np.ndarray | None = None   # log ratio of each bucket
    threshold: float = -1e9

    def score(self, text: str, memo: dict) -> float:
        if self.ratios is None:
            return 0.0
        at = ngram_buckets(text, memo, len(self.ratios))
        return float(self.ratios[at].mean()) if len(at) else 0.0


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, buckets: int = BUCKETS,
        key: str = "doc_id", text: str = "text") -> QualityModel:
    """Raw counts over every document, trusted counts over at most ``per_class``
    rows labelled ``quality`` 1. A fourth of those rows is kept from the counts; the
    threshold is what best separates them from as many rows labelled 0, among
    those that pass the base rules. Null labels are left out, of repeated ones one counts.
    Without trusted rows every document scores 0 and stays."""
    prepare(docs.sparkSession)
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).filter(
        F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).dropDuplicates(["doc_id"])
    sample = rows.filter("quality = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class).unionAll(
        rows.filter("quality = 0").orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)).withColumn(
        "role", F.when(F.col("quality") == 0, 0).when(F.pmod(F.xxhash64(F.lit("role"), "doc_id"), F.lit(4)) > 0, 1).otherwise(2))
    # at most 2 * per_class ids: a bounded broadcast
    flagged = docs.select(F.col(key).cast("long").alias("doc_id"), text_of(docs, text).alias("text")).join(
        F.broadcast(sample), "doc_id", "left").select("text", "role")

    def count(batches):
        import pyarrow as pa

        memo, seen = _Hashes(), np.zeros((2, buckets), dtype=np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                held, mark = [], []
                for t, role in zip(*(batch.column(i).slice(start, 500).to_pylist() for i in (0, 1))):
                    at = ngram_buckets(t, memo, buckets)
                    held.append(at)
                    if role == 1:
                        mark.append(at)
                for k, part in ((0, held), (1, mark)):
                    if part:
                        seen[k] += np.bincount(np.concatenate(part), minlength=buckets)
        at = np.flatnonzero(seen[0])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[0][at]), pa.array(seen[1][at])], ["bucket", "raw", "trusted"])

    # one row for each bucket, whatever the corpus: bounded by the parameter
    got = flagged.mapInArrow(count, "bucket long, raw long, trusted long").groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("trusted").alias("trusted")).toArrow()
    raw, trusted = np.zeros(buckets), np.zeros(buckets)
    raw[got["bucket"].to_numpy()] = got["raw"].to_numpy()
    trusted[got["bucket"].to_numpy()] = got["trusted"].to_numpy()
    model = QualityModel()
    if not trusted.sum():
        return model
    p_raw = (raw + 1) / (raw.sum() + buckets)
    p_trusted = (1 - RAW_SHARE) * trusted / trusted.sum() + RAW_SHARE * p_raw
    model.ratios = np.log(p_trusted / p_raw).astype(np.float32)

    def rate(batches):
        import pyarrow as pa

        memo = _Hashes()
        for batch in batches:
            texts = batch.column(0).to_pylist()
            base = [base_counts(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array([model.score(t, memo) for t in texts], pa.float64())], ["role", "score"]).filter(
                pa.array([not base_failed(b[0], b[4]) for b in base], pa.bool_()))

    rated = flagged.filter("role <> 1").mapInArrow(rate, "role int, score double").toArrow()
    model.threshold = best_threshold(rated["score"].to_numpy(), (rated["role"].to_numpy() == 2).astype(int))
    return model


def best_threshold(scores: np.ndarray, quality: np.ndarray, keep: float = 0.998) -> float:
    """The cut that rejects most untrusted rows while at least ``keep`` of the
    trusted ones stay, put halfway between it and the next rejected score."""
    good, bad = np.sort(scores[quality == 1]), np.sort(scores[quality == 0])
    if not len(bad) or not len(good):
        return -1e9
    cut = good[int((1 - keep) * len(good))]
    below = bad[bad < cut]
    return float((cut + below[-1]) / 2) if len(below) else float(cut) - 1e-6


def judge(docs: DataFrame, model: QualityModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, the base counts, ``base_failed``, ``score`` and ``kept`` of every row.

    Null and empty texts have no words: they fail the base rules. Null keys and
    repeated rows are judged like any other; an empty table gives no rows;
    columns other than the two named are not read. Texts are read whole."""
    prepare(docs.sparkSession)

    def run(batches):
        import pyarrow as pa

        memo = _Hashes()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            base = list(zip(*map(base_counts, texts))) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in base), pa.array([model.score(t, memo) for t in texts], pa.float64())],
                ["doc_id", *(c.split()[0] for c in BASE.split(", ")), "score"])

    out = docs.select(F.col(key).cast("long").alias("doc_id"), text_of(docs, text).alias("text")).mapInArrow(
        run, f"doc_id long, {BASE}, score double")
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("score") >= model.threshold))


def keep(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns."""
    prepare(docs.sparkSession)

    def passes():
        memo = _Hashes()

        def test(t: str) -> bool:
            n_words, _, _, _, n_repeat = base_counts(t)
            return not base_failed(n_words, n_repeat) and model.score(t, memo) >= model.threshold

        return test

    return keep_rows(docs, text, passes)
