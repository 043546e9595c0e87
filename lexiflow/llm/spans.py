"""Substring dedup by sliding sentence spans.

Sentences end at a line feed or after ``.``, ``!`` or ``?`` before white space.
From every sentence the shortest run of consecutive sentences with at least
``min_words`` words is hashed, forwards and backwards, so that the last
sentences of a passage are covered as well. Spans with equal hashes are found by
one aggregate over the whole corpus; every occurrence but the first, in order of
document and place, is removed."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, text_of, written

#: Words a run of sentences must reach: few enough that a repeat of 51 words holds a
#: run of whole sentences though it starts and ends inside some of up to 13 words.
MIN_WORDS = 25
SENTENCE = re.compile(r"\n+|(?<=[.!?])[ \t\r\f\v]+")


def sentence_bounds(text: str) -> list[tuple[int, int]]:
    """Start and end of each sentence with a word; what separates them belongs to
    the sentence before, and to the first one what stands before it."""
    cuts = [0, *(m.end() for m in SENTENCE.finditer(text)), len(text)]
    out: list[tuple[int, int]] = []
    for a, b in zip(cuts, cuts[1:]):
        if a == b:
            continue
        if out and not text[a:b].strip():
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def sentence_spans(words: list[list[bytes]], min_words: int) -> list[tuple[int, int]]:
    """The runs (first, last sentence) to hash."""
    total = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    n = len(words)
    # shortest run from i: the least j with total[j + 1] >= total[i] + min_words
    j = np.searchsorted(total, total[:-1] + min_words) - 1
    # shortest run to j: the greatest i with total[i] <= total[j + 1] - min_words
    i = np.searchsorted(total, total[1:] - min_words, side="right") - 1
    runs = {(a, b) for a, b in enumerate(j.tolist()) if b < n} | {(a, b) for b, a in enumerate(i.tolist()) if a >= 0}
    return sorted(runs)


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """The whole row in one column, so that no name of its own can clash, then
    the key, a hash of the text and the text."""
    t = text_of(docs, text)
    return docs.select(F.struct("*").alias("_row"), F.col(key).cast("long").alias("_key"), F.xxhash64(t).alias("_hash"), t.alias("_text"))


def span_table(docs: DataFrame, min_words: int = MIN_WORDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per hashed run: 128 bits of hash, document, and in ``run`` its first
    (high 32 bits) and last sentence."""
    prepare(docs.sparkSession)

    def run(batches):
        import pyarrow as pa
        import xxhash

        names = ["h1", "h2", "_key", "_hash", "run"]
        kinds = [pa.int64()] * 5
        for batch in batches:
            cols = [[] for _ in names]
            for k, h, t in zip(*(batch.column(i).to_pylist() for i in range(3))):
                words = [t[a:b].encode().split() for a, b in sentence_bounds(t)]
                lines = [b" ".join(w) for w in words]
                for a, b in sentence_spans(words, min_words):
                    d = xxhash.xxh3_128_intdigest(b"\n".join(lines[a:b + 1]))
                    for c, v in zip(cols, ((d >> 64) - (1 << 63), (d & (1 << 64) - 1) - (1 << 63), k, h, (a << 32) + b)):
                        c.append(v)
                if len(cols[0]) > 100_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, x) for c, x in zip(cols, kinds)], names)
                    cols = [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, x) for c, x in zip(cols, kinds)], names)

    return _keyed(docs, key, text).select("_key", "_hash", "_text").mapInArrow(
        run, "h1 long, h2 long, _key long, _hash long, run long")


def repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``_key``, ``_hash`` and ``runs`` (first and last sentence) of every document
    that holds a non-first occurrence."""
    spans = written(span_table(docs, min_words, key, text), "spans", compression="zstd")
    # what moves is one hash and a count; only spans whose hash comes again go on
    # (written, so that the join has an exchange of its own whose hot hash can be split)
    often = written(spans.groupBy("h1").agg(F.count("*").alias("n")).filter("n > 1").select("h1"), "repeated-hashes", compression="zstd")
    shared = written(spans.join(often, "h1"), "shared-spans", compression="zstd")
    place = F.struct("_key", "_hash", "run")
    origins = written(shared.groupBy("h1", "h2").agg(F.min(place).alias("origin"), F.count("*").alias("n")).filter("n > 1").drop("n"),
                      "origins", compression="zstd")
    later = shared.join(origins, ["h1", "h2"]).filter(~F.col("origin").eqNullSafe(place))
    first, last = F.shiftright("run", 32).cast("int").alias("first"), F.col("run").bitwiseAND(0xFFFFFFFF).cast("int").alias("last")
    return later.groupBy("_key", "_hash").agg(F.collect_set(F.struct(first, last)).alias("runs"))


def dedup(docs: DataFrame, min_words: int = MIN_WORDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of ``docs``, its text without the sentences of non-first spans,
    and ``dedup_info``: a struct of ``sentences``, ``removed`` (how many) and
    ``cuts`` (the character ranges that were removed). Where ``docs`` has such a
    column, the new one gets underscores before its name.

    Null texts stay null, empty ones empty. Rows with equal key and text are one
    document and get the same result; so do null keys with equal text. Documents
    are ordered by key (null first), then by a hash of the text. An empty table
    gives no rows; other columns are kept as they are."""
    prepare(docs.sparkSession)
    info = "dedup_info"
    while info in docs.columns:
        info = "_" + info
    keyed = _keyed(docs, key, text)
    runs = repeated_spans(docs, min_words, key, text).select(
        F.col("_key").alias("_k"), F.col("_hash").alias("_h"), "runs")
    rows = keyed.join(runs, keyed["_key"].eqNullSafe(F.col("_k")) & (keyed["_hash"] == F.col("_h")), "left").select(
        "_row", "_text", F.coalesce("runs", F.array().cast("array<struct<first:int,last:int>>")).alias("_runs"))

    @F.pandas_udf("struct<text:string,sentences:int,removed:int,cuts:array<struct<start:int,end:int>>>")
    def cut(texts, runs):
        import pandas as pd

        out = []
        for t, some in zip(texts, runs):
            bounds = sentence_bounds(t)
            gone = np.zeros(len(bounds) + 1, dtype=np.int64)
            for r in some:
                gone[r["first"]] += 1
                gone[r["last"] + 1] -= 1
            gone = np.cumsum(gone)[:len(bounds)] > 0
            cuts: list[dict] = []
            for (a, b), g in zip(bounds, gone):
                if g and cuts and cuts[-1]["end"] == a:
                    cuts[-1]["end"] = b
                elif g:
                    cuts.append({"start": a, "end": b})
            out.append(("".join(t[a:b] for (a, b), g in zip(bounds, gone) if not g) if cuts else t,
                        len(bounds), int(gone.sum()), cuts))
        return pd.DataFrame(out, columns=["text", "sentences", "removed", "cuts"])

    rows = rows.select("_row", cut("_text", "_runs").alias("_new"))
    old = F.col("_row").getField(text)
    return rows.select(*(F.when(old.isNotNull(), F.col("_new.text")).alias(c) if c == text else F.col("_row").getField(c).alias(c)
                         for c in docs.columns),
                       F.struct("_new.sentences", "_new.removed", "_new.cuts").alias(info))
