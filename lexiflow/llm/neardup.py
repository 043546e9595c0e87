"""Near duplicates by order MinHash, verified by banded alignment.

A text is the sequence of its five-word shingles (words without case and edge
punctuation), each labelled with its running number among equal ones, so that no
two are the same. A sketch takes the
``PICKS`` shingles with the smallest hashes under one permutation and keeps them
in text order; texts that are alike in an edit sense agree in it. Texts with an
equal sketch share a bucket.

Two texts are linked when shingles aligned in order, L of them, make
L / (|A| + |B| - L) >= 0.8. Labelled shingles are distinct, so the longest
alignment is a longest increasing run of matching places; at that similarity
no aligned pair is further apart than (|A| + |B|) / 9 places, which is the band.

In each bucket the text that shares most buckets with others is the hub; all
members are verified against it. Members that are not linked to their hub are
compared with every member of the bucket, in tiles of bounded size inside a
task that gives back a spanning forest of the links: no pair list of a group is
ever made, and no member is left out."""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, text_of, written

WORDS = 5
SKETCHES = 16
PICKS = 3
SIMILARITY = 0.8
#: Punctuation that is not part of a word.
EDGES = ".,;:!?\"'()[]{}<>«»“”‘’„…¿¡-–—"
#: Members of a bucket in one side of a tile.
TILE = 256


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    """Hash of a word without case and edge punctuation, which an edit beside a
    sentence's end changes too; a word of punctuation alone is taken as it is."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 200_000:
            self.clear()
        bare = word.decode().lower().strip(EDGES).encode()
        h = self[word] = xxhash.xxh3_64_intdigest(bare or word)
        return h


def shingles(text: str, memo: dict) -> np.ndarray:
    """Hashes of the labelled five-word shingles in text order; a shorter text is
    one shingle, a text without words none."""
    words = text.encode().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(memo.__getitem__, words), dtype=np.uint64, count=len(words))
    n = max(len(h) - WORDS + 1, 1)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(min(WORDS, len(h))):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i:i + n])
    order = np.argsort(out, kind="stable")
    ranked = out[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    if not new.all():
        at = np.arange(n)
        label = np.empty(n, dtype=np.uint64)
        label[order] = (at - np.maximum.accumulate(np.where(new, at, 0))).astype(np.uint64)
        out = np.where(label > 0, _mix(out + label * np.uint64(0xD6E8FEB86659FD93)), out)
    return out


def sketch(sh: np.ndarray, sketches: int = SKETCHES, picks: int = PICKS) -> list[int]:
    """One signed 64-bit key for each permutation."""
    if not len(sh):
        return []
    seeds = np.arange(1, sketches + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h = _mix(sh[None, :] ^ seeds[:, None])
    if len(sh) > picks:
        at = np.sort(np.argpartition(h, picks - 1, axis=1)[:, :picks], axis=1)
        h = np.take_along_axis(h, at, 1)
    key = np.full(sketches, h.shape[1], dtype=np.uint64)
    for column in h.T:
        key = _mix(key * np.uint64(31) + column)
    return key.view(np.int64).tolist()


def aligned_similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """L / (|A| + |B| - L) of the longest banded alignment; 0 if it is below ``least``."""
    total = len(a) + len(b)
    need = least * total / (1 + least)  # the least L that reaches ``least``
    if min(len(a), len(b)) < need - 1e-9 or not total:
        return 0.0
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if len(i) < need - 1e-9:
        return 0.0
    near = np.abs(i - j) <= total - 2 * need + 1
    i, j = i[near], j[near]
    tails: list[int] = []
    for x in j[np.argsort(i)].tolist():
        at = bisect_left(tails, x)
        if at == len(tails):
            tails.append(x)
        else:
            tails[at] = x
    s = len(tails) / (total - len(tails))
    return s if s >= least - 1e-12 else 0.0


def _spanning(n: int, links: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Links that join what earlier ones have not."""
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for a, b in links:
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[rb] = ra
            out.append((a, b))
    return out


def tile_links(strays: list[np.ndarray], members: list[np.ndarray], same: np.ndarray, least: float) -> list[tuple[int, int]]:
    """A spanning forest of the links between strays and members (numbered after
    the strays). ``same`` marks pairs of one text."""
    sizes = np.array([len(m) for m in members])
    flat = np.concatenate(members)
    universe, at = np.unique(flat, return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    parent_links: list[tuple[int, int]] = []
    for s, a in enumerate(strays):
        mask = np.zeros(len(universe), dtype=np.int64)
        place = np.searchsorted(universe, a)
        place[place == len(universe)] = 0
        mask[place[universe[place] == a]] = 1
        shared = np.add.reduceat(mask[at], starts)
        could = (shared >= (least / (1 + least)) * (sizes + len(a)) - 1e-9) & ~same[s]
        parent_links += [(s, len(strays) + m) for m in np.flatnonzero(could).tolist() if aligned_similarity(a, members[m], least)]
    return _spanning(len(strays) + len(members), parent_links)


def components(links: DataFrame) -> DataFrame:
    """``node`` and the least ``label`` of its component for the ends of ``links``
    (``a``, ``b``): labels spread over links and along the labels' own labels
    until nothing changes. Each round is a written table."""
    both = written(links.select(F.col("a").alias("node"), F.col("b").alias("other")).unionAll(
        links.select(F.col("b").alias("node"), F.col("a").alias("other"))).distinct(), "links")
    labels = written(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("label")), "labels")
    while True:
        spread = both.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("label").alias("near"))
        step = labels.join(spread, "node").select("node", "label", F.least("label", "near").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("label").alias("far"))
        new = written(step.join(jump, "low", "left").select(
            "node", F.least("low", "far").alias("label"), (F.least("low", "far") != F.col("label")).alias("moved")), "labels")
        labels = new.select("node", "label")
        if not new.filter("moved").limit(1).count():
            return labels


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY,
                    sketches: int = SKETCHES, picks: int = PICKS) -> DataFrame:
    """``doc_id``, ``text_md5`` (binary), ``class_id`` (the least id of its class) and
    ``class_md5`` (the text that names the class) for every row.

    Rows with equal texts are one class; a null text counts as empty. Texts
    without words are classes of equal texts. Null keys take part; a class of null
    keys only has a null ``class_id`` and is told by ``class_md5``. Repeated rows
    each get a row. An empty table gives no rows; other columns are not read."""
    prepare(docs.sparkSession)
    base = docs.select(F.col(key).cast("long").alias("doc_id"), text_of(docs, text).alias("text")).withColumn(
        "cls", F.unhex(F.md5(F.col("text").cast("binary"))))

    def run(batches):
        import pyarrow as pa

        memo = _WordHashes()
        for batch in batches:
            keys = [sketch(shingles(t, memo), sketches, picks) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(keys, pa.list_(pa.int64()))],
                                             ["doc_id", "cls", "keys"])

    rows = written(base.mapInArrow(run, "doc_id long, cls binary, keys array<long>"), "sketches", compression="zstd")
    texts = rows.groupBy("cls").agg(F.min("doc_id").alias("least"), F.first("keys").alias("keys"))
    spots = texts.select("cls", F.posexplode("keys").alias("j", "bucket"))
    # sizes, hubs and stray counts are written before they are joined back: the join
    # then has an exchange of its own, and a hot bucket can be split over tasks
    sizes = written(spots.groupBy("j", "bucket").agg(F.count("*").alias("n")).filter("n > 1"), "bucket-sizes", compression="zstd")
    members = written(spots.join(sizes, ["j", "bucket"]), "buckets", compression="zstd")

    # the shingles of the texts that share a bucket with another
    wanted = members.groupBy("cls").agg(F.sum("n").alias("weight"))

    def sequences(batches):
        import pyarrow as pa

        memo = _WordHashes()
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([shingles(t, memo).tobytes() for t in batch.column(2).to_pylist()], pa.binary())],
                ["cls", "weight", "seq"])

    # one row for each text, taken in the map tasks: copies don't meet in one
    seqs = written(base.groupBy("cls").agg(F.first("text").alias("text")).join(wanted, "cls")
                   .select("cls", "weight", "text").mapInArrow(sequences, "cls binary, weight long, seq binary"), "sequences", compression="zstd")

    weights = seqs.select("cls", "weight")
    hubs = written(members.join(weights, "cls").groupBy("j", "bucket").agg(F.max_by("cls", F.struct("weight", "cls")).alias("hub")), "hubs")
    spokes = members.join(hubs, ["j", "bucket"]).filter(F.col("cls") != F.col("hub"))
    pairs = spokes.select("cls", "hub").distinct()

    def verify(batches):
        import pyarrow as pa

        for batch in batches:
            a, b, sa, sb = (c.to_pylist() for c in batch.columns)
            ok = [aligned_similarity(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), similarity) > 0 for x, y in zip(sa, sb)]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(ok)], ["a", "b", "ok"])

    checked = written(pairs.join(seqs.select("cls", "seq"), "cls").join(
        seqs.select(F.col("cls").alias("hub"), F.col("seq").alias("hub_seq")), "hub").select("cls", "hub", "seq", "hub_seq")
        .mapInArrow(verify, "a binary, b binary, ok boolean"), "checked")

    # buckets with members that are not linked to their hub
    marked = spokes.join(checked.select(F.col("a").alias("cls"), F.col("b").alias("hub"), "ok"), ["cls", "hub"]).select("j", "bucket", "cls", "ok")
    stray = marked.filter("not ok").select("j", "bucket", "cls")
    stray = written(stray, "strays")
    counts = written(stray.groupBy("j", "bucket").agg(F.count("*").alias("strays")), "stray-counts")
    sides = counts.join(sizes, ["j", "bucket"]).withColumn("mn", F.ceil(F.col("n") / TILE)).withColumn(
        "sn", F.ceil(F.col("strays") / TILE)).filter("n > 2").drop("n", "strays")
    sides = written(sides, "tiles")
    open_ = members.join(sides, ["j", "bucket"])
    part = F.xxhash64("cls", "j")
    right = open_.withColumn("m", F.pmod(part, F.col("mn"))).withColumn("s", F.explode(F.sequence(F.lit(0).cast("long"), F.col("sn") - 1))).select(
        "j", "bucket", "m", "s", "cls", F.lit(False).alias("stray"))
    left = stray.join(sides, ["j", "bucket"]).withColumn("s", F.pmod(part, F.col("sn"))).withColumn(
        "m", F.explode(F.sequence(F.lit(0).cast("long"), F.col("mn") - 1))).select("j", "bucket", "m", "s", "cls", F.lit(True).alias("stray"))

    def tile(pdf):
        import pandas as pd

        strays, others = pdf[pdf["stray"]], pdf[~pdf["stray"]]
        if not len(strays) or not len(others):
            return pd.DataFrame({"a": [], "b": []})
        names = [bytes(x) for x in strays["cls"]] + [bytes(x) for x in others["cls"]]
        same = np.array([[x == y for y in names[len(strays):]] for x in names[:len(strays)]])
        found = tile_links([np.frombuffer(x, "<u8") for x in strays["seq"]], [np.frombuffer(x, "<u8") for x in others["seq"]], same, similarity)
        return pd.DataFrame({"a": [names[x] for x, _ in found], "b": [names[y] for _, y in found]})

    late = left.unionAll(right).join(seqs.select("cls", "seq"), "cls").groupBy("j", "bucket", "m", "s").applyInPandas(tile, "a binary, b binary")
    links = checked.filter("ok").select("a", "b").unionAll(late)
    label = components(links).select(F.col("node").alias("cls"), "label")
    named = texts.select("cls", "least").join(label, "cls", "left").withColumn("class_md5", F.coalesce("label", "cls"))
    ids = named.groupBy("class_md5").agg(F.min("least").alias("class_id"))
    naming = named.join(ids, "class_md5").select("cls", "class_id", "class_md5")
    return rows.select("doc_id", "cls").join(naming, "cls").select("doc_id", F.col("cls").alias("text_md5"), "class_id", "class_md5")


def first_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, one of each near-duplicate class: the one with the
    least id (of repeated rows one; null ids come last)."""
    found = near_duplicates(docs, key, text, **options)
    chosen = found.groupBy("class_md5").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_md5")).alias("k")).select(
        F.col("k.doc_id").alias("_id"), F.col("k.text_md5").alias("_cls"))
    # the whole row in one column, so that no name of its own can clash
    keyed = docs.select(F.struct("*").alias("_row"), F.col(key).cast("long").alias("_key"),
                        F.unhex(F.md5(text_of(docs, text).cast("binary"))).alias("_md5"))
    kept = keyed.join(chosen, (F.col("_md5") == F.col("_cls")) & F.col("_key").eqNullSafe(F.col("_id")))
    return kept.dropDuplicates(["_cls"]).select(*(F.col("_row").getField(c).alias(c) for c in docs.columns))
