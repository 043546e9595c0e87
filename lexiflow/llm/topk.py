"""Exact top-k by tiled matrix products.

Candidates are packed into shards of ``shard_rows`` vectors and queries into
blocks of ``block_rows``. Every block meets every shard once, as one tile: a
matrix product in a task, which keeps the k best of each query. The lists of a
block are then merged in a tree, ``fan_in`` lists at a time, so no task holds
more than that many. Components are floor(256 * x), so products are exact."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare, written

SCALE = 256
SHARD_ROWS = 4096
BLOCK_ROWS = 1024
FAN_IN = 32
#: Beyond this sum of absolute products a float64 product could round; exact integers then.
EXACT = 2.0**53

PACKED = "slot long, dim int, ids binary, vectors binary"
LISTS = "block long, node long, ids binary, top_ids binary, top_scores binary"


def usable(vector: Column) -> Column:
    """Neither null nor holding null or non-finite components, nor empty."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad


def _packed(rows: DataFrame, per_row: int) -> DataFrame:
    """Rows (``vec_id``, ``v``) as matrices of up to ``per_row`` vectors of one length."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, made, held = TaskContext.get().partitionId(), 0, {}

        def close(dim):
            nonlocal made
            ids, vectors = held.pop(dim)
            made += 1
            return pa.RecordBatch.from_pydict(
                {"slot": pa.array([(part << 32) + made], pa.int64()), "dim": pa.array([dim], pa.int32()),
                 "ids": [np.array(ids, "<i8").tobytes()], "vectors": [np.concatenate(vectors).astype("<i8").tobytes()]})

        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                q = np.floor(SCALE * v.values.to_numpy(zero_copy_only=False).astype(np.float64))
                if np.abs(q).max() >= 2.0**31:
                    raise ValueError(f"vector {i}: a component is too large for 64-bit scores")
                ids, vectors = held.setdefault(len(q), ([], []))
                ids.append(i)
                vectors.append(q)
                if len(ids) == per_row:
                    yield close(len(q))
        for dim in list(held):
            yield close(dim)

    return rows.mapInArrow(run, PACKED)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer a @ b.T."""
    most = np.abs(a).max(initial=0).astype(float) * np.abs(b).max(initial=0).astype(float) * a.shape[1]
    if most < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most >= 2.0**62:
        raise ValueError("components too large for 64-bit scores")
    return a @ b.T


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best columns of each row: higher scores, then smaller ids. A row's
    unused places have the least score. ``ids`` is one row, or one for each row."""
    least = np.iinfo(np.int64).min
    ids = np.broadcast_to(ids, scores.shape)
    falling = -np.maximum(scores, least + 1)
    if scores.shape[1] > 4 * k:
        # everything that reaches the k-th best score, ties included
        kth = np.partition(falling, k - 1, axis=1)[:, k - 1]
        most = int((falling <= kth[:, None]).sum(axis=1).max())
        if most <= scores.shape[1] // 2:
            at = np.argpartition(falling, most - 1, axis=1)[:, :most]
            ids, scores, falling = (np.take_along_axis(x, at, 1) for x in (ids, scores, falling))
    order = np.lexsort((ids, falling), axis=1)[:, :k]
    ids, scores = np.take_along_axis(ids, order, 1), np.take_along_axis(scores, order, 1)
    if scores.shape[1] < k:
        pad = ((0, 0), (0, k - scores.shape[1]))
        ids, scores = np.pad(ids, pad), np.pad(scores, pad, constant_values=least)
    return ids, scores


def meetings(shards: DataFrame, blocks: DataFrame, groups: int) -> DataFrame:
    """Every block beside every shard of its length. Shards are dealt to ``groups`` (as many
    as there are shards); each block is sent once to each group, and meets the shards dealt
    to it. A group is a few tiles, whatever the data. The copies of the blocks grow with the
    square of the table, but Spark takes them for as large as the written blocks and would
    broadcast them through the driver, so both sides are shuffled."""
    dealt = shards.withColumn("group", F.pmod(F.xxhash64("slot"), F.lit(groups)))
    sent = blocks.withColumnsRenamed({"slot": "block", "dim": "bdim", "ids": "bids", "vectors": "bvectors"}).withColumn(
        "group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    met = sent.hint("merge").join(dealt.hint("merge"), (sent["group"] == dealt["group"]) & (sent["bdim"] == dealt["dim"]))
    return met.select("block", "slot", "dim", "bids", "bvectors", "ids", "vectors")


def top_k(vectors: DataFrame, k: int = 5, is_query: Column | None = None, id_col: str = "vec_id",
          vector_col: str = "embedding", shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS,
          fan_in: int = FAN_IN) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` of the k best rows of
    each query row, ties to the smaller id; fewer where there are fewer.

    Rows with the query's id are its own and no candidates. Vectors that are null
    or empty or hold null or non-finite components take no part, nor do rows with
    a null id; vectors of other lengths than the query's are no candidates. A
    repeated candidate row counts each time, a repeated query row is answered
    each time. An empty table gives no rows; other columns are not read."""
    spark = prepare(vectors.sparkSession)
    is_query = F.col(id_col) % 50 == 0 if is_query is None else is_query
    rows = vectors.filter(F.col(id_col).isNotNull() & usable(F.col(vector_col)))
    pair = [F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")]
    shards = written(_packed(rows.select(*pair), shard_rows), "topk-shards")
    blocks = written(_packed(rows.filter(is_query).select(*pair).repartition(
        F.pmod(F.xxhash64("vec_id"), F.lit(max(1, rows.filter(is_query).count() // block_rows)))), block_rows), "topk-blocks")
    n_shards = shards.count()
    tiles = meetings(shards, blocks, max(1, n_shards))

    def lists(rows):
        import pyarrow as pa

        kinds = {"block": pa.int64(), "node": pa.int64()}
        return pa.RecordBatch.from_pydict({n.split()[0]: pa.array([r[i] for r in rows], kinds.get(n.split()[0], pa.binary()))
                                           for i, n in enumerate(LISTS.split(", "))})

    def tile(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                block, slot, dim, bids, bvec, ids, vec = (c[i].as_py() for c in batch.columns)
                q, own = np.frombuffer(bvec, "<i8").reshape(-1, dim), np.frombuffer(bids, "<i8")
                c, cand = np.frombuffer(vec, "<i8").reshape(-1, dim), np.frombuffer(ids, "<i8")
                scores = products(q, c)
                scores[own[:, None] == cand[None, :]] = np.iinfo(np.int64).min
                top_ids, top = best(cand[None, :], scores, k)
                yield lists([(block, slot, bids, top_ids.astype("<i8").tobytes(), top.astype("<i8").tobytes())])

    level = written(tiles.mapInArrow(tile, LISTS), "topk-lists")

    def merge(pdf):
        import pandas as pd

        n = len(pdf["ids"].iloc[0]) // 8
        ids = np.concatenate([np.frombuffer(x, "<i8").reshape(n, k) for x in pdf["top_ids"]], axis=1)
        scores = np.concatenate([np.frombuffer(x, "<i8").reshape(n, k) for x in pdf["top_scores"]], axis=1)
        ids, scores = best(ids, scores, k)
        return pd.DataFrame({"block": [pdf["block"].iloc[0]], "node": [pdf["parent"].iloc[0]], "ids": [pdf["ids"].iloc[0]],
                             "top_ids": [ids.astype("<i8").tobytes()], "top_scores": [scores.astype("<i8").tobytes()]})

    width = n_shards
    while width > 1:
        width = -(-width // fan_in)
        level = level.withColumn("parent", F.pmod(F.xxhash64("node"), F.lit(width))).groupBy("block", "parent").applyInPandas(merge, LISTS)

    def rows_of(batches):
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                own = np.frombuffer(row["ids"], "<i8")
                ids = np.frombuffer(row["top_ids"], "<i8").reshape(-1, k)
                scores = np.frombuffer(row["top_scores"], "<i8").reshape(-1, k)
                used = scores != np.iinfo(np.int64).min
                yield pa.RecordBatch.from_pydict(
                    {"query_id": np.broadcast_to(own[:, None], ids.shape)[used],
                     "rank": np.broadcast_to(np.arange(1, k + 1, dtype=np.int32), ids.shape)[used],
                     "vec_id": ids[used], "score": scores[used]})

    return level.mapInArrow(rows_of, "query_id long, rank int, vec_id long, score long")
