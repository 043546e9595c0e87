"""Token-id shards with a minimal perfect hash index.

File format: a Parquet folder (any store Spark can write, with Spark's commit
protocol, so a lost or repeated task leaves no half-written shard) with one row
per shard. ``payload`` is the raw little-endian id stream of the shard's
documents, 2 bytes an id where the vocabulary allows, else 4. The documents of
all shards, ordered by (``part``, ``seq``), are in ascending key order.

The index of a shard maps a document key to its place without storing keys for
the search: a cascade of bit arrays in which each key owns one bit (a key whose
bit another key also hits moves to the next array), the rank of that bit is the
slot, and the slot holds a 32-bit fingerprint of the key, the first document
with that key and how many there are. A lookup touches a bounded expected number
of words whatever the shard's size; a key that is not in the shard fails at the
bits or, but for one in 2**32, at the fingerprint."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prepare, text_of

#: Ids after which a shard is closed; a longer document makes a longer shard.
SHARD_IDS = 1 << 20
SHARD = ("part int, seq int, first_key long, last_key long, n_null long, n_docs long, n_ids long, part_start long, "
         "width int, payload binary, offsets binary, level_sizes binary, bits binary, ranks binary, "
         "fingerprints binary, firsts binary, counts binary, keys binary")


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit finaliser (xor-shift and multiply) of keys and a seed."""
    x = keys.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Distinct 64-bit keys to the slots 0 .. n-1."""

    GAMMA = 2
    FINGERPRINT_SEED = 1 << 20

    def __init__(self, sizes: np.ndarray, words: np.ndarray, ranks: np.ndarray):
        self.sizes, self.words, self.ranks = sizes, words, ranks

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, arrays, level = [], [], 0
        while len(keys):
            size = -(-max(cls.GAMMA * len(keys), 64) // 64) * 64
            at = (mix(keys, level) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            arrays.append(alone)
            keys, level = keys[~alone[at]], level + 1
        bits = np.concatenate(arrays) if arrays else np.zeros(0, dtype=bool)
        words = np.packbits(bits, bitorder="little").view("<u8") if len(bits) else np.zeros(0, "<u8")
        per_word = bits.reshape(-1, 64).sum(axis=1) if len(bits) else np.zeros(0, np.int64)
        ranks = np.concatenate([[0], np.cumsum(per_word)[:-1]]) if len(bits) else per_word
        return cls(np.array(sizes, dtype="<u4"), words, ranks.astype("<u4"))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 where no bit is set for it."""
        out = np.full(len(keys), -1, dtype=np.int64)
        open_, base = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes.tolist()):
            at = (mix(keys[open_], level) % np.uint64(size)).astype(np.int64) + base
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = word & ((np.uint64(1) << bit) - np.uint64(1))
            out[open_[hit]] = self.ranks[at[hit] >> 6] + np.bitwise_count(below[hit])
            open_, base = open_[~hit], base + size
        return out

    @classmethod
    def fingerprints(cls, keys: np.ndarray) -> np.ndarray:
        return (mix(keys, cls.FINGERPRINT_SEED) >> np.uint64(32)).astype("<u4")


def shard_row(keys: list, ids: list[bytes], width: int) -> dict:
    """One shard of documents in ascending key order, null keys first."""
    nulls = sum(k is None for k in keys)
    real = np.array(keys[nulls:], dtype="<i8")
    unique, firsts, counts = np.unique(real, return_index=True, return_counts=True)
    table = PerfectHash.build(unique.view(np.uint64))
    slots = table.slots(unique.view(np.uint64))
    by_slot = np.argsort(slots)
    lengths = np.array([len(b) // 4 for b in ids], dtype=np.int64)
    flat = np.frombuffer(b"".join(ids), dtype="<u4")
    return {"first_key": int(real[0]) if len(real) else None, "last_key": int(real[-1]) if len(real) else None,
            "n_null": nulls, "n_docs": len(ids), "n_ids": len(flat), "width": width,
            "payload": flat.astype(f"<u{width}").tobytes(),
            "offsets": np.concatenate([[0], np.cumsum(lengths)]).astype("<i8").tobytes(),
            "level_sizes": table.sizes.tobytes(), "bits": table.words.tobytes(), "ranks": table.ranks.tobytes(),
            "fingerprints": PerfectHash.fingerprints(unique.view(np.uint64))[by_slot].tobytes(),
            "firsts": (firsts + nulls)[by_slot].astype("<u4").tobytes(),
            "counts": counts[by_slot].astype("<u4").tobytes(), "keys": unique.tobytes()}


class Shard:
    """A shard row, opened for keyed access."""

    def __init__(self, row: dict):
        self.row = row
        self.offsets = np.frombuffer(row["offsets"], "<i8")
        self.table = PerfectHash(np.frombuffer(row["level_sizes"], "<u4"), np.frombuffer(row["bits"], "<u8"),
                                 np.frombuffer(row["ranks"], "<u4"))
        self.fingerprints, self.firsts, self.counts = (np.frombuffer(row[c], "<u4") for c in ("fingerprints", "firsts", "counts"))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First document and number of documents of each key; 0 documents: not here."""
        raw = keys.astype("<i8").view(np.uint64)
        slots = self.table.slots(raw)
        n = np.zeros(len(keys), dtype=np.int64)
        first = np.zeros(len(keys), dtype=np.int64)
        if len(self.fingerprints):
            here = (slots >= 0) & (self.fingerprints[slots] == PerfectHash.fingerprints(raw))
            n[here], first[here] = self.counts[slots[here]], self.firsts[slots[here]]
        return first, n

    def ids(self, doc: int) -> bytes:
        w = self.row["width"]
        raw = self.row["payload"][self.offsets[doc] * w:self.offsets[doc + 1] * w]
        return raw if w == 4 else np.frombuffer(raw, f"<u{w}").astype("<u4").tobytes()


def write_shards(docs: DataFrame, path: str, tokenizer_path: str, kind: str = "word", end_id: int = 1,
                 key: str = "doc_id", text: str = "text") -> None:
    """Encode every row's whole text, append ``end_id`` and write shards.

    Null and empty texts are one end id. Null keys come first and have no index
    entry; rows with the same key are neighbours in the order they are read, and
    the index gives all of them. An empty table gives an empty folder; columns
    other than the two named are not read. The range partitioning breaks ties by
    row, so a key that many rows share is still split over tasks."""
    prepare(docs.sparkSession)

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        from .tokens import encoder

        enc = encoder(tokenizer_path, kind)
        end = np.array([end_id], dtype="<u4").tobytes()
        width = 2 if max(enc.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        keys, ids, size = [], [], 0

        def close():
            nonlocal keys, ids, size, seq, before
            row = {"part": part, "seq": seq, "part_start": before} | shard_row(keys, ids, width)
            seq, before = seq + 1, before + row["n_ids"]
            keys, ids, size = [], [], 0
            return pa.RecordBatch.from_pylist([row], schema=schema)

        schema = pa.schema([(n, {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}[t])
                            for n, t in (c.split() for c in SHARD.split(", "))])
        for batch in batches:
            ks, ts = (batch.column(i).to_pylist() for i in (0, 1))
            for at in range(0, len(ks), 2_000):
                for k, b in zip(ks[at:at + 2_000], enc.encode(ts[at:at + 2_000])):
                    keys.append(k)
                    ids.append(b + end)
                    size += len(b) // 4 + 1
                    if size >= SHARD_IDS:
                        yield close()
        if keys:
            yield close()

    (docs.select(F.col(key).cast("long").alias("doc_id"), text_of(docs, text).alias("text"),
                 F.monotonically_increasing_id().alias("row"))
     .repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row")
     .select("doc_id", "text").mapInArrow(run, SHARD)
     .write.option("compression", "zstd").parquet(path))


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """Every document of the shards, found by its key through the index:
    ``doc_id``, ``start`` (ids of all documents before it) and its ``ids`` bytes
    (uint32). Documents without a key are read by position."""
    prepare(spark)
    shards = spark.read.schema(SHARD).parquet(path)
    # two numbers for each task that wrote: the ids of all tasks before it
    sizes = sorted(shards.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    starts, total = {}, 0
    for part, n in sizes:
        starts[part], total = total, total + n

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row)
                base = starts[row["part"]] + row["part_start"]
                keys = np.frombuffer(row["keys"], "<i8")
                firsts, counts = shard.find(keys)
                if (counts == 0).any():
                    raise ValueError(f"index of shard {row['part']}/{row['seq']} misses a key")
                docs = [(None, d) for d in range(row["n_null"])]
                docs += [(k, d) for k, f, c in zip(keys.tolist(), firsts.tolist(), counts.tolist()) for d in range(f, f + c)]
                for at in range(0, len(docs), 2_000):
                    some = docs[at:at + 2_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k for k, _ in some], pa.int64()),
                         pa.array([base + int(shard.offsets[d]) for _, d in some], pa.int64()),
                         pa.array([shard.ids(d) for _, d in some], pa.binary())], ["doc_id", "start", "ids"])

    return shards.mapInArrow(run, "doc_id long, start long, ids binary")


def lookup(spark: SparkSession, path: str, keys: list[int]) -> DataFrame:
    """``doc_id`` and ``ids`` of the documents with the given keys (a short list).
    Only shards whose key range holds one of them are read."""
    prepare(spark)
    keys = sorted(set(keys))
    shards = spark.read.schema(SHARD).parquet(path)
    if keys:
        hit = [F.lit(k).between(F.col("first_key"), F.col("last_key")) for k in keys]
        cond = hit[0]
        for h in hit[1:]:
            cond = cond | h
    else:
        cond = F.lit(False)

    def run(batches):
        import pyarrow as pa

        wanted = np.array(keys, dtype="<i8")
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row)
                found = [(k, shard.ids(d)) for k, f, c in zip(keys, *shard.find(wanted)) for d in range(f, f + c)]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.int64()),
                                                      pa.array([b for _, b in found], pa.binary())], ["doc_id", "ids"])

    return shards.filter(cond).mapInArrow(run, "doc_id long, ids binary")
