"""Byte-level BPE with a pair occurrence index.

All distinct pre-tokens of a batch are laid out as one array of symbols with
next/previous links. The index maps each mergeable pair to all positions where
it occurs. Active ranks are taken in ascending order from a heap; one step
merges every occurrence of its pair and adds the pairs this creates to their
position lists. A merge only creates pairs of higher rank, so one ascending
pass gives each pre-token the result of merging it alone."""

from __future__ import annotations

import heapq
import json
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, text_of
from .tokens import byte_chunks

#: Distinct chunks kept from batch to batch; beyond, the next batch starts afresh.
KEPT_CHUNKS = 600_000
# The splitting rule of the byte-level files (fixed value of the format).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """Letter of the file -> byte: printable Latin-1 bytes stand for themselves,
    the others, in order, for the letters from U+0100 on."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PairIndexBpe:
    """Vocabulary, ranks and the merge pass of one tokenizer file."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in merges]
        letters = byte_letters()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.width = size
        self.first = np.zeros(256, dtype=np.int64)  # byte -> id
        for letter, b in letters.items():
            self.first[b] = vocab[letter]
        left = np.array([vocab[a] for a, _ in merges], dtype=np.int64)
        right = np.array([vocab[b] for _, b in merges], dtype=np.int64)
        self.made = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        self.left, self.right = left, right
        self.pair_order = np.argsort(left * size + right, kind="stable")
        self.pairs = (left * size + right)[self.pair_order]
        self.bytes_of = [b""] * size
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(letters[c] for c in token)
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.split = regex.compile(SPLIT)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.memo: dict[str, bytes] = {}

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where the file has no such merge."""
        key = a * self.width + b
        at = np.searchsorted(self.pairs, key)
        at[at == len(self.pairs)] = 0
        return np.where(self.pairs[at] == key, self.pair_order[at], -1)

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each (non-empty) pre-token."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        sym = self.first[np.frombuffer(b"".join(words), dtype=np.uint8)]
        n = len(sym)
        # position n stands for "no neighbour" and holds a symbol that pairs with nothing
        sym = np.append(sym, -1)
        nxt = np.arange(1, n + 2)
        prv = np.arange(-1, n)
        nxt[starts + lengths - 1] = n
        prv[starts] = n
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def add(positions: np.ndarray, ranks: np.ndarray) -> None:
            known = ranks >= 0
            positions, ranks = positions[known], ranks[known]
            if not len(ranks):
                return
            order = np.argsort(ranks, kind="stable")
            positions, ranks = positions[order], ranks[order]
            bounds = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            for r, part in zip(ranks[np.concatenate([[0], bounds])].tolist(), np.split(positions, bounds)):
                if r in index:
                    index[r].append(part)
                else:
                    index[r] = [part]
                    heapq.heappush(active, r)

        at = np.flatnonzero(nxt[:n] < n)
        add(at, self.ranks(sym[at], sym[at + 1]))
        while active:
            rank = heapq.heappop(active)
            lists = index.pop(rank)
            pos = lists[0] if len(lists) == 1 else np.concatenate(lists)
            a, b, new = self.left[rank], self.right[rank], self.made[rank]
            pos = pos[(sym[pos] == a) & (sym[nxt[pos]] == b)]
            if a == b and len(pos) > 1:
                # occurrences that overlap: of a run, every other one from the left
                pos = np.sort(pos)
                chained = np.concatenate([[False], nxt[pos[:-1]] == pos[1:]])
                i = np.arange(len(pos))
                run = np.maximum.accumulate(np.where(chained, 0, i))
                pos = pos[(i - run) % 2 == 0]
            if not len(pos):
                continue
            gone = nxt[pos]
            after = nxt[gone]
            sym[pos] = new
            sym[gone] = -1
            nxt[pos] = after
            prv[after] = pos
            before = prv[pos]
            before = before[(before < n)]
            before = before[sym[before] != new]  # those are in ``pos``, taken as left partners there
            pos = pos[nxt[pos] < n]
            left = np.concatenate([before, pos])
            if len(left):
                add(left, self.ranks(sym[left], sym[nxt[left]]))
        alive = sym[:n] >= 0
        kept = sym[:n][alive].astype("<u4")
        ends = np.cumsum(np.add.reduceat(alive.astype(np.int64), starts)) if len(words) else starts
        return np.split(kept, ends[:-1]) if len(words) else []

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian uint32 ids of each whole text."""
        memo, seen = self.memo, set()
        # cut twice rather than hold every chunk of the batch
        for t in texts:
            for p in self._segments(t)[::2]:
                seen.update(byte_chunks(p))
        fresh = [c for c in seen if c not in memo]
        if fresh:
            split = [self.split.findall(c) for c in fresh]
            words = list({w for ws in split for w in ws})
            ids = dict(zip(words, (x.tobytes() for x in self.merge([w.encode() for w in words]))))
            memo.update((c, b"".join(map(ids.__getitem__, ws))) for c, ws in zip(fresh, split))
        special = {s: np.array([i], dtype="<u4").tobytes() for s, i in self.special.items()}
        out = [b"".join([special[p] if i % 2 else b"".join(map(memo.__getitem__, byte_chunks(p)))
                         for i, p in enumerate(self._segments(t))]) for t in texts]
        if len(memo) > KEPT_CHUNKS:
            self.memo = {}
        return out

    def _segments(self, text: str) -> list[str]:
        """The text around special strings (even places) and those strings (odd ones)."""
        return self.cut.split(text) if self.cut else [text]

    def decode(self, ids: np.ndarray) -> str:
        """Text of the ids, special strings included; bytes that are not UTF-8
        become replacement characters."""
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def bpe(path: str) -> PairIndexBpe:
    """One per worker process and file, so the memo outlives a task."""
    return PairIndexBpe(path)


def encode_decode(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``ids`` (array of int) and ``decoded`` for every row.

    Null and empty texts have no ids and decode to the empty text. Null keys and
    repeated rows are encoded like any other; an empty table gives no rows;
    columns other than the two named are not read. A text is encoded whole,
    however long; a batch holds a bounded number of bytes besides."""
    prepare(docs.sparkSession)

    def run(batches):
        import pyarrow as pa

        coder = bpe(tokenizer_path)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            ids = [np.frombuffer(b, dtype="<u4") for b in coder.encode(texts)]
            for at in range(0, len(texts), 1_000):
                part = ids[at:at + 1_000]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in part])]).astype(np.int32)
                flat = np.concatenate(part).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(at, len(part)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                     pa.array([coder.decode(x) for x in part], pa.string())], ["doc_id", "ids", "decoded"])

    return docs.select(F.col(key).cast("long").alias("doc_id"), text_of(docs, text).alias("text")).mapInArrow(
        run, "doc_id long, ids array<int>, decoded string")
