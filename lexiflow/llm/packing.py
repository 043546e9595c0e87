"""Sum-of-squares online packing of token sequences.

Each document is encoded and ends with ``end_id``. Full windows are cut off its
front. The rest, shorter than a window, is placed online: among all fill levels
that have a partly filled window with room, and a new window, it goes to the
level that makes the sum of the squared counts of partly filled windows
smallest. The counts are a level array with one slot for each fill, so a choice
costs one pass over that array and memory does not grow with the documents.

A task packs its own partition. What is still open at its end is filled up by
cutting (at most the windows the level array holds); the last partly filled
window is cut into lengths that are powers of two, which need no padding."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, text_of

WINDOW = 1024
#: Sequence numbers: the task's partition in the high bits, a running number below.
SEQUENCE_BITS = 40

PIECES = ("doc_id long, start long, length long, doc_tokens long, "
          "sequence_id long, offset long, ids binary")


class LevelPacker:
    """Windows of one task. ``add`` yields finished windows; a window is a list
    of pieces (document key, start, ids as an array, tokens of the document)."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.count = np.zeros(2 * window + 1, dtype=np.int64)  # windows open at each fill
        self.open: list[list] = [[] for _ in range(window)]

    def choose(self, size: int) -> int:
        """The fill to place ``size`` at. Moving a window from h to h + size changes
        the sum of squares by 2 * (count[h + size] - count[h]) + 2; a completed
        window leaves the sum, a new one only enters it. Ties: the fullest."""
        w, c = self.window, self.count
        room = w - size
        change = 2 * (c[size:size + room + 1] - c[:room + 1]) + 2
        change[room] = 1 - 2 * c[room]
        change[1:][c[1:room + 1] == 0] = np.iinfo(np.int64).max
        change[0] = 2 * c[size] + 1
        return room - int(np.argmin(change[::-1]))

    def add(self, key, ids: np.ndarray) -> Iterator[list]:
        w, n = self.window, len(ids)
        for at in range(0, n - n % w, w):
            yield [(key, at, ids[at:at + w], n)]
        size = n % w
        if not size:
            return
        level = self.choose(size)
        pieces = self.open[level].pop() if level else []
        pieces.append((key, n - size, ids[n - size:], n))
        if level:
            self.count[level] -= 1
        level += size
        if level == w:
            yield pieces
        else:
            self.count[level] += 1
            self.open[level].append(pieces)

    def finish(self) -> Iterator[list]:
        """Fill up what is open, fullest first, by cutting; then powers of two."""
        w, now, fill = self.window, [], 0
        for pieces in (p for level in reversed(self.open) for p in level):
            for key, start, ids, n in pieces:
                while len(ids):
                    part, ids = ids[:w - fill], ids[w - fill:]
                    now.append((key, start, part, n))
                    start, fill = start + len(part), fill + len(part)
                    if fill == w:
                        yield now
                        now, fill = [], 0
        while fill:
            size, out, got = 1 << (fill.bit_length() - 1), [], 0
            while got < size:
                key, start, ids, n = now.pop(0)
                part = ids[:size - got]
                out.append((key, start, part, n))
                got += len(part)
                if len(part) < len(ids):
                    now.insert(0, (key, start + len(part), ids[len(part):], n))
            yield out
            fill -= size


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 0, window: int = WINDOW,
         key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: ``doc_id``, ``start`` and ``length`` in its document,
    ``doc_tokens``, the window ``sequence_id`` and the ``offset`` there, and the
    piece's ``ids`` (little-endian uint32).

    Null and empty texts are one end id. Null keys and repeated rows are packed
    like any other row. Texts longer than a window span several. An empty table
    gives no rows; columns other than the two named are not read."""
    prepare(docs.sparkSession)

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        from .tokens import encoder

        enc = encoder(tokenizer_path, "byte")
        packer = LevelPacker(window)
        number = TaskContext.get().partitionId() << SEQUENCE_BITS
        end = np.array([end_id], dtype="<u4").tobytes()
        names = [c.split()[0] for c in PIECES.split(", ")]

        def rows(windows):
            nonlocal number
            cols = [[] for _ in names]
            for pieces in windows:
                at = 0
                for k, start, ids, n in pieces:
                    for c, v in zip(cols, (k, start, len(ids), n, number, at, ids.tobytes())):
                        c.append(v)
                    at += len(ids)
                number += 1
            if cols[0]:
                kinds = [pa.int64()] * 6 + [pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

        for batch in batches:
            keys, texts = (batch.column(i).to_pylist() for i in (0, 1))
            for at in range(0, len(keys), 2_000):
                ids = enc.encode(texts[at:at + 2_000])
                yield from rows(w for k, b in zip(keys[at:at + 2_000], ids)
                                for w in packer.add(k, np.frombuffer(b + end, dtype="<u4")))
        yield from rows(packer.finish())

    return docs.select(F.col(key).cast("long").alias("doc_id"), text_of(docs, text).alias("text")).mapInArrow(run, PIECES)
