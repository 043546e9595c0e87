"""Near duplicates by SimHash, found with BK-trees.

A fingerprint has a bit where over half of the hashes of a text's four-word shingles
have it. Two texts are linked when their fingerprints differ in at most ``RADIUS``
bits; a component is what links reach.

Fingerprints, each once, are dealt to shards: two within the radius agree in at least
one of ``RADIUS + 1`` blocks of bits, so a shard is a value of a block's leading bits,
and as many bits are taken as leave about ``TREE`` fingerprints in a shard. Every
shard has a BK-tree: a node's children are keyed by their Hamming distance to it.
A shard with more fingerprints is cut by hash into trees of that size. Each tree is
sent to every block of queries of its shard, and a query follows only edges within
the radius of its distance to the node. Trees are copied from task to task in a
shuffle, not through the driver, for together they hold the fingerprints of all
documents. What a search gives back is a spanning forest of its links, so a dense
group costs a row per fingerprint, not one per pair."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, written
from .neardup import components

WORDS = 4
SEED = 42
RADIUS = 4
#: Fingerprints of one tree, on average.
TREE = 1024
#: (query, node) pairs held at a time by a search.
FRONTIER = 1 << 20
#: Shingles whose bits are summed at a time.
CHUNK = 1 << 16

_LOWER = bytes(range(ord("A"))) + bytes(range(ord("a"), ord("z") + 1)) + bytes(range(ord("Z") + 1, 256))


def fingerprint(text: bytes) -> int:
    """Unsigned 64 bits. A text of fewer than four words is one shingle, one without
    words has fingerprint zero. Only A-Z is lower-cased; repeated shingles count."""
    from xxhash import xxh64_intdigest

    words = text.translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    end = np.cumsum(size + 1) - 1
    n = max(len(words) - WORDS + 1, 1)
    starts, ends = (end - size)[:n].tolist(), end[-n:].tolist()
    bits = np.zeros(64, dtype=np.int64)
    for at in range(0, n, CHUNK):
        h = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[at:at + CHUNK], ends[at:at + CHUNK])], dtype="<u8")
        bits += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * bits > n).tolist()))


def bk_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``points`` (distinct, unsigned 64 bits) in breadth-first order, the place of
    each one's parent and its distance to it (the root: -1 and 0), children of a node
    next to each other by ascending distance.

    The tree is that of inserting the points one by one: of those that fall on one
    edge of a node the first becomes the child, the others go on below it. All edges
    of a level are settled at once."""
    nodes, parents, edges = [points[:1]], [np.array([-1])], [np.array([0])]
    rest, under = points[1:], np.zeros(max(len(points) - 1, 0), dtype=np.int64)
    at, base = points[:1], 0
    while len(rest):
        distance = np.bitwise_count(rest ^ at[under - base]).astype(np.int64)
        edge = under * 128 + distance
        order = np.argsort(edge, kind="stable")
        rest, edge = rest[order], edge[order]
        new = np.concatenate([[True], edge[1:] != edge[:-1]])
        base += len(at)
        child = base + np.cumsum(new) - 1
        at = rest[new]
        nodes.append(at)
        parents.append(edge[new] // 128)
        edges.append(edge[new] % 128)
        rest, under = rest[~new], child[~new]
    return np.concatenate(nodes), np.concatenate(parents), np.concatenate(edges)


class Searcher:
    """Queries against one tree."""

    def __init__(self, nodes: np.ndarray, parents: np.ndarray, edges: np.ndarray, radius: int = RADIUS):
        self.nodes, self.radius = nodes, radius
        # children of node i on edges lo .. hi: places first[i, lo] up to first[i, hi + 1]
        keys = parents * 128 + edges
        inner = np.unique(parents[1:])
        self.row = np.full(len(nodes), -1, dtype=np.int64)
        self.row[inner] = np.arange(len(inner))
        self.first = np.searchsorted(keys[1:], (inner[:, None] * 128 + np.arange(66)).ravel()).reshape(-1, 66) + 1

    def links(self, queries: np.ndarray):
        """Arrays (query place, node place) of all pairs within the radius."""
        open_ = [(np.arange(len(queries)), np.zeros(len(queries), dtype=np.int64))]
        while open_:
            q, node = open_.pop()
            distance = np.bitwise_count(queries[q] ^ self.nodes[node]).astype(np.int64)
            hit = distance <= self.radius
            if hit.any():
                yield q[hit], node[hit]
            row = self.row[node]
            inner = row >= 0
            q, row, distance = q[inner], row[inner], distance[inner]
            start = self.first[row, np.maximum(distance - self.radius, 0)]
            count = self.first[row, np.minimum(distance + self.radius, 64) + 1] - start
            total = np.cumsum(count)
            low = 0
            while low < len(q):  # cut, so that the pairs held stay bounded
                done = total[low - 1] if low else 0
                high = max(int(np.searchsorted(total, done + FRONTIER, "right")), low + 1)
                n = count[low:high]
                size = int(n.sum())
                if size:
                    offset = np.arange(size) - np.repeat(np.cumsum(n) - n, n)
                    open_.append((np.repeat(q[low:high], n), np.repeat(start[low:high], n) + offset))
                low = high


class Forest:
    """Joins points that links connect; gives one link to each point but the first of
    a group."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.label[a], self.label[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.label, np.maximum(x, y), np.minimum(x, y))
            while True:
                deeper = self.label[self.label]
                if (deeper == self.label).all():
                    break
                self.label = deeper

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        child = np.flatnonzero(self.label != np.arange(len(self.label)))
        return child, self.label[child]


def forest(searcher: Searcher, queries: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest, as pairs of fingerprints, of the links between the queries and
    the tree's nodes. ``same``: the queries are the nodes."""
    nodes = searcher.nodes
    shift = 0 if same else len(queries)
    both = nodes if same else np.concatenate([queries, nodes])
    found = Forest(len(both))
    for q, node in searcher.links(queries):
        found.join(q, node + shift)
    a, b = found.links()
    return both[a], both[b]


def _signed(values: np.ndarray):
    import pyarrow as pa

    return pa.array(values.view(np.int64), pa.int64())


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``point`` (the fingerprint as a signed long) of every row; a null
    text counts as empty."""
    prepare(docs.sparkSession)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            points = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), _signed(points)], ["doc_id", "point"])

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text")).mapInArrow(
        run, "doc_id long, point long")


def near_links(points: DataFrame, radius: int = RADIUS, tree: int = TREE) -> DataFrame:
    """Links ``a``, ``b`` (longs) whose components are those of all pairs of ``points``
    (``point``, distinct) within ``radius`` bits. Points without such a pair are in none."""
    blocks = radius + 1
    total = points.count()
    # leading bits of a block that leave about ``tree`` points in a shard
    low = [round(64 * j / blocks) for j in range(blocks + 1)]
    bits = min(max(math.ceil(math.log2(max(total, 1) / tree)), 0), min(b - a for a, b in zip(low, low[1:])))
    values = [F.shiftrightunsigned("point", low[j]).bitwiseAND((1 << bits) - 1) for j in range(blocks)]
    spots = points.select("point", F.posexplode(F.array(*values)).alias("block", "value"))
    sizes = written(spots.groupBy("block", "value").agg(F.ceil(F.count("*") / tree).alias("cuts")), "shard-sizes")
    dealt = spots.join(sizes, ["block", "value"]).withColumn("cut", F.pmod(F.xxhash64("point", "block"), "cuts"))
    # one row a tree: its size is bounded by the cuts
    lists = dealt.groupBy("block", "value", "cut").agg(F.first("cuts").alias("cuts"), F.collect_list("point").alias("points")).filter(
        (F.size("points") > 1) | (F.col("cuts") > 1))

    def grow(batches):
        import pyarrow as pa

        for batch in batches:
            built = [bk_tree(np.array(p, dtype=np.int64).view(np.uint64)) for p in batch.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array([n.astype("<u8").tobytes() for n, _, _ in built], pa.binary()),
                 pa.array([p.astype("<i4").tobytes() for _, p, _ in built], pa.binary()),
                 pa.array([e.astype("u1").tobytes() for _, _, e in built], pa.binary())],
                ["block", "value", "cut", "cuts", "nodes", "parents", "edges"])

    trees = written(lists.select("block", "value", "cut", "cuts", "points").mapInArrow(
        grow, "block int, value long, cut long, cuts long, nodes binary, parents binary, edges binary"), "bk-trees", compression="zstd")

    def search(batches):
        import pyarrow as pa

        for batch in batches:
            for nodes, parents, edges, queries in zip(*(c.to_pylist() for c in batch.columns)):
                searcher = Searcher(np.frombuffer(nodes, "<u8"), np.frombuffer(parents, "<i4").astype(np.int64),
                                    np.frombuffer(edges, "u1").astype(np.int64), radius)
                a, b = forest(searcher, searcher.nodes if queries is None else np.frombuffer(queries, "<u8"), queries is None)
                if len(a):
                    yield pa.RecordBatch.from_arrays([_signed(a), _signed(b)], ["a", "b"])

    parts = ["nodes", "parents", "edges"]
    own = trees.select(*parts, F.lit(None).cast("binary").alias("queries"))
    # a cut shard: each tree goes to the queries of every later cut, each pair of cuts a key of its own
    many = trees.filter("cuts > 1")
    sent = many.filter("cut + 1 < cuts").select("block", "value", "cut", F.explode(F.sequence(F.col("cut") + 1, F.col("cuts") - 1)).alias("to"), *parts)
    asked = many.filter("cut > 0").select("block", "value", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cut") - 1)).alias("cut"),
                                          F.col("cut").alias("to"), F.col("nodes").alias("queries"))
    across = sent.join(asked, ["block", "value", "cut", "to"]).select(*parts, "queries")
    return own.mapInArrow(search, "a long, b long").unionAll(across.mapInArrow(search, "a long, b long"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """``doc_id``, ``point`` (fingerprint as a signed long) and ``component_id`` (the least
    id reachable) for every row.

    Null ids take part, but name no component: one of null ids only has a null id.
    Repeated rows each get a row. Texts without words share fingerprint zero and are
    linked like any other. An empty table gives no rows; other columns are not read."""
    rows = written(fingerprints(docs, key, text), "fingerprints", compression="zstd")
    points = written(rows.groupBy("point").agg(F.min("doc_id").alias("least")), "points", compression="zstd")
    links = written(near_links(points.select("point"), radius), "links", compression="zstd")
    labels = components(links).withColumnRenamed("node", "point")
    named = points.join(labels, "point", "left").withColumn("label", F.coalesce("label", "point"))
    named = written(named, "named", compression="zstd")
    least = written(named.groupBy("label").agg(F.min("least").alias("component_id")), "component-ids", compression="zstd")
    ids = written(named.join(least, "label").select("point", "component_id"), "point-components", compression="zstd")
    return rows.join(ids, "point").select("doc_id", "point", "component_id")
