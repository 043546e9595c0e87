"""Merkle manifest of a dataset: node rows linked to their parents, proofs by a
recursive query.

Every row is a leaf: the sha256 of its columns, each ``-`` if null, else its UTF-8
byte count, ``:`` and its value. The leaves of a part ascend by key; 16 at a time
become the digest of their hex digests in order, level by level, until one node is
left, the part's root. The parts' roots, in order of the parts (null first, then
bytewise), are joined likewise to the root of all.

``build`` writes the nodes. Leaves lie in the table of lowest runs, one row each, at
most 16 leaves; every node above is a row with its place in the tree, its children's
digests and its parent's place. Positions come from a range partitioning, local
running numbers and the sum of the counts of earlier partitions, so a part that
holds a third of all rows is numbered by many tasks.

``prove`` climbs with a recursive query from every lowest run. All leaves of a run
have the same siblings above it, so one row carries their folded digests side by
side and the siblings met so far once. Each step joins the row to its parent, appends
the siblings and folds every leaf's digest with them. The climb ends at the node
without a parent. Rows meet at ever fewer nodes on their way, so a node stands in as
many copies as its runs need to be dealt out ``SHARE`` at a time: no join has a hot key,
and the copies are fewer than the nodes of the level that has ``SHARE`` runs each."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, written

RUN = 16
SHARE = 256  # lowest runs that meet one copy of a node
HEX = 64  # characters of a digest
TOP = -1  # number of the tree over the parts' roots; a part's tree has the part's number
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass
class Manifest:
    """``runs``: ``tree``, ``idx``, ``leaves`` (array of doc_id, leaf, forged, in order;
    binary digests, ``forged`` null where it is the leaf), ``lone`` (the only leaf of its part, which has no node above it in its tree) and
    the link of their common node (``up_tree``, ``up_level``, ``up_idx``, ``place``; a null
    link is the root's). ``nodes``: inner nodes with ``tree``, ``level``, ``idx``,
    ``kids`` (hex digests in order), ``hash``, ``split`` (its copies in the climb), the
    same link and ``up_split`` of the parent. ``parts``: ``tree``,
    ``part``, ``n``, ``subroot``. ``root``: hex digest, None of an empty table."""

    runs: DataFrame
    nodes: DataFrame
    parts: DataFrame
    root: str | None


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(values: list[Column]) -> Column:
    return F.unhex(digest(F.concat(*map(field, values))))


def shown(value: Column) -> Column:
    return F.lower(F.hex(value))


def _kids(leaves: str) -> Column:
    return F.array_join(F.transform(F.col(leaves), lambda x: shown(x["leaf"])), "")


def numbered(df: DataFrame, group: str | None, *order: str) -> DataFrame:
    """``df`` with ``pos``, the place of a row in its group (from 0) by ``order``."""
    group = group or "_all"
    if group == "_all":
        df = df.withColumn("_all", F.lit(0))
    laid = written(df.repartitionByRange(group, *order).sortWithinPartitions(group, *order).withColumn(
        "_at", F.monotonically_increasing_id()), "laid-out", compression="zstd").withColumn("_slice", F.shiftright("_at", 33))
    sizes = laid.groupBy("_slice", group).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    # one row per partition and group: a group has at most as many rows here as there are partitions
    earlier = Window.partitionBy(group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shift = written(sizes.select("_slice", group, (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift")), "shifts")
    return laid.join(shift, ["_slice", group]).withColumn("pos", F.col("_at") + F.col("_shift")).drop("_slice", "_at", "_shift", "_all")


def _link(tree: Column, level: int, idx: Column, alone: Column, parts: int) -> list[Column]:
    """Parent's place of a node: in its own tree, or for a part's root in the top
    tree, or null for the root."""
    top = (F.lit(None) if parts <= 1 else F.when(tree != TOP, F.lit(TOP))).cast("long")
    place = F.when(alone, F.when(top.isNotNull(), tree)).otherwise(idx)
    return [F.when(alone, top).otherwise(tree).alias("up_tree"),
            F.when(alone, F.when(top.isNotNull(), F.lit(1))).otherwise(F.lit(level + 1)).alias("up_level"),
            F.floor(place / RUN).cast("long").alias("up_idx"), (place % RUN).cast("int").alias("place")]


def _grow(nodes: DataFrame, start: int, longest: int, parts: int) -> tuple[list[DataFrame], DataFrame]:
    """Levels above ``nodes`` (``tree``, ``idx``, ``hash``, ``size``: runs below, ``n``: nodes of
    the tree at this level), each written, and the one node that is left of each tree."""
    built, tops, level, n = [], [nodes.filter("n = 1")], start, longest
    while n > 1:
        level, n = level + 1, -(-n // RUN)
        runs = nodes.filter("n > 1").groupBy("tree", F.floor(F.col("idx") / RUN).cast("long").alias("up")).agg(
            F.sort_array(F.collect_list(F.struct("idx", "hash"))).alias("kids"), F.first("n").alias("below"), F.sum("size").alias("size"))
        runs = runs.select("tree", F.lit(level).alias("level"), F.col("up").alias("idx"),
                           F.array_join(F.col("kids.hash"), "").alias("kids"), F.ceil(F.col("below") / RUN).cast("long").alias("n"), "size")
        runs = runs.withColumn("hash", digest(F.col("kids")))
        nodes = written(runs.select("*", *_link(F.col("tree"), level, F.col("idx"), F.col("n") == 1, parts)), "merkle-level")
        built.append(nodes)
        tops.append(nodes.filter("n = 1"))
    one = tops[0].select("tree", "hash", "size")
    for t in tops[1:]:
        one = one.unionAll(t.select("tree", "hash", "size"))
    return built, one


def build(leaves: DataFrame) -> Manifest:
    """Manifest of ``leaves``: ``part`` string (null is a part), ``doc_id`` long, ``leaf``
    and ``forged`` binary digests (null: not forged). Null ids come first; rows of one id stand in the
    order of their digests, so repeated rows are leaves of their own. An empty table
    has no nodes and no root."""
    spark = leaves.sparkSession
    # null and empty parts differ: a key without nulls that sorts in the same order
    keyed = leaves.select(F.when(F.col("part").isNull(), "").otherwise(F.concat(F.lit("="), "part")).alias("key"), "part",
                          "doc_id", "leaf", "forged")
    # the running number splits a hot id's equal rows over range partitions
    keyed = written(keyed.withColumn("tie", F.monotonically_increasing_id()), "leaves", compression="zstd")
    sizes = written(keyed.groupBy("key").agg(F.first("part").alias("part"), F.count("*").alias("n")), "part-sizes")
    bounds = sizes.agg(F.count("*"), F.max("n")).first()
    parts, longest = bounds[0], bounds[1] or 0
    sizes = written(numbered(sizes, None, "key").withColumnRenamed("pos", "tree"), "parts")

    placed = numbered(keyed.drop("part"), "key", "doc_id", "leaf", "tie").join(sizes.select("key", "tree", "n"), "key")
    lowest = placed.groupBy("tree", F.floor(F.col("pos") / RUN).cast("long").alias("idx")).agg(
        F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("pos", "doc_id", "leaf", "forged"))).alias("leaves"))
    hashed = lowest.withColumn("lone", F.col("n") == 1).withColumn(
        "hash", F.when(F.col("lone"), shown(F.col("leaves")[0]["leaf"])).otherwise(digest(_kids("leaves"))))
    hashed = hashed.withColumn("n", F.ceil(F.col("n") / RUN).cast("long"))
    runs = written(hashed.select("*", *_link(F.col("tree"), 1, F.col("idx"), F.col("n") == 1, parts)), "merkle-runs", compression="zstd")

    inner, subroots = _grow(runs.select("tree", "idx", "hash", F.lit(1).cast("long").alias("size"), "n"), 1, -(-longest // RUN), parts)
    subroots = written(subroots, "subroots")
    top = subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), "hash", "size", F.lit(parts).cast("long").alias("n"))
    upper, roots = _grow(top, 0, parts, parts)
    columns = ["tree", "level", "idx", "kids", "hash", F.ceil(F.col("size") / SHARE).cast("int").alias("split"),
               "up_tree", "up_level", "up_idx", "place"]
    nodes = None
    for level in inner + upper:
        nodes = level.select(columns) if nodes is None else nodes.unionAll(level.select(columns))
    if nodes is None:
        nodes = spark.createDataFrame([], "tree long, level int, idx long, kids string, hash string, split int, "
                                                        "up_tree long, up_level int, up_idx long, place int")
    root = roots.first() if parts else None
    return Manifest(runs, written(_with_parent(nodes, nodes), "merkle-nodes"), sizes.join(subroots, "tree").select(
        "tree", "part", "n", F.col("hash").alias("subroot")), root and root.hash)


def _with_parent(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """``rows`` with the copies of their parent; a node has 16 children at most."""
    above = nodes.select(F.col("tree").alias("up_tree"), F.col("level").alias("up_level"), F.col("idx").alias("up_idx"),
                         F.col("split").alias("up_split"))
    return rows.join(above, ["up_tree", "up_level", "up_idx"], "left")


def _others(kids: Column, place: Column) -> Column:
    return F.concat(kids.substr(F.lit(1), place * HEX), kids.substr(place * HEX + HEX + 1, F.length(kids)))


def _folded(kids: Column, place: Column, value: Column) -> Column:
    return digest(F.concat(kids.substr(F.lit(1), place * HEX), value, kids.substr(place * HEX + HEX + 1, F.length(kids))))


CLIMB = """
WITH RECURSIVE climb(tree, idx, up_tree, up_level, up_idx, up_copy, place, folded, proof) AS (
  SELECT tree, idx, up_tree, up_level, up_idx, pmod(xxhash64(tree, idx), up_split), place, folded, proof FROM {start}
  UNION ALL
  SELECT c.tree, c.idx, n.up_tree, n.up_level, n.up_idx, pmod(xxhash64(c.tree, c.idx), n.up_split), n.place,
         transform(c.folded, f -> unhex(sha2(cast(concat(left(n.kids, c.place * 64), lower(hex(f)), substr(n.kids, c.place * 64 + 65)) AS binary), 256))),
         concat(c.proof, unhex(concat(left(n.kids, c.place * 64), substr(n.kids, c.place * 64 + 65))))
  FROM climb c JOIN {nodes} n ON n.tree = c.up_tree AND n.level = c.up_level AND n.idx = c.up_idx AND n.copy = c.up_copy
)
SELECT tree, idx, folded, proof FROM climb WHERE place IS NULL"""


def prove(manifest: Manifest) -> DataFrame:
    """One row per leaf: ``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256`` of its
    siblings in order from its own run to the root, ``folded_root`` recomputed from
    ``forged`` and the original siblings, and ``verified``: whether that is the root."""
    spark = manifest.runs.sparkSession
    # the climb's rows grow with the table; its depth is the tree's
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    lone = F.col("lone")
    folded = F.transform("leaves", lambda x, i: F.unhex(F.when(lone, shown(F.coalesce(x["forged"], x["leaf"]))).otherwise(
        _folded(F.col("kids"), i, shown(F.coalesce(x["forged"], x["leaf"]))))))
    first = manifest.runs.withColumn("kids", _kids("leaves")).select(
        "tree", "idx", "up_tree", "up_level", "up_idx", "place", folded.alias("folded"), F.lit(b"").alias("proof"))
    start = written(_with_parent(first, manifest.nodes), "climb-start", compression="zstd")
    copies = manifest.nodes.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("split") - 1)))
    climbed = spark.sql(CLIMB, start=start, nodes=copies)
    done = manifest.runs.select("tree", "idx", "leaves", "lone").join(climbed, ["tree", "idx"]).join(
        manifest.parts.select("tree", "subroot"), "tree")
    rows = done.select("subroot", "lone", "proof", _kids("leaves").alias("kids"), F.posexplode(F.arrays_zip("leaves", "folded")).alias("i", "x")).select(
        "subroot", "kids", "lone", "proof", "i", "x.leaves.doc_id", shown(F.col("x.leaves.leaf")).alias("leaf"),
        shown(F.col("x.folded")).alias("folded_root"))
    first = F.when(lone, "").otherwise(_others(F.col("kids"), F.col("i")))
    return rows.select("doc_id", "leaf", "subroot", F.lit(manifest.root).cast("string").alias("root"),
                       digest(F.concat(first, shown(F.col("proof")))).alias("proof_sha256"), "folded_root",
                       (F.col("folded_root") == F.lit(manifest.root).cast("string")).alias("verified"))


def manifest_of(docs: DataFrame, tampered: Column, key: str = "doc_id", text: str = "text", part: str = "source",
                columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text")) -> Manifest:
    """Manifest of ``docs`` over ``columns``, one leaf a row. Where ``tampered`` holds, the
    forged leaf has the text's A-Z lower-cased (a null text stays). Nulls in any
    column are told from empty values; other columns are not read."""
    prepare(docs.sparkSession)
    values = [F.col(c) for c in columns]
    low = [F.translate(F.col(c), CAPITALS, SMALL) if c == text else F.col(c) for c in columns]
    whole = leaf(values)
    rows = docs.select(F.col(part).cast("string").alias("part"), F.col(key).cast("long").alias("doc_id"), whole.alias("leaf"),
                       F.when(tampered, leaf(low)).alias("forged"))
    return build(rows)
