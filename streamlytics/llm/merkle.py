"""Operator 13, a Merkle manifest of a dataset by nested-struct rollups.

A row is a leaf: H (lowercase hex SHA-256 over the concatenated inputs, digests as hex text)
of ``doc_id, source, lang, n_chars, text``, each ``-`` if null, else its UTF-8 byte count,
``:`` and its value. The leaves of a ``lang`` ascend by ``doc_id``; every ``FAN`` nodes in a
row become their H while more than one remains; what remains is the subroot. The subroots by
``lang`` (null first, bytewise) give the root in the same way.

Ranks come from a range partitioning by (lang, doc_id, leaf) and the running counts of its
partitions, so no task sees a whole language. A rank's digits in base ``FAN`` are columns;
rows are dealt by blocks of ``FAN ** DEPTH`` neighbouring ranks and the digits are grouped
away one after another, each step nesting the child structs, until a block is one struct of
bounded size. The blocks' hashes are the nodes of the next rollup. Downwards, the siblings
left and right of each child are made by ``transform`` and the children are exploded; a
block meets its own path to the root in a grouping by block, not in a join. A leaf's proof
and the root folded from it are then expressions on its row.

All of it is built-in expressions. One hot language is only more blocks.

Defined cases: rows with a null ``doc_id`` come first in their language; rows that share a
``doc_id`` follow in the order of their leaf, equal rows each have a leaf and a proof of
their own; a null ``doc_id`` is never tampered with; a leaf without siblings at all has H of
nothing as its proof; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import null_safe, written

FAN, DEPTH = 8, 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def H(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def leaf_hash(fields: list[Column]) -> Column:
    def part(c: Column) -> Column:
        c = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return H(F.concat(*[part(c) for c in fields]))


def ranked(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` (key, ...) with ``rank``, its place from 0 in its key by ``order``, and ``n``, the
    key's number of nodes. Rows alike in ``order`` are in any order. Sorted by range, counted
    by (key, range partition), and the counts summed: one small row for each partition."""
    salted = written(nodes.withColumn("salt", F.monotonically_increasing_id()), "nodes")
    placed = salted.repartitionByRange("key", *order, "salt").sortWithinPartitions("key", *order, "salt").drop("salt")
    at = F.monotonically_increasing_id()
    placed = written(placed.withColumn("part", F.shiftright(at, 33)).withColumn("pos", at), "placed")
    counts = placed.groupBy("key", "part").agg(F.min("pos").alias("from"), F.count("*").alias("c"))
    by = Window.partitionBy("key")
    counts = counts.select(
        F.col("key").alias("k"), F.col("part").alias("p"), F.sum("c").over(by).alias("n"),
        (F.coalesce(F.sum("c").over(by.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
         - F.col("from")).alias("shift"))
    return null_safe(placed, counts, {"key": "k", "part": "p"}, "inner") \
        .withColumn("rank", F.col("pos") + F.col("shift")).drop("k", "p", "part", "pos", "shift")


def rollup(nodes: DataFrame, fan: int, depth: int) -> DataFrame:
    """``nodes`` (key, rank, n, hash, item) as blocks (key, block, count, hash, kids): ``count`` is
    the key's number of nodes, ``kids`` nests a block's children level by level."""
    df = nodes.select(
        "key", F.expr(f"rank div {fan ** depth}").alias("block"), F.col("n").alias("count"), "hash",
        F.struct("hash", "item").alias("node"),
        *[F.expr(f"cast(rank div {fan ** (k - 1)} % {fan} as int)").alias(f"d{k}") for k in range(1, depth + 1)]) \
        .repartition("key", "block")
    for k in range(1, depth + 1):
        left = [f"d{i}" for i in range(k + 1, depth + 1)]
        kids = F.array_sort(F.collect_list(F.struct(F.col(f"d{k}").alias("d"), "node")))
        df = df.groupBy("key", "block", "count", *left).agg(F.transform(kids, lambda x: x["node"]).alias("kids"))
        df = df.withColumn("hash", F.when(_nodes("count", fan, k - 1) > 1, H(F.array_join(F.col("kids.hash"), "")))
                           .otherwise(F.col("kids")[0]["hash"]))
        df = df.withColumn("node", F.struct("hash", "kids"))
    return df.select("key", "block", "count", "hash", "kids")


def _nodes(n: str, fan: int, level: int) -> Column:
    """How many nodes a key of ``n`` leaves has ``level`` levels up."""
    return F.expr(f"({n} + {fan ** level - 1}L) div {fan ** level}L")


def unrolled(blocks: DataFrame, fan: int, depth: int) -> DataFrame:
    """Of blocks (key, block, count, kids, path and top of the block) each node again, (key,
    item, path, top): the path has (left, right, real) for every level up to the root,
    lowest first; a level that the key's tree does not reach is not real."""
    df = blocks
    for k in range(depth, 0, -1):
        hashes = F.col("kids.hash")
        sides = F.transform("kids", lambda x, i: F.struct(
            x.alias("node"), F.array_join(F.slice(hashes, F.lit(1), i), "").alias("left"),
            F.array_join(F.slice(hashes, i + 2, F.lit(fan)), "").alias("right")))
        level = F.struct(F.col("s.left").alias("left"), F.col("s.right").alias("right"),
                         (_nodes("count", fan, k - 1) > 1).alias("real"))
        df = df.select("key", "count", "path", "top", F.explode(sides).alias("s")).select(
            "key", "count", F.concat(F.array(level), "path").alias("path"), "top",
            F.col("s.node.kids").alias("kids") if k > 1 else F.col("s.node.item").alias("item"))
    return df.select("key", "item", "path", "top")


PATH = "array<struct<left: string, right: string, real: boolean>>"
TOP = "struct<subroot: string, root: string>"


def _up(nodes: DataFrame, fan: int, depth: int) -> tuple[list[DataFrame], DataFrame]:
    """Rollups of ``nodes`` until each key has one node: the written blocks of every pass,
    and (key, hash) of what remains."""
    passes = []
    while True:
        blocks = written(rollup(nodes, fan, depth), "blocks")
        passes.append(blocks)
        most = blocks.agg(F.max("count")).first()[0]
        if most is None or most <= fan ** depth:
            return passes, blocks.select("key", "hash")
        nodes = blocks.select("key", F.col("block").alias("rank"), _nodes("count", fan, depth).alias("n"), "hash",
                              F.col("block").alias("item"))


def _down(passes: list[DataFrame], tops: DataFrame, fan: int, depth: int) -> DataFrame:
    """(key, item, path, top) of the nodes of the first pass; ``tops``: (key, path, top) of
    what remains of each key."""
    above = tops.select("key", F.lit(0).cast("long").alias("block"), "path", "top")
    for i, blocks in reversed(list(enumerate(passes))):
        kids = blocks.schema["kids"].dataType
        met = blocks.select("key", "block", "count", "kids", F.lit(None).cast(PATH).alias("path"), F.lit(None).cast(TOP).alias("top")) \
            .unionByName(above.withColumn("count", F.lit(None).cast("long")).withColumn("kids", F.lit(None).cast(kids))) \
            .groupBy("key", "block").agg(F.max("count").alias("count"), *[F.first(c, ignorenulls=True).alias(c)
                                                                          for c in ("kids", "path", "top")])
        found = unrolled(met, fan, depth)
        above = found.select("key", F.col("item").alias("block"), "path", "top") if i else None
    return found


def manifest(docs: DataFrame, fan: int = FAN, depth: int = DEPTH) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), a row for each row
    of ``docs``. Where 3 divides crc32 of the decimal ``doc_id``, folding starts from the leaf
    of the text with A-Z lower-cased, else from the leaf."""
    if fan < 2 or depth < 1:
        raise ValueError("fan must be at least 2 and depth at least 1")
    fields = [F.col(c) for c in FIELDS]
    lower = [*fields[:-1], F.translate("text", _UPPER, _LOWER)]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    leaves = docs.select(F.col("lang").cast("string").alias("key"), F.col("doc_id").cast("long").alias("doc_id"),
                         leaf_hash(fields).alias("hash"), F.when(tampered, leaf_hash(lower)).alias("start"))
    leaves = ranked(leaves, ["doc_id", "hash"]).select(
        "key", "rank", "n", "hash", F.struct("doc_id", F.col("hash").alias("leaf"), F.coalesce("start", "hash").alias("start")).alias("item"))
    passes, subroots = _up(leaves, fan, depth)
    langs = ranked(subroots.select(F.lit(0).alias("key"), F.col("key").alias("lang"), "hash"), ["lang"]) \
        .select("key", "rank", "n", "hash", F.struct("lang", F.col("hash").alias("subroot")).alias("item"))
    lang_passes, root = _up(langs, fan, depth)
    top = root.select("key", F.array().cast(PATH).alias("path"), F.struct(F.lit(None).cast("string").alias("subroot"), F.col("hash").alias("root")).alias("top"))
    tops = _down(lang_passes, top, fan, depth).select(
        F.col("item.lang").alias("key"), "path", F.struct("item.subroot", "top.root").alias("top"))
    siblings = F.array_join(F.transform("path", lambda x: F.concat(x["left"], x["right"])), "")
    folded = F.aggregate("path", F.col("item.start"),
                         lambda h, x: F.when(x["real"], H(F.concat(x["left"], h, x["right"]))).otherwise(h))
    return _down(passes, tops, fan, depth).select(
        "item.doc_id", "item.leaf", "top.subroot", "top.root", H(siblings).alias("proof_sha256"), folded.alias("folded_root")) \
        .withColumn("verified", F.col("folded_root") == F.col("root"))
