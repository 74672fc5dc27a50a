"""Merkle manifest of a dataset, from concatenated level strings.

A leaf is the SHA-256 of a row's encoded columns. The leaves of a group (``lang``) stand in the
order of their keys; eight consecutive nodes make a parent until one is left, the subroot, and
the subroots make the root in the same way.

Places come from one sort over ranges of (group, key, leaf): Spark numbers the rows of each range,
and running sums over one row per (range, group) turn that into places. ``BLOCK`` aligned nodes
are one row. It keeps every level of the block as one string of hex digests; substrings of fixed
width are the runs that hash to parents, and the digits on either side of a node within its run
are its siblings. The roots of blocks are nodes of a tree of their own, until one block is left.
No task ever sees more than a range or a block, whatever a group holds. All of it is SQL.

Defined results: a null column is written ``-``; null groups come first, null keys first within a
group; rows of one key stand in the order of their leaves, so equal rows are interchangeable; a
group of one row is its own subroot, a single subroot is the root; an empty table has no rows;
long texts are read by the first scan only, columns beyond those named are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kpiweave.llm.common import id_remainder, stored

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY, DIGEST, LEVELS = 8, 64, 3
BLOCK = ARITY**LEVELS
RUN = ARITY * DIGEST  # hex digits of a full run
FEW_GROUPS = 10_000  # two kilobytes each at most are broadcast
SALTS = 32
EVERY = 3  # rows whose id's crc32 this divides are tampered with in the report
_ABC = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PATH = "array<struct<left:binary,right:binary>>"


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf(columns: Sequence[Column]) -> Column:
    """The digest of the columns, each as byte count, colon and value."""
    parts = []
    for column in columns:
        text = column.cast("string")
        size = F.octet_length(text).cast("string")
        parts.append(F.coalesce(F.concat(size, F.lit(":"), text), F.lit("-")))
    return digest(F.concat(*parts))


def places(rows: DataFrame, order: Sequence[str]) -> tuple[DataFrame, int]:
    """``rows``, whose first order column is ``group``, with ``pos`` (from 0) and ``n``, the
    size of the group; and the size of the largest group."""
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = stored(ranged.withColumn("at", F.monotonically_increasing_id()), "ranges")
    part = F.shiftrightunsigned("at", 33)  # the number of the range; the rest counts its rows
    sums = ranged.groupBy(F.col("group").alias("g"), part.alias("p")).agg(
        F.count("*").alias("c"), F.min("at").alias("first")
    )
    whole = Window.partitionBy("g")
    before = whole.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("c").over(before), F.lit(0)) - F.col("first")
    sums = sums.select("g", "p", shift.alias("shift"), F.sum("c").over(whole).alias("n"))
    sums = stored(sums, "range-sums")
    same = F.col("group").eqNullSafe(F.col("g")) & (part == F.col("p"))
    pos = (F.col("at") + F.col("shift")).alias("pos")
    placed = ranged.join(sums, same).select(*rows.columns, pos, "n")
    return placed, sums.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]


def _cut(text: str, start: Column, length: Column | int) -> Column:
    """Bytes of a string of digits, from 0. Binary, so that the start is found at once."""
    length = F.lit(length) if isinstance(length, int) else length
    return F.substring(F.col(text), (start + 1).cast("int"), length.cast("int"))


def _parent(text: str):
    return lambda i: F.sha2(_cut(text, i * RUN, RUN), 256)


def _blocks(nodes: DataFrame, kept: Sequence[str]) -> DataFrame:
    """group, block, n, members (pos and what is kept of each node), level0 .. level3."""
    block = F.floor(F.col("pos") / BLOCK).cast("bigint").alias("block")
    member = F.struct("pos", "node", *kept)
    rows = nodes.groupBy("group", block, "n").agg(F.sort_array(F.collect_list(member)).alias("m"))
    digits = F.array_join(F.transform("m", lambda m: m["node"]), "").cast("binary")
    rows = rows.withColumn("level0", digits)
    for k in range(LEVELS):
        text = f"level{k}"
        runs = F.sequence(F.lit(0), F.floor((F.octet_length(text) - 1) / RUN).cast("int"))
        parents = F.transform(runs, _parent(text))
        # A tree that has come down to one node is done.
        more = F.col("n") > ARITY**k
        rows = rows.withColumn(
            f"level{k + 1}", F.when(more, F.array_join(parents, "").cast("binary"))
        )
    slim = F.transform("m", lambda x: F.struct(*[x[c].alias(c) for c in ("pos", *kept)]))
    return rows.select(
        "group", "block", "n", slim.alias("members"), *[f"level{k}" for k in range(LEVELS + 1)]
    )


def _top() -> Column:
    levels = [F.col(f"level{k}") for k in range(LEVELS, -1, -1)]
    return F.coalesce(*levels).cast("string")


def _siblings(pos: Column) -> Column:
    """The digits left and right of the node's run, for each level of its block."""
    steps = []
    for k in range(LEVELS):
        place = F.floor((pos % BLOCK) / ARITY**k)
        run = F.floor(place / ARITY) * RUN
        own = place % ARITY * DIGEST
        left = _cut(f"level{k}", run, own)
        right = _cut(f"level{k}", run + own + DIGEST, RUN - DIGEST - own)
        step = F.struct(left.alias("left"), right.alias("right"))
        steps.append(F.when(F.col("n") > ARITY**k, step))
    return F.array_compact(F.array(*steps))


def climb(nodes: DataFrame, kept: Sequence[str], largest: int) -> tuple[DataFrame, DataFrame]:
    """Trees over ``nodes`` (group, pos, n, node and ``kept``). Returns the blocks, with the
    siblings ``above`` each of them, and group, top: the last node of each tree."""
    blocks = stored(_blocks(nodes, kept), "blocks")
    if largest <= BLOCK:
        none = F.array().cast(PATH)
        return blocks.withColumn("above", none), blocks.select("group", _top().alias("top"))
    size = F.ceil(F.col("n") / BLOCK).cast("bigint").alias("n")
    roots = blocks.select("group", F.col("block").alias("pos"), size, _top().alias("node"))
    upper, tops = climb(roots, (), -(-largest // BLOCK))
    upper = members(upper, ()).select(
        F.col("group").alias("g"), F.col("pos").alias("b"), F.col("path").alias("above")
    )
    same = F.col("group").eqNullSafe(F.col("g")) & (F.col("block") == F.col("b"))
    return blocks.join(upper, same).drop("g", "b"), tops


def members(blocks: DataFrame, kept: Sequence[str], also: Sequence[str] = ()) -> DataFrame:
    """A row per node of the blocks: group, pos, node, path (siblings from the node to the top),
    and what was kept; ``also`` names further columns of the block."""

    def full(m: Column) -> Column:
        place = (m["pos"] % BLOCK) * DIGEST
        path = F.concat(_siblings(m["pos"]), F.col("above"))
        return F.struct(
            *[m[c].alias(c) for c in ("pos", *kept)],
            _cut("level0", place, DIGEST).cast("string").alias("node"),
            path.alias("path"),
        )

    rows = blocks.select("group", *also, F.explode(F.transform("members", full)).alias("row"))
    return rows.select("group", *also, "row.*")


def _with_group(blocks: DataFrame, upper: DataFrame, groups: int) -> DataFrame:
    """The blocks with what ``upper`` says of their group. A group may hold most of the blocks, so
    they are not dealt by group alone: few groups are broadcast, many are copied per salt."""
    same = F.col("group").eqNullSafe(F.col("name"))
    if groups <= FEW_GROUPS:
        return blocks.join(F.broadcast(upper), same)
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("copy")
    salted = blocks.withColumn("salt", F.pmod("block", F.lit(SALTS)).cast("int"))
    return salted.join(upper.select("*", salts), same & (F.col("salt") == F.col("copy"))).drop("salt", "copy")


def proofs(leaves: DataFrame, kept: Sequence[str] = ()) -> DataFrame:
    """``leaves``: group, key, leaf and ``kept``. Returns them with subroot, root and path."""
    placed, largest = places(stored(leaves, "leaves"), ("group", "key", "leaf"))
    own = ("key", *kept)
    blocks, tops = climb(placed.withColumnRenamed("leaf", "node"), own, largest)
    tops = stored(tops, "subroots")
    # The trees' tops, in the order of their groups, are the nodes of one last tree.
    named = tops.select(F.lit(0).alias("group"), F.col("group").alias("name"), F.col("top").alias("node"))
    over, groups = places(named, ("group", "name"))
    upper, root = climb(over, ("name",), groups)
    root = root.select(F.col("top").alias("root"), F.col("group").alias("all"))
    upper = members(upper, ("name",)).join(root, F.col("group") == F.col("all"))
    upper = upper.select("name", F.col("node").alias("subroot"), "root", F.col("path").alias("last"))
    joined = _with_group(blocks, upper, groups)
    joined = joined.withColumn("above", F.concat("above", "last"))
    rows = members(joined, own, ("subroot", "root"))
    return rows.select("group", *own, F.col("node").alias("leaf"), "subroot", "root", "path")


def proof(path: str = "path") -> Column:
    """The siblings as one string, level by level, left to right."""
    return F.array_join(
        F.transform(path, lambda s: F.concat(s["left"], s["right"]).cast("string")), ""
    )


def folded(start: Column, path: str = "path") -> Column:
    """The root that ``start`` leads to along the siblings."""
    return F.aggregate(
        F.col(path),
        start,
        lambda node, s: F.sha2(F.concat(s["left"], node.cast("binary"), s["right"]), 256),
    )


def leaves(documents: DataFrame, columns: Sequence[str] = COLUMNS) -> DataFrame:
    """group, key, leaf, and ``tampered``: the leaf of a row that was tampered with, else null."""
    values = [F.col(c) for c in columns]
    lowered = [F.translate(v, _ABC, _ABC.lower()) if c == "text" else v for c, v in zip(columns, values)]
    chosen = id_remainder("doc_id", EVERY) == 0
    return documents.select(
        F.col("lang").cast("string").alias("group"),
        F.col("doc_id").cast("bigint").alias("key"),
        leaf(values).alias("leaf"),
        F.when(chosen, leaf(lowered)).alias("tampered"),
    )


def report(documents: DataFrame) -> DataFrame:
    rows = proofs(leaves(documents), ("tampered",))
    rows = rows.withColumn("folded_root", folded(F.coalesce("tampered", "leaf")))
    return rows.select(
        F.col("key").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        digest(proof()).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
