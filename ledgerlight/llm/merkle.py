"""Merkle dataset manifest: leaf coordinates by bitmap rank, levels by keyed slot arrays.

A leaf is the SHA-256 of a row's length-prefixed columns. Leaves form one tree
per group (a language), in order of their ids, and the groups' roots form a
tree above them; every ``FANOUT`` consecutive nodes hash into one.

*Coordinates.* The ids of a group are a bitmap, held as its non-zero 64-bit
words: map tasks OR their bits together, the shuffle merges the tasks' words,
and popcounts summed over words, blocks of 2**16 words, and so on up, give a
directory of the ids before each word. The rank of an id is then the directory
entry of its word plus the popcount of the bits below its own. Leaves are
never sorted; prefix sums run within one directory block, at most 2**16
entries, however the ids lie. Rows that share an id are ranked the same way by
their leaf, and equal rows by their place in the written leaf table.

*Levels.* Nodes are keyed by (group, position // 4096). A task fills the key's
slot array and reduces it by four levels, so 4096 nodes become one per shuffle.
On the way back down each task gets the path of its one ancestor and completes
the paths of its nodes.

Defined results: null columns hash as ``-``; a null id comes first; a null
group comes first among groups; rows sharing an id and a group are ordered by
leaf; equal rows get neighbouring places (which of them gets which is free);
a single leaf is its own root; an empty table gives no rows; long texts are
hashed whole; columns not named are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

FANOUT = 8
LEVELS = 4                      # levels reduced in one shuffle
SPAN = FANOUT ** LEVELS
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_NO_ID = -(1 << 63)
_PATH = "array<struct<before: string, after: string>>"


def leaf_hash(*columns: Column) -> Column:
    """Lowercase hex SHA-256 of columns as ``byte count:value``, nulls as ``-``."""
    def field(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))

    return F.sha2(F.concat(*map(field, columns)), 256)


# --------------------------------------------------------------------------- coordinates

def bitmap_directory(keys: DataFrame, group: Sequence[str]) -> DataFrame:
    """``(group..., word, bits, before)`` of counted long keys: the group's bitmap words, and the rows before each."""
    g = list(group)
    words = materialise(
        keys.groupBy(*g, F.shiftright("key", 6).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(key & 63 as int)))").alias("bits"), F.sum("rows").alias("rows")), "words")

    def before(at: Column, parent: Column) -> Column:
        block = Window.partitionBy(*g, parent).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("rows").over(block), F.lit(0))

    out = words.withColumn("before", before(F.col("word"), F.shiftright("word", 16)))
    level = words.withColumnRenamed("word", "at")
    for depth in (1, 2, 3):     # 58 bits of word number: 16 a level, 10 at the top
        level = level.groupBy(*g, F.shiftright("at", 16).alias("at")).agg(F.sum("rows").alias("rows"))
        parent = F.shiftright("at", 16) if depth < 3 else F.lit(0)
        step = level.select(*g, F.col("at").alias("block"), before(F.col("at"), parent).alias("step"))
        out = out.withColumn("block", F.shiftright("word", 16 * depth)).join(step, [*g, "block"]) \
            .withColumn("before", F.col("before") + F.col("step")).drop("block", "step")
    return out.select(*g, "word", "bits", "before")


def bitmap_rank(rows: DataFrame, group: Sequence[str], key: str, out: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` with ``out``, the number of rows of the group with a smaller key, and ``ties``, the rows with this key.

    Also returns the keys that several rows share. Within a word the count
    below a bit is its popcount, plus the surplus of shared keys there.
    """
    g = list(group)
    keys = rows.groupBy(*g, F.col(key).alias("key")).agg(F.count("*").alias("rows"))
    shared = materialise(keys.where("rows > 1"), "shared")
    directory = bitmap_directory(keys, g)
    word, bit = F.shiftright(key, 6), F.expr(f"cast({key} & 63 as int)")
    below = F.expr(f"bit_count(bits & ~shiftleft(-1L, cast({key} & 63 as int)))")
    ranked = rows.withColumn("word", word).join(directory, [*g, "word"]).withColumn(out, F.col("before") + below)
    if shared.isEmpty():
        return ranked.drop("word", "bits", "before").withColumn("ties", F.lit(1).cast("long")), shared
    # surplus of shared keys: at most 64 entries a word
    extra = shared.withColumn("word", F.shiftright("key", 6)).groupBy(*g, "word").agg(
        F.collect_list(F.struct(F.expr("cast(key & 63 as int)").alias("bit"), F.col("rows"))).alias("surplus"))
    ranked = ranked.join(extra, [*g, "word"], "left").withColumn("bit", bit)
    ranked = ranked.withColumn(out, F.col(out) + F.expr(
        "coalesce(aggregate(surplus, 0L, (s, x) -> s + if(x.bit < bit, x.rows - 1, 0L)), 0L)"))
    ranked = ranked.withColumn("ties", F.expr(
        "coalesce(aggregate(surplus, 1L, (s, x) -> if(x.bit = bit, x.rows, s)), 1L)"))
    return ranked.drop("word", "bits", "before", "surplus", "bit"), shared


def coordinates(leaves: DataFrame) -> DataFrame:
    """``leaves (grp, id, leaf, row, ...)`` with ``pos``: the place in the group by id, then leaf, then row."""
    at, shared = bitmap_rank(leaves, ["grp"], "id", "pos")
    if shared.isEmpty():
        return at.drop("ties")
    at = materialise(at, "ranked")
    alone, tied = at.where("ties = 1").drop("ties"), at.where("ties > 1").drop("ties")
    tied = tied.withColumn("leaf_key", F.conv(F.substring("leaf", 1, 15), 16, 10).cast("long"))
    by_leaf, again = bitmap_rank(tied, ["grp", "id"], "leaf_key", "step")
    by_leaf = by_leaf.withColumn("pos", F.col("pos") + F.col("step")).drop("step")
    if again.isEmpty():
        return alone.unionByName(by_leaf.drop("ties", "leaf_key"))
    by_leaf = materialise(by_leaf, "ranked")
    same = by_leaf.where("ties > 1").drop("ties")
    by_row, _ = bitmap_rank(same, ["grp", "id", "leaf_key"], "row", "step")
    by_row = by_row.withColumn("pos", F.col("pos") + F.col("step")).drop("step", "ties", "leaf_key")
    return alone.unionByName(by_leaf.where("ties = 1").drop("ties", "leaf_key")).unionByName(by_row)


# --------------------------------------------------------------------------- levels

def _levels(nodes: list[str], whole: int) -> list[list[str]]:
    """Slot arrays of a block, level by level: four, or up to a single node if the block is the whole tree."""
    out = [nodes]
    while len(out) <= LEVELS and (whole > SPAN or len(out[-1]) > 1):
        last = out[-1]
        out.append([hashlib.sha256("".join(last[i:i + FANOUT]).encode()).hexdigest() for i in range(0, len(last), FANOUT)])
    return out


def _slots(table: pa.Table) -> tuple[list[str], np.ndarray]:
    """The block's slot array and the slot of each row."""
    slot = table.column("pos").to_numpy() % SPAN
    nodes = np.empty(len(slot), object)
    nodes[slot] = table.column("node").to_pylist()
    return nodes.tolist(), slot


def _reduce(table: pa.Table) -> pa.Table:
    nodes, _ = _slots(table)
    whole = table.column("nodes")[0].as_py()
    return pa.table({"grp": table.column("grp").slice(0, 1), "pos": [table.column("pos")[0].as_py() // SPAN],
                     "nodes": [-(-whole // SPAN)], "node": [_levels(nodes, whole)[-1][0]]},
                    schema=pa.schema([("grp", pa.string()), ("pos", pa.int64()), ("nodes", pa.int64()), ("node", pa.string())]))


def _descend(keep: pa.Schema):
    """Completes the paths of a block's nodes with the path of its ancestor."""
    step = pa.struct([("before", pa.string()), ("after", pa.string())])

    def run(table: pa.Table, above: pa.Table) -> pa.Table:
        if not len(table):
            return keep.empty_table()
        nodes, slot = _slots(table)
        levels = _levels(nodes, table.column("nodes")[0].as_py())[:-1]
        rest = above.column("path")[0].as_py() if len(above) else []
        paths = []
        for s in slot.tolist():
            path = []
            for level in levels:
                at = s - s % FANOUT
                path.append({"before": "".join(level[at:s]), "after": "".join(level[s + 1:at + FANOUT])})
                s //= FANOUT
            paths.append(path + rest)
        columns = {c: table.column(c) for c in keep.names if c not in ("path", "subroot", "root")}
        columns["path"] = pa.array(paths, pa.list_(step))
        for c in ("subroot", "root"):
            if c in keep.names:
                columns[c] = pa.array([above.column(c)[0].as_py()] * len(table), pa.string())
        return pa.table([columns[c] for c in keep.names], schema=keep)
    return run


def _climb(nodes: DataFrame) -> list[DataFrame]:
    """Tables ``(grp, pos, nodes, node)`` from the leaves to the table with one node a group, each written."""
    tables = [nodes]
    while not tables[-1].where("nodes > 1").isEmpty():
        last = tables[-1]
        # a group already down to one node is its own block and stays as it is
        tables.append(materialise(last.select("grp", "pos", "nodes", "node").groupBy("grp", F.floor(F.col("pos") / SPAN))
                                  .applyInArrow(_reduce, "grp string, pos long, nodes long, node string"), "nodes"))
    return tables


def _walk_down(tables: list[DataFrame], top: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """``tables[0]`` with each node's path, level by level; ``top`` has the paths (and ``extra``) of the last table's nodes."""
    paths = top
    for k in range(len(tables) - 2, -1, -1):
        table = tables[k]
        out = pa.schema([*_arrow(table), ("path", pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))),
                         *((c, pa.string()) for c in extra)])
        ddl = f"{_ddl(table)}, path {_PATH}" + "".join(f", {c} string" for c in extra)
        above = paths.select(F.col("grp").alias("above_grp"), F.col("pos").alias("above_pos"), "path", *extra)
        found = table.groupBy("grp", F.floor(F.col("pos") / SPAN)) \
            .cogroup(above.groupBy("above_grp", "above_pos")).applyInArrow(_descend(out), ddl)
        paths = found if k == 0 else materialise(found, "paths")
    if len(tables) == 1:
        paths = tables[0].join(top.select("grp", "pos", "path", *extra), ["grp", "pos"]) \
            .select(*tables[0].columns, "path", *extra)
    return paths


def _arrow(df: DataFrame) -> list[tuple]:
    kinds = {"string": pa.string(), "bigint": pa.int64()}
    return [(c, kinds[t]) for c, t in df.dtypes]


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{c} {t}" for c, t in df.dtypes)


def prove(rows: DataFrame, leaf: Column, group_col: str = "lang", id_col: str = "doc_id",
          carry: dict[str, Column] | None = None) -> DataFrame:
    """``(id, <carry...>, leaf, pos, subroot, root, path)`` of every row: the manifest with an inclusion proof each.

    ``path`` lists, from the leaf's level to the root's, the sibling digests
    before and after the node as hex text. ``carry`` are string columns
    computed from the row that travel along.
    """
    carry = carry or {}
    group = F.coalesce(F.concat(F.lit("="), F.col(group_col)), F.lit(""))      # null first, then by bytes
    leaves = materialise(rows.select(
        group.alias("grp"), F.col(id_col).cast("long").alias("own_id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("id"), leaf.alias("leaf"),
        F.monotonically_increasing_id().alias("row"), *(c.alias(f"carry_{k}") for k, c in carry.items())), "leaves")
    sizes = leaves.groupBy("grp").agg(F.count("*").alias("nodes"))
    nodes = coordinates(leaves).join(sizes, "grp").withColumnRenamed("leaf", "node") \
        .select("grp", "pos", "nodes", "node", "own_id", *(f"carry_{k}" for k in carry))
    tables = _climb(materialise(nodes, "leaves"))

    # the tree over the groups: one group, its nodes in order of the groups' keys (a row each)
    place = F.row_number().over(Window.orderBy("of")) - 1
    tops = materialise(tables[-1].select(F.col("grp").alias("of"), F.col("node"))
                       .withColumn("pos", place.cast("long")), "roots")
    n = tops.count()
    upper = _climb(tops.select(F.lit("").alias("grp"), "pos", F.lit(n).cast("long").alias("nodes"), "node", "of"))
    root = upper[-1].select("grp", "pos", F.array().cast(_PATH).alias("path"), F.col("node").alias("root"))
    above = _walk_down(upper, root, ["root"]).select(
        F.col("of").alias("grp"), F.lit(0).cast("long").alias("pos"), "path", F.col("node").alias("subroot"), "root")
    out = _walk_down(tables, above, ["subroot", "root"])
    return out.select(F.col("own_id").alias("id"), *(F.col(f"carry_{k}").alias(k) for k in carry),
                      F.col("node").alias("leaf"), "pos", "subroot", "root", "path")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["before"], h, s["after"]), 256))


def path_digest(path: Column) -> Column:
    """SHA-256 of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)
