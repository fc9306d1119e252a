"""Merkle manifest of a table by butterfly exchange (operator 11).

Leaves are digests of rows; per group they ascend by id, and every FANOUT
consecutive nodes become their parent until one is left, the group's subroot.
The subroots, in order of their groups, become the root in the same way.

A block of FANOUT ** depth aligned leaves is a partition of the exchange. It
hashes its own subtree, then the blocks of a group swap roots round by round:
in round r a block meets the blocks that differ from it in digit r only (base
FANOUT), hears the roots of their FANOUT neighbouring subtrees of that level
and hashes the parent itself, as every other block below that parent does.
After the last round each block holds the subroot and the siblings of all its
ancestors; there is no pass back down. The last subtree of a level may have
fewer blocks than the others; each of its blocks then speaks for several. The
groups' subroots meet in a second exchange of the same kind, with one
partition per group.

Positions come from one range sort: a row's place is its place in its sorted
partition plus the rows of its group in earlier ones. Hot groups are split by
it; equal rows too, since a row number is the last sort key. No task holds more
than a block, or FANOUT messages of one block, at a time; only the largest
number of blocks of a group reaches the driver.

Cases: a null in any column is hashed as "-"; rows with a null id come first in
their group, and rows with one id ascend by their digest; equal rows are leaves
each; a null group is a group of its own, before all others; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadbook.llm.common import written

FANOUT, DEPTH = 16, 3
#: Messages that one exploded row makes at most at a time.
STRIDE = 1024


def digest(*values: Column) -> Column:
    """Lowercase hex sha256 of values: each "-" if null, else its UTF-8 byte count, ":" and the value."""
    def framed(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.sha2(F.concat(*map(framed, values)), 256)


def parent(run: list[str]) -> str:
    return hashlib.sha256("".join(run).encode()).hexdigest()


def numbered(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with their place ``i`` in their group (from 0, by ``order``) and the group's size ``n``."""
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)]
    laid = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    laid = written(laid.withColumn("__at", F.monotonically_increasing_id()), name)      # partition and row number in it
    laid = laid.withColumn("__part", F.shiftright("__at", 33))
    # one row per group and partition
    runs = laid.groupBy(group, "__part").agg(F.min("__at").alias("__first"), F.count("*").alias("__rows"))
    whole = Window.partitionBy(group)
    runs = runs.withColumn("__before", F.sum("__rows").over(whole.orderBy("__part")) - F.col("__rows")).withColumn(
        "n", F.sum("__rows").over(whole))
    placed = laid.join(written(runs, f"{name}-runs"), [group, "__part"])
    return placed.withColumn("i", F.col("__at") - F.col("__first") + F.col("__before")).drop(
        "__at", "__part", "__first", "__rows", "__before")


def levels(leaves: list[str], rounds: int | None, fanout: int) -> list[list[str]]:
    """The nodes of a subtree level by level: ``rounds`` of them, or until one node is left."""
    out = [leaves]
    while len(out) <= rounds if rounds is not None else len(out[-1]) > 1:
        out.append([parent(out[-1][at:at + fanout]) for at in range(0, len(out[-1]), fanout)])
    return out


def _rounds(n: int, depth: int, fanout: int) -> int | None:
    """Levels that a block of a group of ``n`` leaves hashes: all of ``depth`` if the group has further blocks."""
    return depth if n > fanout ** depth else None


def _rooted(depth: int, fanout: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            roots = []
            for n, rows in zip(b.column("n").to_pylist(), b.column("rows"), strict=True):
                leaves = pa.array(rows.values.field("leaf")).to_pylist()
                roots.append(levels(leaves, _rounds(n, depth, fanout), fanout)[-1][0])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(roots, pa.string())], [*b.schema.names, "node"])
    return run


def butterfly(parts: DataFrame, fanout: int, name: str) -> DataFrame:
    """Roots and upper proofs of partitions (g, i, n, node), where a group has the partitions i from 0 to n - 1.

    Adds ``path``: for each round the partition's place in its run and the nodes of the run; ``node`` becomes the
    root of the group.
    """
    state = parts.withColumn("path", F.array().cast("array<struct<at: int, run: array<string>>>"))
    most = parts.agg(F.max("n")).first()[0] or 0
    width = 1
    while width < most:
        w = F.lit(width).cast("long")
        busy = F.col("n") > w
        k, o = F.expr(f"i div {width}"), F.col("i") % w
        # holders of this block's node; all but the last node of a level have ``width`` of them
        sent = state.withColumn("k", k).withColumn("held", F.least(w, F.col("n") - k * w))
        sent = sent.withColumn("reach", F.when(busy, F.floor((w - 1 - o) / F.col("held")).cast("long")).otherwise(F.lit(0).cast("long")))
        low = F.col("k") - F.col("k") % fanout
        sent = sent.withColumn("child", F.explode(F.when(busy, F.sequence(low, F.least(low + fanout - 1, F.expr(f"(n - 1) div {width}"))))
                                                  .otherwise(F.array("k"))))
        sent = sent.withColumn("stride", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"reach div {STRIDE}"))))
        sent = sent.withColumn("step", F.explode(F.sequence(F.col("stride") * STRIDE, F.least(F.col("reach"), F.col("stride") * STRIDE + STRIDE - 1))))
        sent = sent.withColumn("to", F.col("child") * w + o + F.col("step") * F.col("held")).where("to < n")
        heard = sent.groupBy("g", "to", "n").agg(
            F.array_sort(F.collect_list(F.struct("k", "node"))).alias("run"),
            F.max(F.when(F.col("to") == F.col("i"), F.col("path"))).alias("path"))
        nodes = F.transform("run", lambda x: x["node"])
        step = F.struct((F.expr(f"to div {width}") % fanout).cast("int").alias("at"), nodes.alias("run"))
        state = written(heard.select(
            "g", F.col("to").alias("i"), "n",
            F.when(busy, F.sha2(F.array_join(nodes, ""), 256)).otherwise(nodes[0]).alias("node"),
            F.when(busy, F.concat("path", F.array(step))).otherwise(F.col("path")).alias("path")), f"{name}-{width}")
        width *= fanout
    return state


def _around(run: list[str], at: int) -> tuple[str, str]:
    return "".join(run[:at]), "".join(run[at + 1:])


def _proved(depth: int, fanout: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block in b.to_pylist():
                rows = block["rows"]
                tree = levels([r["leaf"] for r in rows], _rounds(block["n"], depth, fanout), fanout)
                above = [_around(step["run"], step["at"]) for step in (*block["path"], *block["top_path"])]
                out = []
                for j, r in enumerate(rows):
                    around, at = [], j
                    for nodes in tree[:-1]:
                        low = at - at % fanout
                        around.append(_around(nodes[low:low + fanout], at - low))
                        at //= fanout
                    around += above
                    folded = r["leaf"] if r["tampered"] is None else r["tampered"]
                    for left, right in around:
                        folded = parent([left, folded, right])
                    proof = parent([side for pair in around for side in pair])
                    out.append((r["id"], block["g"], r["leaf"], block["subroot"], block["root"], proof, folded, folded == block["root"]))
                cols = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _TYPES, strict=True)], ["id", "g", *RETURNED])
    return run


RETURNED = ["leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
_TYPES = [pa.int64(), *[pa.string()] * 6, pa.bool_()]


def manifest(leaves: DataFrame, depth: int = DEPTH, fanout: int = FANOUT) -> DataFrame:
    """Proofs of leaves (id long, group string, leaf, tampered: hex digests; ``tampered`` null where nothing was tampered with).

    Returns id, group, leaf, subroot, root, proof_sha256 (of the siblings' digests, level by level, left to right),
    folded_root (from the tampered leaf, if any, and the original siblings) and verified.
    """
    size = fanout ** depth
    # "" for null sorts before all, "=" keeps the order of the others
    own = leaves.select(F.coalesce(F.concat(F.lit("="), F.col("group")), F.lit("")).alias("g"), "id", "leaf", "tampered",
                        F.monotonically_increasing_id().alias("row"))
    own = written(own, "merkle-leaves")
    placed = numbered(own, "g", ["id", "leaf", "row"], "merkle-order")
    rows = F.array_sort(F.collect_list(F.struct("i", "id", "leaf", "tampered"))).alias("rows")     # at most ``size`` of them
    blocks = placed.groupBy("g", "n", F.expr(f"i div {size}").alias("i")).agg(rows)
    schema = "g string, n long, i long, rows array<struct<i: long, id: long, leaf: string, tampered: string>>"
    blocks = written(blocks.mapInArrow(_rooted(depth, fanout), f"{schema}, node string"), "merkle-blocks")

    parts = blocks.select("g", "i", F.ceil(F.col("n") / size).cast("long").alias("n"), "node")
    below = butterfly(parts, fanout, "merkle-below")
    tops = below.where("i = 0").select(F.lit(0).alias("all"), "g", "node")
    tops = numbered(tops, "all", ["g"], "merkle-groups")
    # the exchange between groups: one partition per group, in one group of all
    names = written(tops.select("g", "i", "n", "node"), "merkle-subroots")
    above = butterfly(names.select(F.lit("").alias("g"), "i", "n", "node"), fanout, "merkle-above")
    roots = names.select("g", "i").join(above.select("i", F.col("node").alias("root"), F.col("path").alias("top_path")), "i").drop("i")
    paths = below.select("g", "i", F.col("node").alias("subroot"), "path").join(roots, "g")
    whole = blocks.drop("node").join(paths, ["g", "i"])
    out = whole.mapInArrow(_proved(depth, fanout), "id long, g string, leaf string, subroot string, root string, "
                           "proof_sha256 string, folded_root string, verified boolean")
    group = F.when(F.col("g") != "", F.expr("substring(g, 2)"))
    return out.select("id", group.alias("group"), *RETURNED)
