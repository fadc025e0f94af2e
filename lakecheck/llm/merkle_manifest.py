"""Merkle manifest of a dataset: a forest of 8-ary hash trees, one a group, under one root, with a proof for every row.

A row's leaf is the hash of its fields.  Leaves get their places in their group's order by a distributed numbering;
then, level by level, the nodes of a run (8 consecutive ones) meet in a window of that run, where lag and lead columns
of the fixed offsets 1 to 7, masked by the node's slot and the run's length, supply its siblings, and the row of each
run's first child hashes the run into its parent.  A level is a table of an eighth of the rows below it.  On the way
down each node's path is its own siblings and its parent's path, joined by run, so no task ever holds more than a run
and a path, whatever share of the rows a group has.

Defined cases: a NULL field is hashed as ``-``; rows without a group are a group of their own, the first; rows
without an order key come first in their group; rows equal in both are placed by their leaf hash, and repeated rows
are leaves of their own; a group of one row has its leaf as subroot; a table of one row has the hash of nothing
as proof and its leaf as root; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakecheck.llm import common as C
from lakecheck.operators.numbering import number_rows

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """``-`` for NULL, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf(*values: Column) -> Column:
    return digest(*[field(v) for v in values])


def _with_siblings(nodes: DataFrame, fanout: int) -> DataFrame:
    """Nodes (tree, pos, n, h, ...) plus their run and the hashes of the run's earlier and later nodes."""
    run, slot = F.floor(F.col("pos") / fanout).cast("long"), F.pmod(F.col("pos"), F.lit(fanout))
    nodes = nodes.withColumn("run", run).withColumn("slot", slot).withColumn(
        "size", F.least(F.lit(fanout).cast("long"), F.col("n") - F.col("run") * fanout))
    w = Window.partitionBy("tree", "run").orderBy("pos")
    mask = lambda inside, h: F.when(inside, h).otherwise(F.lit(""))
    before = [mask(F.col("slot") >= j, F.lag("h", j).over(w)) for j in range(fanout - 1, 0, -1)]
    after = [mask(F.col("slot") + j < F.col("size"), F.lead("h", j).over(w)) for j in range(1, fanout)]
    return nodes.withColumns({"before": F.concat(*before), "after": F.concat(*after)})


def _climb(leaves: DataFrame, depth: int, fanout: int) -> list[DataFrame]:
    """The tables (tree, pos, n, h) of the levels above the leaves, as far as trees of more than one node reach."""
    levels = []
    at = leaves.select("tree", "pos", "n", "h")
    for k in range(depth):
        first = _with_siblings(at.where("n > 1"), fanout).where("slot = 0")
        at = C.stored(first.select("tree", F.col("run").alias("pos"), F.ceil(F.col("n") / fanout).cast("long").alias("n"),
                                   digest(F.col("h"), F.col("after")).alias("h")), f"merkle-{k + 1}")
        levels.append(at)
    return levels


def _paths(leaves: DataFrame, levels: list[DataFrame], above: DataFrame, fanout: int) -> DataFrame:
    """``leaves`` with the columns of ``above`` (tree, path, ...), the path led on from each leaf to its tree's top:
    a list of (before, after) hashes, the lowest level first."""
    more = [c for c in above.columns if c not in ("tree", "path")]
    tops = C.bounded(above)
    higher = None
    for k, nodes in reversed(list(enumerate([leaves, *levels]))):
        keep = nodes.columns if k == 0 else ["tree", "pos"]
        out = nodes.where("n = 1").join(tops, "tree").select(*keep, "path", *more)
        if higher is not None:
            up = higher.select("tree", F.col("pos").alias("run"), F.col("path").alias("rest"), *more)
            own = F.array(F.struct("before", "after"))
            out = out.unionByName(_with_siblings(nodes.where("n > 1"), fanout).join(up, ["tree", "run"])
                                  .withColumn("path", F.concat(own, F.col("rest"))).select(*keep, "path", *more))
        higher = C.stored(out, f"paths-{k}") if k else out
    return higher


def manifest(rows: DataFrame, group: str = "lang", order: str = "doc_id", fields: Sequence[str] = FIELDS,
             altered: dict[str, Column] | None = None, fanout: int = FANOUT) -> tuple[DataFrame, str | None]:
    """(order column, leaf, altered_leaf, subroot, path) of every row, and the root (None without rows).
    ``altered`` gives other values of fields, of which altered_leaf is made, as if a later reader had found them."""
    spark = rows.sparkSession
    found = [(altered or {}).get(f, F.col(f)) for f in fields]
    leaves = rows.select(F.col(group).cast("string").alias("group"), F.col(order).alias("id"),
                         leaf(*[F.col(f) for f in fields]).alias("h"), leaf(*found).alias("altered_leaf"))
    placed = C.stored(number_rows(leaves, ["group", "id", "h"], "place"), "leaves")
    trees = C.stored(placed.groupBy("group").agg(F.min("place").alias("tree"), F.count("*").alias("n")), "trees")
    most = trees.agg(F.max("n"), F.count("*")).first()
    if not most[1]:
        none = spark.createDataFrame([], "altered_leaf string, leaf string, subroot string, path array<struct<before:string,after:string>>")
        return none.select(F.lit(None).cast(rows.schema[order].dataType).alias(order), *none.columns), None
    depth = lambda n: next(d for d in range(64) if fanout ** d >= n)
    t = C.bounded(trees.withColumnRenamed("group", "g"))
    leaves = placed.join(t, F.col("group").eqNullSafe(F.col("g"))).select("id", "h", "altered_leaf", "tree", "n", (F.col("place") - F.col("tree")).alias("pos"))
    levels = _climb(leaves, depth(most[0]), fanout)
    subroots = leaves.where("n = 1").select("tree", "h")
    for nodes in levels:
        subroots = subroots.union(nodes.where("n = 1").select("tree", "h"))
    # the trees' tops, in the order of their first leaves, are the leaves of one more tree
    tops = number_rows(subroots, ["tree"], "place").select(
        F.lit(0).cast("long").alias("tree"), (F.col("place") - 1).alias("pos"), F.lit(most[1]).cast("long").alias("n"), "h", F.col("tree").alias("of"))
    tops = C.stored(tops, "tops")
    upper = _climb(tops, depth(most[1]), fanout)
    root = (upper[-1] if upper else tops).first()["h"]
    end = spark.range(1).select(F.col("id").alias("tree"), F.array().cast("array<struct<before:string,after:string>>").alias("path"))
    above = C.stored(_paths(tops, upper, end, fanout).select(F.col("of").alias("tree"), "path", F.col("h").alias("subroot")), "top-paths")
    out = _paths(leaves, levels, above, fanout)
    return out.select(F.col("id").alias(order), F.col("h").alias("leaf"), "altered_leaf", "subroot", "path"), root


def proof(path: Column) -> Column:
    """The hash of all siblings of a path."""
    return digest(F.array_join(F.transform(path, lambda x: F.concat(x["before"], x["after"])), ""))


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf leads to along a path."""
    return F.aggregate(path, start, lambda h, x: digest(x["before"], h, x["after"]))


def verify(rows: DataFrame, altered: dict[str, Column] | None = None, order: str = "doc_id", **how) -> DataFrame:
    """(order column, leaf, subroot, root, proof_sha256, folded_root, verified): whether each row, as it is found now
    (``altered``), still leads to the root of the manifest."""
    made, root = manifest(rows, order=order, altered=altered, **how)
    top = F.lit(root).cast("string")
    folded = fold(F.col("altered_leaf"), F.col("path"))
    return made.select(order, "leaf", "subroot", top.alias("root"), proof(F.col("path")).alias("proof_sha256"), folded.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))
