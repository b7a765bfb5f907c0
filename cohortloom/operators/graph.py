"""Parent and child records: closures, leaves, orphans."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.session import cut_lineage


def closure(roots: DataFrame, edges: DataFrame) -> DataFrame:
    """(root, id, parent, depth): every record reached from a root, at its least depth; the first parent in order counts.

    ``roots`` (id), ``edges`` (parent, child).  Each level is one join with the newest
    ids and an anti-join with those found, so cycles end by themselves and there are as many
    levels as the deepest record asks for; a level's result is written before the next.
    """
    found = roots.select(F.col("id").alias("root"), "id", F.lit(None).cast(roots.schema["id"].dataType).alias("parent"), F.lit(0).alias("depth")).distinct()
    frontier = found
    for level in count(1):
        step = frontier.select("root", F.col("id").alias("parent")).join(edges, "parent").groupBy("root", F.col("child").alias("id")).agg(F.min("parent").alias("parent"))
        frontier = cut_lineage(step.join(found, ["root", "id"], "left_anti").withColumn("depth", F.lit(level)).select("root", "id", "parent", "depth"))
        if frontier.isEmpty():
            break
        found = found.unionByName(frontier)
    return found


def leaves(roots: DataFrame, edges: DataFrame) -> DataFrame:
    """(root, id): the reached records that are no one's parent."""
    return closure(roots, edges).select("root", "id").join(edges.select(F.col("parent").alias("id")).distinct(), "id", "left_anti").select("root", "id")


def parent_orphans(members: DataFrame, edges: DataFrame) -> DataFrame:
    """(parent, member) that a parent lists and none of its children does; ``members`` (owner, member)."""
    of_children = edges.join(members.withColumnRenamed("owner", "child"), "child").select("parent", "member").distinct()
    return members.withColumnRenamed("owner", "parent").join(edges.select("parent").distinct(), "parent", "left_semi").distinct().join(of_children, ["parent", "member"], "left_anti")
