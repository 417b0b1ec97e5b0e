"""Roots and depths of trees of any depth by pointer doubling.

Every node begins with its parent as its known ancestor, one step away.  In
each round it takes the ancestor of its ancestor, so the distance doubles: a
chain of 100,000 nodes ends after 17 rounds of one equi-join each, where an
expansion level by level (``operators.hierarchy``) joins once a level.  Rounds
are stored tables, so a lost executor reads the last one again.

A node whose way up ends at an id that is not a node is an ``orphan``; one
whose way never ends leads into a ``cycle``.  Both are reported, and no round
count is set by hand: a way that has not ended after more steps than there are
nodes never ends.  Repeated and null ids are an error, since ways would fork.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.sources.sinks import materialize

ROOTED, ORPHAN, CYCLE = "rooted", "orphan", "cycle"


def resolve_tree(nodes: DataFrame, *, id_col: str, parent_col: str) -> DataFrame:
    """One row a node: ``id_col``, root_id (null unless rooted), depth (steps
    to the root; null unless rooted) and state (rooted, orphan or cycle)."""
    base = nodes.select(F.col(id_col).alias("id"), F.col(parent_col).alias("parent"))
    bad = base.groupBy("id").count().where((F.col("count") > 1) | F.col("id").isNull()).agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id")).first()
    if bad["n"]:
        raise ValueError(f"tree: {bad['n']} ids are null or repeated, such as {bad['id']}")
    # anc: the ancestor that is known, steps away; state: null while the way goes on
    table = materialize(base.select(
        "id", F.coalesce("parent", "id").alias("anc"), F.when(F.col("parent").isNull(), 0).otherwise(1).cast("long").alias("steps"),
        F.when(F.col("parent").isNull(), ROOTED).alias("state")))
    number, reach = table.count(), 1
    while True:
        going = table.where(F.col("state").isNull())
        if going.isEmpty():
            break
        if reach > number:  # more steps than nodes: a cycle
            table = table.withColumn("state", F.coalesce("state", F.lit(CYCLE)))
            break
        known = table.select(F.col("id").alias("k"), F.col("anc").alias("k_anc"), F.col("steps").alias("k_steps"),
                             F.coalesce("state", F.lit("")).alias("k_state"))
        moved = going.join(known, F.col("anc") == F.col("k"), "left").select(
            "id", F.coalesce("k_anc", "anc").alias("anc"), (F.col("steps") + F.coalesce("k_steps", F.lit(0))).alias("steps"),
            F.when(F.col("k").isNull(), ORPHAN).when(F.col("k_state") != "", F.col("k_state")).alias("state"))
        table = materialize(table.where(F.col("state").isNotNull()).unionByName(moved))
        reach *= 2
    rooted = F.col("state") == ROOTED
    return table.select(F.col("id").alias(id_col), F.when(rooted, F.col("anc")).alias("root_id"),
                        F.when(rooted, F.col("steps")).alias("depth"), "state")


def unreachable(nodes: DataFrame, *, id_col: str, parent_col: str) -> DataFrame:
    """The nodes that no root reaches, with the reason."""
    return resolve_tree(nodes, id_col=id_col, parent_col=parent_col).where(F.col("state") != ROOTED).select(
        id_col, F.col("state").alias("reason"))
