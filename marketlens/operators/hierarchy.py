"""Recursive tree expansion (adjacency list -> one row per reachable node).

Expressed as a ``WITH RECURSIVE`` query, which Spark plans as a
``UnionLoop``: one join per level, so the cost grows with the depth of the
tree, not with its width.  Nodes unreachable from a root (orphans, cycles)
never enter the recursion; ``unreachable_nodes`` reports them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PATH_SEPARATOR = " > "
#: Levels after which the expansion gives up.
MAX_DEPTH = 10_000


def expand_tree(nodes: DataFrame, *, id_col: str = "category_id", parent_col: str = "parent_id",
                name_col: str = "category_name", max_depth: int = MAX_DEPTH) -> DataFrame:
    """Columns: id, parent, name, root_category_id, root_category_name, depth,
    category_path (names from the root joined by `` > ``).  A tree deeper than
    ``max_depth`` is an error, and so is one that an id on two parents has
    closed to a cycle; ``operators.deep_tree`` has no such bound."""
    spark = nodes.sparkSession
    # trees of any size: a level without rows ends the recursion
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    n = nodes.select(F.col(id_col).alias("nid"), F.col(parent_col).alias("npar"), F.col(name_col).alias("nname"))
    tree = spark.sql(
        f"""
        WITH RECURSIVE tree MAX RECURSION LEVEL {max_depth} AS (
          SELECT nid, npar, nname, nid AS root_id, nname AS root_name, 0 AS depth,
                 CAST(nname AS STRING) AS path
          FROM {{n}} WHERE npar IS NULL
          UNION ALL
          SELECT c.nid, c.npar, c.nname, t.root_id, t.root_name, t.depth + 1,
                 concat(t.path, '{PATH_SEPARATOR}', c.nname)
          FROM {{n}} c JOIN tree t ON c.npar = t.nid
        )
        SELECT * FROM tree""",
        n=n,
    )
    return tree.select(
        F.col("nid").alias(id_col), F.col("npar").alias(parent_col), F.col("nname").alias(name_col),
        F.col("root_id").alias("root_category_id"), F.col("root_name").alias("root_category_name"),
        F.col("depth").cast("int").alias("depth"), F.col("path").alias("category_path"))


def unreachable_nodes(nodes: DataFrame, tree: DataFrame, id_col: str = "category_id") -> DataFrame:
    """Nodes that no root reaches (orphans and members of cycles)."""
    return nodes.join(tree.select(id_col), id_col, "left_anti")
