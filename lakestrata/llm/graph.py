"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.session import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every end of a link (u, v); root is the component's smallest node.

    Union-find by rounds: each node is hooked to its smallest neighbour, pointers are
    shortened, and the links between what remains are contracted, until there are none.
    Every round is written out; nodes and links stay distributed.
    """
    rest = materialize(links.select("u", "v").where("u <> v").distinct())
    found: DataFrame | None = None
    while True:
        both = rest.unionByName(rest.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hooked = materialize(
            both.groupBy("u").agg(F.min("v").alias("v")).select(
                F.col("u").alias("node"), F.least("u", "v").alias("root")
            )
        )
        for _ in range(2):
            hooked = materialize(_follow(hooked, hooked))
        found = hooked if found is None else materialize(_follow(found, hooked))
        u = hooked.select(F.col("node").alias("u"), F.col("root").alias("ru"))
        v = hooked.select(F.col("node").alias("v"), F.col("root").alias("rv"))
        rest = materialize(
            rest.join(u, "u")
            .join(v, "v")
            .where("ru <> rv")
            .select(F.col("ru").alias("u"), F.col("rv").alias("v"))
            .distinct()
        )
        if rest.isEmpty():
            return found


def _follow(pointers: DataFrame, onward: DataFrame) -> DataFrame:
    """Each root replaced by where ``onward`` takes it, if it does."""
    step = onward.select(F.col("node").alias("root"), F.col("root").alias("next"))
    return pointers.join(step, "root", "left").select(
        "node", F.coalesce("next", "root").alias("root")
    )
