"""Connected components of a link table, for links between representatives."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rfsight.llm.scratch import drop, stored


def components(links: DataFrame, left: str = "a", right: str = "b", max_rounds: int = 100) -> DataFrame:
    """(node, root) of every linked node, the root being the least node of its component.

    Each round every root hooks onto the least root it has a link to, pointers are followed once more, and links
    are drawn anew between roots; links within a component fall away. Minima are combined on the map side and each
    round is a table of its own, so hubs, long chains and lost executors are all the same to it.
    """
    both = F.array(F.struct(F.col(left).alias("a"), F.col(right).alias("b")), F.struct(F.col(right).alias("a"), F.col(left).alias("b")))
    edges = stored(links.filter(F.col(left) != F.col(right)).select(F.inline(both)).distinct(), "edges")
    labels = stored(edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct(), "labels")
    for _ in range(max_rounds):
        if edges.isEmpty():
            return labels
        hooks = edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("to"))
        hooks = stored(hooks, "hooks")
        onward = hooks.select(F.col("a").alias("to"), F.col("to").alias("next"))
        jumped = stored(hooks.join(onward, "to").select(F.col("a").alias("root"), F.col("next").alias("new")), "jumped")
        moved = labels.join(jumped, "root", "left").select("node", F.coalesce("new", "root").alias("root"))
        ends = [jumped.select(F.col("root").alias(c), F.col("new").alias(f"new_{c}")) for c in ("a", "b")]
        redrawn = edges.join(ends[0], "a").join(ends[1], "b").filter("new_a <> new_b")
        redrawn = redrawn.select(F.col("new_a").alias("a"), F.col("new_b").alias("b")).distinct()
        old = [edges, labels, hooks, jumped]
        edges, labels = stored(redrawn, "edges"), stored(moved, "labels")
        drop(*old)
    raise RuntimeError(f"components did not settle within {max_rounds} rounds")
