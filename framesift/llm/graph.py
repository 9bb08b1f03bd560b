"""Connected components over links, by smallest neighbours and pointer jumping on stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import cut


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``(id, component)``: the smallest id reachable over ``links`` (a, b), for every row of ``nodes`` (id).

    Every round each linked node takes the smallest label of its neighbours, the label's own node
    takes it too, and labels are replaced by the labels of their nodes.  Minima combine before the
    shuffle, joins have one row per key on one side, and the number of rounds is logarithmic in
    the usual case (at most the longest chain).
    """
    both = links.where("a <> b").select("a", "b").unionByName(links.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = cut(both.distinct())
    labels = cut(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")))
    while True:
        seen = both.join(labels.withColumnsRenamed({"a": "b"}), "b").groupBy("a").agg(F.min("label").alias("near"))
        best = labels.join(seen, "a").select("a", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        best = cut(best)
        # the node that lent the old label hears of a smaller one
        hooks = best.where("label < old").groupBy(F.col("old").alias("a")).agg(F.min("label").alias("hook"))
        hooked = cut(best.join(hooks, "a", "left").select("a", "old", F.least("label", F.coalesce("hook", F.col("label"))).alias("label")))
        roots = hooked.select(F.col("a").alias("label"), F.col("label").alias("root"))
        jumped = cut(hooked.join(roots, "label").select("a", "old", F.least("label", "root").alias("label")))
        labels = jumped.select("a", "label")
        if jumped.where("label < old").isEmpty():
            break
    return nodes.select("id").join(labels.withColumnsRenamed({"a": "id"}), "id", "left").select("id", F.coalesce("label", "id").alias("component"))
