"""Connected components of a link table, by label propagation with shortcuts over staged tables.

Every node holds a label that only falls. A round gives each node the smallest label among its
neighbours' and its own, offers that label to the node's former label too (hooking), and then
replaces labels by their labels' labels (shortcut), so that the number of rounds grows with the
logarithm of a component's diameter. Links are pre-aggregated before every shuffle; labels are
staged after every round, so lineage stays short and lost executors cost one round at most. Look-ups
of labels are salted for nodes that many links or many nodes of a component point to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nextpick.operators.joins import hot_keys, salted_join
from nextpick.sources.stage import stage

MOST_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a, b), of any ordered type: root is the component's
    smallest node. Links may repeat, and may be given in one direction."""
    both = links.select("a", "b").filter(F.col("a") != F.col("b"))
    both = stage(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select(
        "node", F.least("node", "m").alias("root")), "labels")
    hubs = hot_keys(both, "b")
    for _ in range(MOST_ROUNDS):
        near = salted_join(both.withColumnRenamed("b", "node"), labels, "node", hubs).groupBy("a").agg(F.min("root").alias("near"))
        met = labels.join(near, labels["node"] == near["a"]).select("node", "root", F.least("root", "near").alias("low"))
        # Each node's new label is also offered to its old one.
        offers = met.select("node", F.col("low").alias("offer")).unionByName(
            met.filter(F.col("low") < F.col("root")).select(F.col("root").alias("node"), F.col("low").alias("offer")))
        hooked = offers.groupBy("node").agg(F.min("offer").alias("up"))
        of = hooked.select(F.col("node").alias("up"), F.col("up").alias("_up"))
        # What many nodes had as their root, many have as it or hear of it now.
        short = salted_join(hooked, of, "up", hot_keys(labels, "root"), "left").select(
            "node", F.coalesce(F.least("up", "_up"), "up").alias("root"))
        renewed = stage(short, "labels")
        changed = renewed.join(labels.withColumnRenamed("root", "was"), "node").filter(F.col("root") != F.col("was")).limit(1).count()
        labels = renewed
        if not changed:
            return labels
    raise RuntimeError("components did not settle")
