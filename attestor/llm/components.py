"""Connected components of an edge table, by labels that are passed along edges and shortened."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestor.llm.scratch import materialize

MAX_ROUNDS = 60


def components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """(node, label): for each node of ``edges`` (a, b) the least node of its component.

    Every round hooks each node's label, and its label's label, to the least label among its
    neighbours; rounds are few because stars collapse at once.  All tables stay distributed; each
    round's labels are written, so that lost executors cost one round at most.  ``rows`` is the number of edges
    where it is known.
    """
    # both directions of an edge come from one row, so that what makes the edges runs once
    turned = edges.where("a <> b").select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
    both = materialize(turned.distinct(), "edges", None if rows is None else 2 * rows)
    rows = both.count()
    start = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label"))
    labels = materialize(start.select(F.col("a").alias("node"), "label"), "labels-0", rows)
    for k in range(1, MAX_ROUNDS):
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        # the least label in sight is offered to the node and to its present label
        seen = labels.join(near, labels["node"] == near["a"], "left").select("node", F.col("label").alias("old"), F.least("label", "near").alias("new"))
        told = F.struct(F.col("old").alias("node"), F.lit(None).cast("long").alias("old"), "new")
        offers = seen.select(F.inline(F.array(F.struct("node", "old", "new"), told))).groupBy("node").agg(F.max("old").alias("old"), F.min("new").alias("new"))
        offers = materialize(offers, f"offers-{k}", rows)  # so that the join below may split a very large component
        # shortcut: take the label of the label
        jump = offers.select(F.col("node").alias("at"), F.col("new").alias("jumped"))
        nxt = offers.join(jump, offers["new"] == jump["at"], "left").select("node", "old", F.least("new", "jumped").alias("label"))
        nxt = materialize(nxt, f"labels-{k}", rows)
        changed = nxt.where(F.col("label") < F.col("old")).limit(1).count()
        labels = nxt.select("node", "label")
        if not changed:
            return labels
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
