"""Trees of any depth, given as (node, parent) rows.

The depth-first tour of a tree goes down into every node and up out of it again: two events per node, each with a
successor that only the neighbours decide (first child, next sibling, parent).  Pointer doubling adds up what lies ahead
of every event in about log2(2 n) joins on the event, however deep the tree is.  The difference between the two
events of a node is its whole subtree, and the events' order numbers the nodes so that "is below" is an interval.

Siblings are ranked by ranges (see ``ranking``), so a parent with very many children fills no task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterloom.operators.ranking import even_bucket, with_rank
from rosterloom.operators.sides import bounded_or_merged, null_safe_join
from rosterloom.sources.staging import materialize, relay


def _successors(nodes: DataFrame, sums: Sequence[str]) -> tuple[DataFrame, int]:
    """(event, next, what an event counts) and the number of nodes; event is 2 node, and 2 node + 1 for the way up.

    A parent that is no node itself is taken as none, so its children are roots.
    """
    given = materialize(nodes.select(F.col("node").cast("bigint").alias("node"), F.col("parent").cast("bigint").alias("parent"), *sums))
    total, distinct = given.agg(F.count("node"), F.count_distinct("node")).first()
    if total != distinct or given.where(F.col("node").isNull()).count():
        raise ValueError("nodes must be distinct and not null")
    known = given.select(F.col("node").alias("parent"), F.lit(1).alias("_known"))
    rooted = given.join(known, "parent", "left").withColumn("parent", F.when(F.col("_known").isNotNull(), F.col("parent"))).drop("_known")
    placed = materialize(with_rank(rooted, "_place", ["node"], even_bucket(rooted, "node"), ["parent"]))
    siblings = placed.select("parent", (F.col("_place") - 1).alias("_place"), F.col("node").alias("_sibling"))
    children = placed.where((F.col("_place") == 0) & F.col("parent").isNotNull()).select(F.col("parent").alias("node"), F.col("node").alias("_child"))
    with_next = null_safe_join(placed, siblings, ["parent", "_place"], "left").join(children, "node", "left")
    down, up = F.col("node") * 2, F.col("node") * 2 + 1
    after_up = F.coalesce(F.col("_sibling") * 2, F.col("parent") * 2 + 1)
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    there = F.struct(down.alias("event"), F.coalesce(F.col("_child") * 2, up).alias("next"), one.alias("_n"), one.alias("_d"), *sums)
    back = F.struct(up.alias("event"), after_up.alias("next"), none.alias("_n"), (-one).alias("_d"), *[none.alias(c) for c in sums])
    return with_next.select(F.inline(F.array(there, back))), total


def _further(ahead: DataFrame, counts: Sequence[str], rows: int) -> DataFrame:
    """Every event twice as far along: its next is its next one's, and counts are added up.

    Events that have reached the end stay as they are.  In a join their empty key would send them all to one task.
    """
    there = ahead.where(F.col("next").isNotNull())
    reached = ahead.select(F.col("event").alias("next"), F.col("next").alias("_next"), *[F.col(c).alias(f"_ahead{c}") for c in counts])
    moved = there.join(bounded_or_merged(reached, rows), "next").select(
        "event", F.col("_next").alias("next"), *[(F.col(c) + F.col(f"_ahead{c}")).alias(c) for c in counts]
    )
    return ahead.where(F.col("next").isNull()).select("event", "next", *counts).unionByName(moved)


def tour(nodes: DataFrame, sums: Sequence[str] = (), node: str = "node", parent: str = "parent") -> DataFrame:
    """(node, first, last, depth, size, and the subtree total of each BIGINT column in ``sums``).

    ``first`` numbers the nodes from 0 depth-first, siblings and roots by their ids; ``last`` is the largest ``first`` in the
    subtree.  A null to be summed counts as 0.  A cycle is an error.
    """
    amounts = [F.coalesce(F.col(c).cast("bigint"), F.lit(0).cast("bigint")).alias(f"_sum_{c}") for c in sums]
    added = [f"_sum_{c}" for c in sums]
    events, total = _successors(nodes.select(F.col(node).alias("node"), F.col(parent).alias("parent"), *amounts), added)
    counts = ["_n", "_d", *added]
    side = F.col("event").bitwiseAND(F.lit(1)) == 0
    with relay(nodes.sparkSession, "tour") as keep:
        ahead = keep(events)
        for _ in range((2 * total - 1).bit_length() if total else 0):
            ahead = keep(_further(ahead, counts, 2 * total))
        if ahead.where(F.col("next").isNotNull()).count():
            raise ValueError("the parents form a cycle")
        pairs = materialize(
            ahead.groupBy(F.shiftright("event", 1).alias("node")).agg(
                *[F.max(F.when(on, F.col(c))).alias(f"{name}{c}") for c in counts for name, on in (("in", side), ("out", ~side))]
            )
        )
    # Counted from the end: what lies ahead of the first event, less what lies ahead of this one, lies before it.
    size = (F.col("in_n") - F.col("out_n")).cast("bigint")
    first = F.lit(total).cast("bigint") - F.col("in_n")
    return pairs.select(
        "node", first.alias("first"), (first + size - 1).alias("last"), (F.lit(0).cast("bigint") - F.col("in_d") + 1).alias("depth"),
        size.alias("size"), *[(F.col(f"in_sum_{c}") - F.col(f"out_sum_{c}")).alias(c) for c in sums],
    )


def is_below(first: Column, upper_first: Column, upper_last: Column) -> Column:
    """Whether a node with that number lies in the subtree of another, itself included."""
    return first.between(upper_first, upper_last)
