"""Connected components by alternating large-star and small-star.

Both steps keep the components and only ever link nodes to smaller ones; they are done when every
node links down to one node, which links no further: then it is the smallest of its component. Each step is a grouped minimum and a join
back. The minima are stored first, so that the join reads two plain tables and Spark can split a
node with very many links over tasks.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyscore.llm.store import store
from surveyscore.sources.sinks import drop_stored


def large_star(edges: DataFrame, used: list[DataFrame]) -> DataFrame:
    """Link each neighbour above a node to the least of the node and its neighbours.

    Tables that the result reads are added to ``used``, here and below.
    """
    both = edges.union(edges.select("b", "a")).toDF("a", "b")
    least = store(both.groupBy("a").agg(F.min("b").alias("least")).where("least < a"), "large-star")
    used.append(least)
    return (both.where("b > a").join(least, "a", "left")
            .select(F.col("b").alias("a"), F.coalesce("least", "a").alias("b")))


def small_star(edges: DataFrame, used: list[DataFrame]) -> DataFrame:
    """Link each node, and its neighbours below it, to the least of those."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = store(down.groupBy("a").agg(F.min("b").alias("least"), F.count("*").alias("n")), "small-star")
    used.append(least)
    rest = down.join(least.where("n > 1").select("a", "least"), "a").where("b != least").select("b", "least")
    return least.select("a", F.col("least").alias("b")).union(rest.toDF("a", "b"))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest node reachable from each node that has a link to another.

    Returns a stored table (node, component). Loops, repeated links and nulls are dropped; a node
    without other links has no row, the smallest of a component has none either. Tables of a step
    are dropped once the next is written.
    """
    found = store(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a != b").distinct(), "edges")
    while not settled(found):
        used = [found]
        found = store(small_star(large_star(found, used), used).distinct(), "edges")
        drop(*used)
    return found.select(F.col("a").alias("node"), F.col("b").alias("component"))


def drop(*stored: DataFrame) -> None:
    for table in stored:
        drop_stored(table)


def settled(edges: DataFrame) -> bool:
    """Whether every node links down to one node only, and none links to a node that links on."""
    roots = edges.groupBy("a").agg(F.min("b").alias("b"), F.count("*").alias("n"))
    on = roots.select(F.col("a").alias("b")).distinct()
    return roots.where("n > 1 or b >= a").isEmpty() and roots.join(on, "b", "left_semi").isEmpty()


def least_reached(n: int, links: np.ndarray) -> np.ndarray:
    """Least node that each of ``n`` nodes reaches by the links."""
    label = np.arange(n)
    while len(links):
        a, b = label[links[:, 0]], label[links[:, 1]]
        low, high = np.minimum(a, b), np.maximum(a, b)
        if (low == high).all():
            break
        np.minimum.at(label, high, low)
        while (label[label] != label).any():
            label = label[label]
    return label


def name_rows(members: DataFrame, classes: DataFrame, links: DataFrame, extra: tuple[str, ...] = (),
              keep: tuple[str, ...] = ()) -> DataFrame:
    """The component of each row, named by the least id in it.

    ``members``: stored rows (id, h, g), where h and g name a row's class, or are null in a row
    that links with nothing. ``classes``: stored (h, g, cid, id), id the least of its rows, and the
    columns ``extra``. ``links``: (a, b) between cids; rows that share an id link their classes.
    Returns (id, component_id, kept), ``extra`` and the members' columns ``keep``.
    """
    held = store(members.where("h is not null").join(classes.select("h", "g", "cid"), ["h", "g"])
                 .select("id", "cid").distinct(), "held")
    least = store(held.groupBy("id").agg(F.min("cid").alias("b"), F.count("*").alias("n")).where("n > 1"), "shared-ids")
    shared = held.join(least, "id").select(F.col("cid").alias("a"), "b")
    found = connected_components(links.select("a", "b").union(shared))
    rooted = store(classes.join(found, F.col("cid") == F.col("node"), "left").select(
        "h", "g", "id", F.coalesce("component", "cid").alias("root"), *extra), "rooted")
    drop(held, least, found)
    least = store(rooted.groupBy("root").agg(F.min("id").alias("component_id")), "least")
    named = store(rooted.join(least, "root").select("h", "g", "component_id", *extra), "named")
    drop(rooted, least)
    component = F.coalesce("component_id", "id")
    return members.join(named, ["h", "g"], "left").select(
        "id", component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
        *extra, *keep)
