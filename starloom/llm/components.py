"""Connected components of a graph whose edges do not fit one task."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.session import materialize


def _ordered(a, b) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges`` (two bigint columns ``a`` and ``b``).

    ``component`` is the smallest node that can be reached. Repeated edges and
    edges from a node to itself do no harm; rows with a NULL end are ignored. An
    empty input gives an empty result.

    Randomised contraction: in each round every node hooks to whichever of
    itself and its neighbours has the smallest hash, then the edges are rewritten
    to the hooked nodes. A constant share of the nodes vanishes per round
    whatever the shape of the graph, so paths and stars take a logarithmic
    number of rounds. The hash takes the round as seed; reruns agree. The hook of
    a node is a map-side combined minimum, so a hub's neighbours never meet in
    one task. Every round is written to the shared folder: a lost executor
    costs its tasks, not the rounds before.
    """
    a, b = F.col("a"), F.col("b")
    edges = materialize(edges.where(a != b).select(*_ordered(a, b)).distinct(), "edges")
    rounds: list[DataFrame] = []
    for seed in count():
        if edges.isEmpty():
            break
        hashed = lambda c, seed=seed: F.xxhash64(F.lit(seed), c)
        both = edges.select("a", "b").unionAll(edges.select(b.alias("a"), a.alias("b")))
        best = both.groupBy("a").agg(F.min(F.struct(hashed(b).alias("h"), b.alias("v"))).alias("m"))
        own = F.struct(hashed(a).alias("h"), a.alias("v"))
        hooks = materialize(best.select(a.alias("node"), F.least(own, F.col("m"))["v"].alias("root")), "hooks")
        rounds.append(hooks)
        of_a = hooks.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        of_b = hooks.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        moved = edges.join(of_a, "a").join(of_b, "b").where("ra <> rb")
        edges = materialize(moved.select(*_ordered(F.col("ra"), F.col("rb"))).distinct(), "edges")
    if not rounds:
        return edges.select(a.alias("node"), b.alias("component"))
    labels = rounds[-1]
    for hooks in reversed(rounds[:-1]):
        onward = labels.select(F.col("node").alias("root"), F.col("root").alias("last"))
        labels = materialize(
            hooks.join(onward, "root", "left").select("node", F.coalesce("last", "root").alias("root")), "labels"
        )
    smallest = materialize(labels.groupBy("root").agg(F.min("node").alias("component")), "smallest")
    return labels.join(smallest, "root").select("node", "component")
