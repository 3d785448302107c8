"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node it reaches) for every node of the links ``a``, ``b``.

    Each round connects the larger neighbours of a node to its smallest one, then
    the smaller ones, until nothing changes: about log(nodes) rounds, whatever the
    length of a chain.  Smallest neighbours are partial aggregates and the joins
    leave a hub to Spark's skew join; no neighbour list is ever collected.  Every
    round is a written table, so a lost executor costs one round.
    """
    edges = stored(
        links.selectExpr("greatest(a, b) as u", "least(a, b) as v").filter("u <> v").distinct(), "links"
    )
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.selectExpr("v as u", "u as v"))
        smallest = both.groupBy("u").agg(F.expr("least(u, min(v)) as m"))
        large = both.filter("v > u").join(smallest, "u").selectExpr("v as u", "m as v").distinct()
        smallest = large.groupBy("u").agg(F.expr("min(v) as m"))
        joined = large.join(smallest, "u")
        small = joined.selectExpr("v as u", "m as v").unionByName(smallest.selectExpr("u", "m as v"))
        edges = stored(small.filter("u <> v").distinct(), "links")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.selectExpr("u as node", "v as root").unionByName(edges.selectExpr("v as node", "v as root").distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.hash("v", "u"))).first())
