"""Connected components of a table of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import stored


def _toward_least(links: DataFrame, floor) -> DataFrame:
    """Per node ``u`` the least of its neighbours ``v`` (and of itself if ``floor``)."""
    least = F.least(F.min("v"), F.col("u")) if floor else F.min("v")
    return links.groupBy("u").agg(least.alias("m"))


def _is_forest_of_stars(pairs: DataFrame) -> bool:
    """Whether every ``u`` has one ``v`` and no ``v`` is a ``u``."""
    ends = pairs.select(
        F.inline(
            F.array(
                F.struct(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("root")),
                F.struct(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("root")),
            )
        )
    )
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("root").alias("root"))
    return nodes.agg(F.max(F.col("up") + F.col("root"))).first()[0] in (None, 1)


def connected_components(links: DataFrame) -> DataFrame:
    """Rows ``(node, component)`` of every linked node; the component is its least node.

    ``links`` is a stored table of two long columns ``u`` and ``v``. Self links
    and repeats do no harm; rows with a null end are ignored. Each round points
    every neighbour of a node to the least of them (large star, then small
    star), which only ever needs a least value per node, pre-aggregated before
    the shuffle, and a join that adaptive execution splits where one node has
    very many links. Each round is written to the shared folder; the driver sees
    one number.
    """
    pairs = links.filter("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    while not _is_forest_of_stars(pairs):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.join(_toward_least(both, True), "u")
            .filter("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        small = large.join(_toward_least(large, False), "u")
        pairs = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = pairs.unionByName(small.select("u", F.col("m").alias("v"))).distinct()
        pairs = stored(pairs, "links")
    members = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return members.unionByName(roots).distinct()
