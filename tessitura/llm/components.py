"""Connected components of a link table, by repeated hooking and contraction.

Each round hooks every node to its least neighbour, follows those pointers twice and replaces each link by the link
of its ends' parents. Nodes that touch only links inside one tree vanish, so the links left fall by a constant factor a
round. Minima are aggregated map-side: no node's neighbours are ever gathered, however many it has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def connected_components(links: DataFrame, max_rounds: int = 64) -> DataFrame:
    """links(u, v) to (node, root), one row for each node with a link to another; root names the component.

    Self links and repeated links are harmless; null ends are ignored. No links give no rows.
    """
    edges = materialize(links.where("u <> v").select("u", "v").union(links.where("u <> v").select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "links")
    mapping = None
    for _ in range(max_rounds):
        if edges.isEmpty():
            break
        parent = materialize(edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("p")), "parents")
        for _ in range(2):
            up = parent.select(F.col("u").alias("p"), F.col("p").alias("pp"))
            parent = materialize(parent.join(up, "p").select("u", F.col("pp").alias("p")), "parents")
        if mapping is None:
            mapping = parent.select(F.col("u").alias("node"), F.col("p").alias("root"))
        else:
            step = parent.select(F.col("u").alias("root"), "p")
            mapping = materialize(mapping.join(step, "root", "left").select("node", F.coalesce("p", "root").alias("root")), "roots")
        pu = parent.select("u", F.col("p").alias("pu"))
        pv = parent.select(F.col("u").alias("v"), F.col("p").alias("pv"))
        edges = materialize(edges.join(pu, "u").join(pv, "v").where("pu <> pv").select(F.col("pu").alias("u"), F.col("pv").alias("v")).distinct(), "links")
    else:
        raise RuntimeError(f"links remain after {max_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")) if mapping is None else mapping
