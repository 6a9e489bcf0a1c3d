"""Shared helpers: scratch paths, column names, connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..streaming.tables import shared_root, stored


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/ledgerstream-{uuid.uuid4().hex[:12]}/{name}"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """``name``, or a like name that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def connected_components(edges: DataFrame, name: str = "components", max_rounds: int = 60) -> DataFrame:
    """Components of undirected ``edges (u, v)`` of any type that can be ordered, as ``(node, root)``, root the least node reachable.

    Alternating large-star and small-star rounds; each round is written to the shared folder. Nodes without an
    edge to another node are absent. Minima are aggregated map-side before each shuffle and joined back, so a hub
    with a large share of all edges is split by adaptive skew handling rather than gathered in one task.
    """
    e = stored(edges.where("u is not null and v is not null and u <> v").selectExpr("greatest(u, v) u", "least(u, v) v").distinct(), f"{name}-0")
    mark = None
    for i in range(1, max_rounds + 1):
        both = e.union(e.selectExpr("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) m")
        large = both.join(low, "u").where("v > u").selectExpr("v as u", "m as v").where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").selectExpr("v as u", "m as v").where("u <> v").union(low.selectExpr("u", "m as v"))
        e = stored(small.distinct(), f"{name}-{i}")
        now = e.agg(F.count("*"), F.sum(F.expr("xxhash64(u, v) div 1048576"))).first()
        if now == mark:
            return e.selectExpr("u as node", "v as root")
        mark = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
