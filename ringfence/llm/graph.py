"""Distributed union-find over edge lists.

Alternating large-star and small-star steps: every step is an aggregate and an
equality join on the node, so a node with millions of neighbours is one row of
the aggregate and a join key that adaptive execution can split.  The edges are
cut from their lineage with a reliable checkpoint after each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, shared_path


def stable(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: smaller on disk than a checkpoint."""
    path = shared_path(df.sparkSession, name, unique=True)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.parquet(path)


def _lowest(pairs: DataFrame, with_self: bool) -> DataFrame:
    low = F.min("v")
    return pairs.groupBy("u").agg((F.least(F.col("u"), low) if with_self else low).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (both.where("v > u").join(_lowest(both, True), "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = _lowest(down, False)
    moved = down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an edge of ``edges``; root is the smallest node it reaches.

    Self-loops, repeated edges and edges in either direction are allowed; edges
    with a null end are left out; no edges give an empty table.
    """
    cur = stable(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                 .where("u <> v and u is not null and v is not null").distinct())
    seen = None
    while True:
        mark = cur.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if mark == seen or mark[0] == 0:
            break
        seen = mark
        cur = stable(_small_star(_large_star(cur)))
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
