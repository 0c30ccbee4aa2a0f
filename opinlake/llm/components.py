"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinlake.session import delete_path, scratch_path


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and root (the smallest node that it reaches) of every node with an edge.

    Alternates two star steps until nothing changes: every node hangs its larger neighbours
    below its smallest one, then its smaller ones. The number of edges does not grow, paths
    halve, and each step is an aggregate of minima (combined on the map side) and a join in
    which only the side of the edges can be skewed. Each round is a written table; the one
    before it is deleted.
    """
    high, low = F.greatest(a, b).alias("high"), F.least(a, b).alias("low")
    current, path = _store(edges.where(F.col(a) != F.col(b)).select(high, low).distinct())
    state = _state(current)
    while state[0]:
        following, next_path = _store(_small_star(_large_star(current)))
        delete_path(current.sparkSession, path)
        before, state = state, _state(following)
        current, path = following, next_path
        if state == before:
            break
    roots = current.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct()
    return current.select(F.col("high").alias("node"), F.col("low").alias("root")).union(roots)


def _store(df: DataFrame) -> tuple[DataFrame, str]:
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "components")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def _state(edges: DataFrame) -> tuple:
    hashed = F.xxhash64("high", "low").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(hashed)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours go below the smallest node around."""
    both = edges.select(F.col("high").alias("u"), F.col("low").alias("v")).union(
        edges.select(F.col("low").alias("u"), F.col("high").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select(F.col("u").alias("at"), F.least("u", "m").alias("m"))
    up = both.where("v > u").join(least, F.col("u") == F.col("at"))
    return up.select(F.col("v").alias("high"), F.col("m").alias("low")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours, and the node itself, go below the smallest of them."""
    least = edges.groupBy("high").agg(F.min("low").alias("m"))
    least = least.select(F.col("high").alias("at"), "m")
    down = edges.join(least, F.col("high") == F.col("at")).where("low > m")
    down = down.select(F.col("low").alias("high"), F.col("m").alias("low"))
    return down.union(least.select(F.col("at").alias("high"), F.col("m").alias("low"))).distinct()
