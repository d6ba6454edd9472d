"""Connected components over an edge table (union-find re-expressed as rounds)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.session import settle, shared_dir


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 200) -> DataFrame:
    """(id, component) for every vertex of ``edges``; component = smallest id reachable.

    Randomised contraction: in each round every vertex hooks to the vertex of
    smallest random priority among itself and its neighbours, edges are
    relabelled and de-duplicated, and the rest goes on. Priorities hold for two
    rounds: in the first a star's hub hooks to its smallest leaf, in the second
    all others do, so a star of millions is gone after two. As every other round
    draws anew, the expected number of edges falls geometrically, whatever the
    shape (a path too).
    Minima are aggregated map-side, and the joins are plain equi-joins, which
    AQE splits when one component is hot. Rounds are cut by checkpoint(), so a
    lost executor never replays them; after every second round the driver gives
    back what rounds left. Edges with a null end or equal ends are
    ignored; an empty table gives an empty result.
    """
    shared_dir(edges.sparkSession)
    e = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a != b")
    e = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct().checkpoint()
    labels = e.select(F.col("a").alias("id"), F.col("a").alias("rep")).distinct()
    for turn in range(max_rounds):
        if e.isEmpty():
            break

        def ranked(c: Column, turn: int = turn) -> Column:
            return F.struct(F.xxhash64(F.lit(turn // 2), c).alias("h"), c.alias("v"))

        hook = e.groupBy("a").agg(F.min(ranked(F.col("b"))).alias("m"))
        hook = hook.select("a", F.least("m", ranked(F.col("a"))).getField("v").alias("to")).checkpoint()
        left = hook.select(F.col("a").alias("rep"), F.col("to").alias("next"))
        labels = labels.join(left, "rep", "left").select("id", F.coalesce("next", "rep").alias("rep")).checkpoint()
        e = e.join(hook, "a").select(F.col("to").alias("a0"), "b")
        e = e.join(hook.select(F.col("a").alias("b"), F.col("to").alias("b0")), "b")
        e = e.select(F.col("a0").alias("a"), F.col("b0").alias("b")).where("a != b").distinct().checkpoint()
        if turn % 2:
            settle(edges.sparkSession)
    else:
        raise RuntimeError("connected components did not settle")
    least = labels.groupBy("rep").agg(F.min("id").alias("component"))
    return labels.join(least, "rep").select("id", "component")
