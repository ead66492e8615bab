"""What several operators of this subpackage need: lineage cuts and components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velocast.session import cut_lineage


def keep(df: DataFrame) -> DataFrame:
    """``df`` computed once, in the shared checkpoint folder (survives lost executors)."""
    return cut_lineage(df)


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Column names like ``wanted`` that do not clash with a column of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for w in wanted:
        while w.lower() in taken:
            w = "_" + w
        taken.add(w.lower())
        out.append(w)
    return out


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"),
                  F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 200) -> DataFrame:
    """Connected components of an undirected graph: (node, root), root the least node.

    Alternating large-star and small-star rounds: every node points to the least
    node that it or a neighbour knows, until each component is one star.  The
    rounds grow with the logarithm of a component's size.  Each round is two
    aggregates and two equi-joins; a hub is combined map-side in the aggregate and
    its rows are split by AQE in the join, so no task holds a whole component.
    State is cut by a reliable checkpoint after each round.

    Nodes without an edge to another node are not returned.  Repeated edges, loops
    and nulls are ignored; an empty table gives an empty one.
    """
    x = (edges.select(F.col(a).alias("a"), F.col(b).alias("b"))
         .where("a is not null and b is not null and a <> b")
         .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    x = keep(x)
    before = _state(x)
    for _ in range(max_rounds):
        if not before[0]:
            break
        both = x.unionByName(x.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m"))
        large = (both.where("b > a").join(least, "a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        x = keep(small.select("a", F.col("m").alias("b"))
                 .unionByName(small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
                 .distinct())
        after = _state(x)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = x.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return x.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
