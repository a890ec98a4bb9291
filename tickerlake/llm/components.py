"""Connected components of a link table by alternating large and small stars (Kiveris et al.).

Every round is two grouped minima and a join over the edges; edges shrink to one
per node, from the node to its component's smallest node. Each round is stored,
so neither lineage nor a lost executor repeats earlier rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tickerlake.llm.common import stored

MOST_ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over (a, b)."""
    if large:
        around = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = around.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
    both = around.join(low, F.col("a") == F.col("n"))
    if large:
        out = both.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = both.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select(F.col("n").alias("a"), F.col("m").alias("b")))
    out = out.filter(F.col("a") != F.col("b"))
    return out if large else out.distinct()  # a large star's repeats go with the small star after it


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node on a link; the component is its smallest node."""
    edges = stored(edges.filter(F.col("a") != F.col("b")).select("a", "b").distinct(), "links")
    print_of = None
    for _ in range(MOST_ROUNDS):
        # Count and XOR of row hashes, taken while the round is written: equal tables
        # have equal prints whatever their order.
        seen = Observation()
        edges = _star(_star(edges, True), False).observe(
            seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"))
        edges = stored(edges, "stars")
        now = (seen.get["n"], seen.get["x"])
        if now == print_of:
            break
        print_of = now
    else:
        raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    low = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return low.union(low.select(F.col("component").alias("node"), "component").distinct())
