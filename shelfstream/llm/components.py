"""Connected components of a distributed edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from shelfstream.session import fresh_path


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The distinct edges as a table in the shared folder, with a fingerprint of the whole set."""
    spark, seen, path = edges.sparkSession, Observation(), fresh_path(edges.sparkSession, "edges")
    state = F.struct(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("node", "to").cast("decimal(38,0)")).alias("h"))
    edges.distinct().observe(seen, state.alias("state")).write.parquet(path)
    return spark.read.schema("node long, to long").parquet(path), tuple(seen.get["state"])


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (``node``, ``to``): root is the smallest node of its component.

    Each round links all larger neighbours of a node to its smallest one, then all smaller ones; rounds grow with the
    logarithm of the longest chain.  A star's centre is met by a join that adaptive execution can split; only minima
    are grouped, and those are folded before the shuffle.  Self-loops and null ends are left out.
    """
    table, state = _written(edges.select(F.greatest("node", "to").alias("node"), F.least("node", "to").alias("to"))
                            .filter("node is not null and to is not null and node <> to"))
    while state[0]:
        both = table.union(table.select("to", "node"))
        least = both.groupBy("node").agg(F.min("to").alias("m")).select("node", F.least("node", "m").alias("m"))
        large = (
            both.filter("to > node").join(least.hint("merge"), "node").select(F.col("to").alias("node"), F.col("m").alias("to")).distinct()
        )
        least = large.groupBy("node").agg(F.min("to").alias("m"))
        small = large.join(least.hint("merge"), "node").select(
            F.explode(F.array(F.struct(F.col("to").alias("node"), F.col("m").alias("to")), F.struct("node", F.col("m").alias("to")))).alias("e")
        ).select("e.node", "e.to").filter("node <> to")
        table, after = _written(small)
        if after == state:
            break
        state = after
    roots = table.select(F.col("to").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return table.select("node", F.col("to").alias("root")).union(roots)
