"""Connected components of links that are a table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def connected_components(edges: DataFrame, folder: str) -> DataFrame:
    """node and component (its smallest node) of every node of the links a, b.

    Each round points every node to its smallest neighbour, if that is smaller, shortens the pointers,
    and contracts the links; what remains is links between different groups. Groups shrink at least as
    fast as the pointers merge, so a few rounds do. Only sums and joins are used, so a node with very
    many links is no large group. Every round is written to `folder`, so nothing is worked out twice and
    a lost executor costs one round.
    """
    spark = edges.sparkSession

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    def simple(pairs: DataFrame) -> DataFrame:
        return (
            pairs.where("a <> b")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .distinct()
        )

    links = stored(simple(edges), "links0")
    labels, turn = None, 0
    while not links.isEmpty():
        turn += 1
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = stored(
            both.groupBy("a").agg(F.min("b").alias("to")).select(F.col("a").alias("node"), F.least("a", "to").alias("to")),
            f"parents{turn}",
        )
        for step in (1, 2):  # pointers to the pointers' targets; a target without links points to itself
            p, q = parents.alias("p"), parents.alias("q")
            parents = stored(
                p.join(q, F.col("p.to") == F.col("q.node"), "left").select(
                    "p.node", F.coalesce("q.to", "p.to").alias("to")
                ),
                f"parents{turn}_{step}",
            )
        a, b = parents.alias("a"), parents.alias("b")
        links = stored(
            simple(
                links.alias("l")
                .join(a, F.col("l.a") == F.col("a.node"))
                .join(b, F.col("l.b") == F.col("b.node"))
                .select(F.col("a.to").alias("a"), F.col("b.to").alias("b"))
            ),
            f"links{turn}",
        )
        if labels is None:
            labels = parents.select("node", F.col("to").alias("component"))
        else:
            labels = stored(
                labels.alias("l")
                .join(parents.alias("p"), F.col("l.component") == F.col("p.node"), "left")
                .select("l.node", F.coalesce("p.to", "l.component").alias("component")),
                f"labels{turn}",
            )
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
