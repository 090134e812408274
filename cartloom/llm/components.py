"""Connected components of a graph given as a table of links."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.plans.staging import stage


def _priority(name: str, turn: int) -> Column:
    return F.struct(F.xxhash64(F.lit(turn), F.col(name)).alias("p"), F.col(name).alias("id"))


def components(links: DataFrame) -> DataFrame:
    """(id, root) for every id in links(a, b); ids of one component share their root.

    Each turn maps every id to the neighbour, or itself, of smallest hash and applies
    that map to the links. The hash differs by turn, so any graph, long paths too,
    shrinks by a constant share each time and a star collapses at once. Links and maps
    are tables in the shared folder; only an emptiness test reaches the driver.
    """
    turned = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    both = links.select("a", "b").unionAll(turned)
    links = stage(both.filter("a <> b").distinct(), "links")
    roots, turn = links.select(F.col("a").alias("id"), F.col("a").alias("root")).limit(0), 0
    while not links.isEmpty():
        nearest = links.groupBy("a").agg(F.min(_priority("b", turn)).alias("near"))
        step = stage(
            nearest.select("a", F.least("near", _priority("a", turn))["id"].alias("to")), "step"
        )
        ends = step.select(F.col("a").alias("b"), F.col("to").alias("b_to"))
        if turn == 0:
            roots = step.select(F.col("a").alias("id"), F.col("to").alias("root"))
        else:
            onward = step.select(F.col("a").alias("root"), "to")
            roots = roots.join(onward, "root", "left").select(
                "id", F.coalesce("to", "root").alias("root")
            )
        links = stage(
            links.join(step, "a")
            .join(ends, "b")
            .filter("to <> b_to")
            .select(F.col("to").alias("a"), F.col("b_to").alias("b"))
            .distinct(),
            "links",
        )
        turn += 1
    return roots
