"""Connected components of a link table by alternating stars.

Large-star: every node hands each larger neighbour to the smallest node it
knows. Small-star: every node hands itself and its smaller neighbours to the
smallest of them. Both are one aggregate (minimum per node, combined before the
shuffle) and one join by node, where Spark splits a node with very many links.
After a logarithmic number of rounds every node points at the smallest node of
its component. Each round is written to the shared folder, so lineage stays
short; the driver sees two numbers per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import remove, written


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """links: distinct (a, b) with a > b."""
    if large:
        near = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        out = near.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = links.groupBy("a").agg(F.min("b").alias("m"))
        out = links.join(least, "a").select(F.explode(F.array(
            F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x")) \
            .select("x.a", "x.b")
    return out.filter("a > b").distinct()


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, component) for every node with a link; links are (a, b) of equal type, any order, repeats allowed.

    Null ends and links of a node to itself say nothing. No links: no rows.
    """
    links = links.filter("a is not null and b is not null and a <> b") \
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links, path = written(spark, links, "links")
    state = lambda df: tuple(df.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
    before = state(links)
    while before[0]:
        step, new = written(spark, _stars(_stars(links, large=True), large=False), "links")
        remove(spark, path)
        links, path = step, new
        after = state(links)
        if after == before:
            break
        before = after
    own = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return own.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
