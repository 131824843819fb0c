"""Connected components of a link table, by alternating stars.

Each round links every node's larger neighbours to the least node next to it, and then its smaller
ones; chains shorten by half, and hot nodes cost no more than their links, as a round only needs the
least neighbour of each node.  Rounds are written to the shared folder, so a lost executor costs one
round at most; the driver sees two numbers per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treadle.operators.sinks import drop_folder
from treadle.session import run_folder


def _stored(spark: SparkSession, links: DataFrame, before: str | None = None) -> tuple[DataFrame, str]:
    """Stored links and their folder; that of the round before goes."""
    folder = run_folder(spark, "links")
    links.write.parquet(folder)
    if before:
        drop_folder(spark, before)
    return spark.read.parquet(folder), folder


def _sum(links: DataFrame) -> tuple:
    r = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def _star(links: DataFrame, both: bool) -> DataFrame:
    """One star operation; ``links`` has a > b."""
    ends = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if both:
        ends = ends.unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = ends.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = ends.join(least, "u")
    if both:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the least node reachable) of every node but the roots; links: a, b long."""
    now, folder = _stored(spark, links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    before, seen = None, _sum(now)
    while seen != before:
        now, folder = _stored(spark, _star(_star(now, both=True), both=False), folder)
        before, seen = seen, _sum(now)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
