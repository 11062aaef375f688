"""Connected components of a table of links, by alternating large and small stars.

Each round points every node nearer to the least node of its component; links only ever shrink in
number, and every round is written to the shared folder, so a lost executor re-reads files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.steps import Steps


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("low"))
    least = least.select("u", F.least("u", "low").alias("low"))
    return both.where("b > a").join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.where("b < a")
    least = down.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("low"))
    moved = down.join(least, F.col("a") == F.col("u")).where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(least.select("u", "low")).where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, component (its least node) for every node of the links (a, b)."""
    steps = Steps(links.sparkSession)
    now = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    now, mark, turn = steps.keep(now, "round-0"), None, 0
    while True:
        # A fingerprint of the whole round: one row.
        found = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(found) == mark or not found[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct())
        mark, turn = tuple(found), turn + 1
        large = steps.keep(_large_star(now).distinct(), "large-star")
        now = steps.keep(_small_star(large), f"round-{turn}")
        steps.drop("large-star", f"round-{turn - 1}")
