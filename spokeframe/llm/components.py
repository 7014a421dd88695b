"""Connected components of a table of links, by alternating large and small stars."""

from pyspark.sql import functions as F

from spokeframe.session import through_table


def _fingerprint(links):
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links):
    """``u, v`` links to ``node, root``, root being the least node of the component.

    Nodes that are their own root are not listed. Each round halves the paths, and every step is a
    grouped minimum, combined before the shuffle, and a join that adaptive execution splits where
    one node has most of the links. Each step is written to the shared folder.
    """
    ordered = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = through_table(ordered.distinct())
    mark = _fingerprint(now)
    while mark[0]:
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = through_table(large.where("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = through_table(small.union(least.select("u", F.col("m").alias("v"))).distinct())
        before, mark = mark, _fingerprint(now)
        if before == mark:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
