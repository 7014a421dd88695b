"""Random choices that repeat for the same seed, on any partitioning and after a lost task."""

from pyspark.sql import functions as F


def _digest(keys, seed):
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.col(k).cast("string") for k in keys)))


def pick_one(df, keys, seed=0):
    """One row by hashed order; nothing from an empty table."""
    return df.orderBy(_digest(keys, seed), *keys).limit(1)


def sample_rows(df, keys, fraction, seed=0):
    """Keep each row with probability ``fraction``, without replacement."""
    draw = F.conv(F.substring(_digest(keys, seed), 1, 8), 16, 10).cast("bigint")
    return df.where(draw < int(fraction * 2**32))
