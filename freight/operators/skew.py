"""Joins on a key some of whose values hold a large part of all rows.

One count finds the hot keys.  Their rows on one side are spread over several salts, and the rows they meet on the other
side are repeated once for each salt, for those keys only.  Joined on key and salt the rows are the same as joined on the
key, but no task gets all rows of a hot key, whether the tables are shuffled or stored in buckets.  Adaptive
execution does the same for a shuffled join; it cannot for buckets, which have no shuffle to split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freight.contract import KEY

#: Column that holds the salt: 0 for all rows of a key that is not hot.
SALT = "salt"


def hot_keys(df: DataFrame, key: str = KEY, parts: int | None = None) -> DataFrame:
    """Keys that hold more than one of ``parts`` equal parts of the keyed rows, and over how many ``salts`` to spread each.

    There are fewer than ``parts`` such keys, so the result may be broadcast; by default ``parts`` is the session's number
    of shuffle partitions.  Copies are merged before the shuffle.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.where(F.col(key).isNotNull())
    counts = keyed.groupBy(key).agg(F.count("*").alias("n"))
    share = F.col("n") * parts / keyed.agg(F.count("*")).scalar()
    return counts.where(share > 1).select(key, F.ceil(share).cast("int").alias("salts"))


def spread(df: DataFrame, hot: DataFrame, key: str = KEY) -> DataFrame:
    """``df`` with a column ``salt``: rows of a hot key get one after the other.

    The rows must come from stored files, so that a repeated task finds them in the same order.
    """
    salts = df.join(F.broadcast(hot), key, "left")
    salt = F.when(F.col("salts").isNull(), F.lit(0)).otherwise(F.pmod(F.monotonically_increasing_id(), F.col("salts")))
    return salts.select(*df.columns, salt.cast("int").alias(SALT))


def repeat_hot(df: DataFrame, hot: DataFrame, key: str = KEY) -> DataFrame:
    """``df`` with a column ``salt``: rows of a hot key once for each salt, all others once."""
    salts = df.join(F.broadcast(hot), key, "left")
    every = F.sequence(F.lit(0), F.coalesce(F.col("salts") - 1, F.lit(0)))
    return salts.select(*df.columns, F.explode(every).alias(SALT))


def join_salted(left: DataFrame, right: DataFrame, key: str = KEY, how: str = "inner") -> DataFrame:
    """``spread`` rows joined to ``repeat_hot`` rows; the salt stays, for the next join.

    ``how`` is inner or left: of the right side, rows without a match would come once for each salt.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    return left.join(right, [key, SALT], how)
