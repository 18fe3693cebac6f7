"""Join helpers: broadcast behind a size check, and skew-safe pairing inside groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest side we hint as broadcast, in rows and in bytes of its values, both
# measured.  Above either the join stays a shuffle join and AQE decides from
# measured stage sizes.
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 << 20

# Rows of one group handled by one task in a pairing join; larger groups are
# split into ceil(n / PAIR_BUCKET_ROWS) buckets.
PAIR_BUCKET_ROWS = 512


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Hint ``df`` for broadcast only if it has at most ``max_rows`` rows and
    ``MAX_BROADCAST_BYTES`` bytes of values.

    The check reads at most ``max_rows + 1`` rows (the limit stops the scan).
    """
    width = sum((F.coalesce(F.octet_length(F.col(f.name).cast("string")), F.lit(0)) + 8
                 for f in df.schema.fields), F.lit(8))
    n, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return F.broadcast(df) if n <= max_rows and size <= MAX_BROADCAST_BYTES else df


def pairs_within_groups(items: DataFrame, group: str, key: str,
                        bucket_rows: int = PAIR_BUCKET_ROWS, left_where=None) -> DataFrame:
    """All ordered pairs (left, right) of rows that share ``group``, the left ones
    limited to rows of ``left_where`` (a condition on ``items``) if it is given.

    ``items`` must already be reduced to distinct rows per (group, key), so a
    group's size is bounded by its distinct keys, not by the raw rows.  Groups
    with more than ``bucket_rows`` rows are split: the left rows of such a group
    are spread over ``b = ceil(n / bucket_rows)`` salt buckets and the right
    rows are copied to every bucket, so each task pairs at most
    ``bucket_rows * n`` rows instead of ``n * n``.  Small groups keep one bucket
    and no copies.  Output columns: group, then ``l_<col>`` and ``r_<col>`` for
    every other column of ``items``.
    """
    other = [c for c in items.columns if c != group]
    # The reduced items feed four plans (sizes, the size check, both sides);
    # write them once to the shared checkpoint folder instead of recomputing
    # the upstream joins for each.
    items = items.checkpoint(eager=True)
    sizes = items.groupBy(group).agg(F.count(F.lit(1)).alias("__tm_n"))
    hot = (sizes.where(F.col("__tm_n") > bucket_rows)
                .select(group, F.ceil(F.col("__tm_n") / bucket_rows).cast("int").alias("__tm_b")))
    hot = broadcast_if_small(hot)
    tagged = (items.join(hot, group, "left")
                   .withColumn("__tm_b", F.coalesce("__tm_b", F.lit(1))))
    left = (tagged if left_where is None else tagged.where(left_where)).select(
        group,
        F.pmod(F.xxhash64(F.col(key)), F.col("__tm_b")).cast("int").alias("__tm_salt"),
        *[F.col(c).alias(f"l_{c}") for c in other])
    right = tagged.select(
        group,
        F.explode(F.sequence(F.lit(0), F.col("__tm_b") - 1)).alias("__tm_salt"),
        *[F.col(c).alias(f"r_{c}") for c in other])
    return left.join(right, [group, "__tm_salt"]).drop("__tm_salt")


def ensure_parallelism(df: DataFrame) -> DataFrame:
    """Split ``df`` over all task slots when it has fewer input partitions than
    slots (a planning-time check, no job).  On a cluster reading many files the
    partitions already outnumber the slots and nothing is shuffled; on a few
    large files CPU-heavy row work (tokenising whole texts) gets every core.

    Meant for scans: on a plan that contains a shuffle, asking for the
    partition count makes adaptive execution run the upstream stages.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < slots:
        return df.repartition(slots)
    return df
