"""Backward as-of match of two event tables, and newest-per-group picks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

HOUR_MS = 3_600_000


def asof_backward(left: DataFrame, right: DataFrame, by: Sequence[str], left_ms: str, right_ms: str,
                  right_columns: Sequence[str], right_seq: str, bucket_ms: int = HOUR_MS) -> DataFrame:
    """For each left row, the latest right row with ``right_ms <= left_ms`` in the same group.

    Columns of the match come back as a struct ``match`` (NULL when there is none);
    ties on the time go to the greatest ``right_seq``. No range join: both tables are
    interleaved on a timeline. The timeline is cut into time buckets, so that a feed
    holding a large part of all rows is spread over many tasks, and the newest right
    row of earlier buckets is carried in from a table with one row per bucket.
    """
    by = list(by)
    payload = F.struct(F.col(right_ms).alias("_ms"), F.col(right_seq).alias("_seq"),
                       *[F.col(c) for c in right_columns])
    r = right.select(*by, F.col(right_ms).alias("_t"), payload.alias("_r")).withColumn(
        "_bucket", F.floor(F.col("_t") / bucket_ms)
    )
    l = left.withColumn("_t", F.col(left_ms)).withColumn("_bucket", F.floor(F.col("_t") / bucket_ms))
    lcols = [c for c in left.columns if c not in by]
    row = F.struct(*[F.col(c) for c in lcols])
    # Buckets of either side, each with the newest right row inside it.
    newest = r.groupBy(*by, "_bucket").agg(F.max("_r").alias("_newest"))
    spine = newest.unionByName(l.select(*by, "_bucket").distinct(), allowMissingColumns=True).groupBy(
        *by, "_bucket"
    ).agg(F.max("_newest").alias("_newest"))
    earlier = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = spine.select(*by, "_bucket", F.last("_newest", ignorenulls=True).over(earlier).alias("_carry"))
    events = r.select(*by, "_bucket", "_t", F.lit(0).alias("_kind"), "_r").unionByName(
        l.select(*by, "_bucket", "_t", F.lit(1).alias("_kind"), row.alias("_l")), allowMissingColumns=True
    )
    upto = Window.partitionBy(*by, "_bucket").orderBy("_t", "_kind", "_r").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    inside = events.withColumn("_in", F.last("_r", ignorenulls=True).over(upto)).where("_kind = 1")
    joined = inside.join(carry, [*by, "_bucket"], "left")
    match = F.coalesce("_in", "_carry")
    return joined.select(
        *by, *[F.col(f"_l.`{c}`").alias(c) for c in lcols],
        F.when(match.isNotNull(), F.struct(
            match["_ms"].alias(right_ms), *[match[c].alias(c) for c in right_columns]
        )).alias("match"),
    )


def newest_per_group(df: DataFrame, by: Sequence[str], order: Sequence[str], n: int = 1) -> DataFrame:
    """The n newest rows per group; Spark cuts each task to n per group before the shuffle."""
    w = Window.partitionBy(*by).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
