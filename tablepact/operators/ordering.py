"""File order without a global window.

``_ord`` is the row's position: a bigint, or the (file, offset, sequence) struct of
a CSV scan. Windows run inside buckets of consecutive positions, and a second one
runs over one edge row per bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ORD = "_ord"
BUCKET_ROWS = 1 << 20


def order_bucket(df: DataFrame, rows: int = BUCKET_ROWS) -> Column:
    """Bucket of consecutive positions; at most ``rows`` distinct positions each."""
    if isinstance(df.schema[ORD].dataType, T.StructType):
        return F.struct(
            F.col(f"{ORD}.file").alias("file"), F.col(f"{ORD}.start").alias("start"),
            F.floor(F.col(f"{ORD}.seq") / rows).alias("part"),
        )
    return F.floor(F.col(ORD) / rows)


def keep_first(df: DataFrame, key: Sequence[str], order: str = ORD) -> DataFrame:
    """First row per key in file order. The minimum combines map-side, so a hot key is one row per task."""
    rest = [c for c in df.columns if c not in key and c != order]
    return df.groupBy(*key).agg(F.min(F.struct(F.col(order), *[F.col(c) for c in rest])).alias("_f")).select(
        *key, *[F.col(f"_f.`{c}`").alias(c) for c in [order, *rest]]
    )


def distinct_rows(df: DataFrame, order: str = ORD) -> DataFrame:
    """Distinct on all columns; each survivor keeps its first position."""
    cols = [c for c in df.columns if c != order]
    return df.groupBy(*cols).agg(F.min(order).alias(order)).select(*df.columns)


def order_breaks(df: DataFrame, by: Sequence[str], value: Column, rows: int = BUCKET_ROWS) -> DataFrame:
    """Where ``value`` stops ascending, per group.

    ``(by..., rows, first_break, first_null)``: 1-based positions of the first value
    below its predecessor and of the first NULL; NULL when there is none.
    """
    by = list(by)
    base = df.select(*by, F.col(ORD), order_bucket(df, rows).alias("_b"), value.alias("_v"))
    w = Window.partitionBy(*by, "_b").orderBy(ORD)
    inside = base.select(
        *by, "_b", ORD, "_v", F.row_number().over(w).alias("_rn"), F.lag("_v").over(w).alias("_prev")
    )
    edges = inside.groupBy(*by, "_b").agg(
        F.count(F.lit(1)).alias("_n"),
        F.min(F.when(F.col("_v") < F.col("_prev"), F.col("_rn"))).alias("_break"),
        F.min(F.when(F.col("_v").isNull(), F.col("_rn"))).alias("_null"),
        F.min(F.when(F.col("_rn") == 1, F.col("_v"))).alias("_first"),
        F.max_by("_v", "_rn").alias("_last"),
    )
    # One row per bucket from here on.
    g = Window.partitionBy(*by).orderBy("_b")
    placed = edges.select(
        *by, "_n", "_null", "_first", "_break",
        F.coalesce(F.sum("_n").over(g.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.lag("_last").over(g).alias("_prev_last"),
    )
    at = F.when(F.col("_first") < F.col("_prev_last"), F.lit(1)).otherwise(F.col("_break"))
    return placed.groupBy(*by).agg(
        F.sum("_n").alias("rows"),
        F.min(F.col("_before") + at).alias("first_break"),
        F.min(F.col("_before") + F.col("_null")).alias("first_null"),
    )


def sort_by_key(df: DataFrame, key: Column, order: str = ORD) -> DataFrame:
    """Ascending by key, unparseable keys last, ties in file order; ``_ord`` becomes the new position."""
    return df.orderBy(key.asc_nulls_last(), F.col(order)).withColumn(order, F.monotonically_increasing_id())
