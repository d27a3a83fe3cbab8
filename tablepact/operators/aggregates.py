"""Aggregations shared by checks: shares, distances, duplicates, offenders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.numeric import log2_term
from ..functions.sql import array, lit, name
from ..sources.staging import materialize


def share_where(condition: str) -> str:
    """Share of rows where the predicate holds (NULL counts as false)."""
    return f"avg(CASE WHEN {condition} THEN 1.0D ELSE 0.0D END)"


def histogram(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Counts of present cells, long: ``(by..., column, value, n)``, in one shuffle for all columns."""
    cells = array(f"named_struct('column', {lit(c)}, 'value', CAST({name(c)} AS STRING))" for c in columns)
    return (
        df.select(*by, F.explode(F.expr(cells)).alias("_c")).select(*by, "_c.column", "_c.value")
        .where(X.is_present("value"))
        .groupBy(*by, "column", "value").agg(F.count(F.lit(1)).alias("n"))
    )


def shares(counts: DataFrame, by: Sequence[str], value: str = "value", n: str = "n") -> DataFrame:
    """Normalise a count table within ``by``: adds ``share``.

    Totals are one row per group. They are joined unhinted: AQE broadcasts them when
    they are small and splits the skewed side when they are not.
    """
    by = list(by)
    if not by:
        totals = counts.agg(F.sum(n).alias("_t")).scalar()
        return counts.withColumn("share", F.col(n) / totals)
    totals = counts.groupBy(*by).agg(F.sum(n).alias("_t"))
    return counts.join(totals, by).withColumn("share", F.col(n) / F.col("_t")).drop("_t")


def js_distance(a: DataFrame, b: DataFrame, by: Sequence[str], value: str = "value", share: str = "share") -> DataFrame:
    """Jensen-Shannon distance (base 2, square root) of two share tables per group.

    Both sides are tagged and summed per value, so there is no outer join and the
    work is one map-side combined aggregation. A group that only one side has gets 1.0.
    """
    by = list(by)
    both = a.select(*by, F.col(value).alias("_v"), F.col(share).alias("_p"), F.lit(0.0).alias("_q")).unionByName(
        b.select(*by, F.col(value).alias("_v"), F.lit(0.0).alias("_p"), F.col(share).alias("_q"))
    )
    per_value = both.groupBy(*by, "_v").agg(F.sum("_p").alias("_p"), F.sum("_q").alias("_q"))
    m = "(_p + _q) / 2"
    total = f"sum({log2_term('_p', m)} + {log2_term('_q', m)}) / 2"
    distance = f"CASE WHEN sum(_p) = 0 OR sum(_q) = 0 THEN 1.0D ELSE sqrt(greatest(0.0D, {total})) END"
    return per_value.groupBy(*by).agg(F.expr(distance).alias("js_distance"))


def row_hashes(columns: Sequence[str]) -> tuple[Column, Column]:
    """128 hash bits of a row. Cells are hashed one by one, NULL apart from empty text."""
    cells = ", ".join(f"{name(c)} IS NULL, {name(c)}" for c in columns)
    return F.expr(f"xxhash64(1, {cells})"), F.expr(f"xxhash64(2, {cells})")


def duplicate_rows(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Extra copies of whole rows per group: ``(by..., duplicate_rows)``; groups without copies are absent.

    Only 16 hash bytes per row are shuffled. Rows whose hash repeats are then
    compared in full, so a collision cannot invent a duplicate. The repeated hashes are
    written first: where they are few, the join knows it and leaves all other rows where they are.
    """
    by = list(by)
    h1, h2 = row_hashes(columns)
    tagged = df.select(*by, *columns, h1.alias("_h1"), h2.alias("_h2"))
    repeated = tagged.groupBy(*by, "_h1", "_h2").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    repeated, _ = materialize(repeated, "repeated_rows")
    suspects = tagged.join(repeated, [*by, "_h1", "_h2"], "left_semi")
    return (
        suspects.groupBy(*by, *columns).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
        .groupBy(*by).agg(F.sum(F.col("_n") - 1).alias("duplicate_rows"))
    )


def duplicate_keys(df: DataFrame, by: Sequence[str], key: Sequence[str]) -> DataFrame:
    """Key groups with more than one row: ``(by..., key..., n)``. Missing keys are a value too."""
    return df.groupBy(*by, *key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def top_values(counts: DataFrame, by: Sequence[str], k: int) -> DataFrame:
    """The k most frequent values per group; ties by value. Spark cuts to k per task before the shuffle."""
    from pyspark.sql import Window

    w = Window.partitionBy(*by).orderBy(F.desc("n"), F.asc("value"))
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def first_values(counts: DataFrame, by: Sequence[str], k: int) -> DataFrame:
    """The k smallest distinct values per group (deterministic examples)."""
    from pyspark.sql import Window

    w = Window.partitionBy(*by).orderBy(F.asc("value"))
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def status_rollup(results: DataFrame, by: Sequence[str]) -> DataFrame:
    """FAIL over WARN over PASS per group; SKIP does not count."""
    severity = F.max(F.when(F.col("status") == "FAIL", 2).when(F.col("status") == "WARN", 1).otherwise(0))
    result = F.when(severity == 2, F.lit("FAIL")).when(severity == 1, F.lit("WARN")).otherwise(F.lit("PASS"))
    return results.groupBy(*by).agg(result.alias("result"))


def status_counts(results: DataFrame, by: Sequence[str]) -> DataFrame:
    """Number of checks per status, one column each."""
    return results.groupBy(*by).agg(
        *[F.count_if(F.col("status") == s).alias(s.lower()) for s in ("PASS", "FAIL", "WARN", "SKIP")]
    )
