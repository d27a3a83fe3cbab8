"""Cell-level difference of two tables on a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import materialize
from .aggregates import row_hashes

ROW = "<row>"
#: Hashes of keys to look at that a join may broadcast, 8 bytes each; with more of them the difference itself is as large as a table.
FEW_SUSPECTS = 4_000_000


def _suspects(both: DataFrame, group: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The rows of ``both`` whose key does not occur exactly once a side with the same cells, and perhaps a few others.

    Equal rows, the usual case, meet as 128 hash bits and go no further; the others are taken whole from their source by a
    hash of their key, so they alone are shuffled with their cells.
    """
    columns = [c for c in columns if c not in group]
    h1, h2 = row_hashes([*group, *columns])
    met = both.select(*group, *[F.col(f"c.`{c}`").alias(c) for c in columns], "_a", "_b").select(
        *group, "_a", "_b", h1.alias("_h1"), h2.alias("_h2")
    ).groupBy(*group).agg(*[F.expr(f"sum({s})").alias(s) for s in ("_a", "_b")], *[F.expr(f"bit_xor({h})").alias(h) for h in ("_h1", "_h2")])
    key = F.xxhash64(*group).alias("_key")
    found, n = materialize(met.where("NOT (_a = 1 AND _b = 1 AND _h1 = 0 AND _h2 = 0)").select(key), "diff_keys")
    if n > FEW_SUSPECTS:
        return both
    rows = both.withColumn("_key", key).join(F.broadcast(found), "_key", "left_semi").drop("_key")
    return materialize(rows, "diff_rows")[0]


def cell_diff(a: DataFrame, b: DataFrame, key: str, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``(by..., key, column, a, b, copies)`` for every difference, raw text compared.

    A key on one side only gives one ``<row>`` line (``a``/``b`` tell which side has
    it); otherwise each differing cell gives one line. Both sides go through a single
    tagged aggregation on the key instead of an outer join, so no key, however often
    it occurs, multiplies rows; rows with equal hashes of 128 bits leave before it. A key that occurs more than once on a side is compared
    as a bag of cell values: each value with surplus copies is one line.
    """
    by, columns = list(by), [c for c in columns if c != key]
    group = [*by, key]
    cells = F.struct(*[F.col(c) for c in columns])
    both = a.select(*group, cells.alias("c"), F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        b.select(*group, cells.alias("c"), F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    )
    both = _suspects(both, group, columns)
    keys = both.groupBy(*group).agg(
        F.sum("_a").alias("na"), F.sum("_b").alias("nb"),
        F.max(F.when(F.col("_a") == 1, F.col("c"))).alias("ca"), F.max(F.when(F.col("_b") == 1, F.col("c"))).alias("cb"),
    )
    text = F.lit(None).cast("string")
    one_sided = keys.where((F.col("na") == 0) | (F.col("nb") == 0)).select(
        *group, F.lit(ROW).alias("column"),
        (F.col("na") > 0).cast("string").alias("a"), (F.col("nb") > 0).cast("string").alias("b"),
        F.greatest("na", "nb").alias("copies"),
    )
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"ca.`{c}`").alias("a"), F.col(f"cb.`{c}`").alias("b"))
        for c in columns
    ])
    matched = keys.where((F.col("na") == 1) & (F.col("nb") == 1) & ~F.col("ca").eqNullSafe(F.col("cb")))
    changed = matched.select(
        *group, F.explode(F.filter(pairs, lambda p: ~p["a"].eqNullSafe(p["b"]))).alias("p")
    ).select(*group, "p.column", "p.a", "p.b", F.lit(1).cast("bigint").alias("copies"))

    repeated = keys.where("na > 0 AND nb > 0 AND na + nb > 2").select(*group)
    long = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"c.`{c}`").alias("value")) for c in columns])
    # Rows equal on both sides cancel before their cells are spread out.
    bags = both.join(repeated, group, "left_semi").groupBy(*group, "c").agg(
        F.sum(F.col("_a") - F.col("_b")).alias("d")
    ).where("d <> 0")
    surplus = (
        bags.select(*group, F.explode(long).alias("p"), "d")
        .groupBy(*group, "p.column", "p.value").agg(F.sum("d").alias("d")).where("d <> 0")
        .select(
            *group, "column", F.when(F.col("d") > 0, F.col("value")).otherwise(text).alias("a"),
            F.when(F.col("d") < 0, F.col("value")).otherwise(text).alias("b"), F.abs("d").alias("copies"),
        )
    )
    return one_sided.unionByName(changed).unionByName(surplus)


def first_diffs(diff: DataFrame, key: str, limit: int = 50) -> DataFrame:
    """The report's excerpt: the first ``limit`` differences by key and column."""
    return diff.orderBy(F.col(key).try_cast("bigint"), key, "column", "a", "b").limit(limit)
