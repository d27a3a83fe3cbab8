"""DET-01: do runs of the same input give the same content, and where not."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sql import array, lit
from ..operators.diff import cell_diff
from ..operators.fingerprint import raw_and_content
from .runs import CASE, RUN, values_table


def header_table(spark: SparkSession, headers: Mapping[str, Sequence[str]]) -> DataFrame:
    """``(run_id, header)`` from the runs' column lists (driver metadata)."""
    rows = [(lit(r), array(lit(c) for c in h)) for r, h in headers.items()]
    return values_table(spark, [RUN, "header"], rows)


def run_fingerprints(spark: SparkSession, outputs: DataFrame, headers: Mapping[str, Sequence[str]],
                     columns: Sequence[str]) -> DataFrame:
    """``(run_id, rows, raw_hash, content_hash)``: raw cells and canonical cells."""
    return raw_and_content(outputs, [RUN], columns, header_table(spark, headers))


def determinism(prints: DataFrame, by: Sequence[str] = (CASE,)) -> DataFrame:
    """DET-01 per group of runs: number of runs, distinct contents, status."""
    grouped = prints.groupBy(*by).agg(
        F.count(F.lit(1)).alias("runs"), F.count_distinct("content_hash").alias("distinct_contents"),
        F.count_distinct("raw_hash").alias("distinct_raw"),
    )
    status = F.when(F.col("runs") < 2, "SKIP").when(F.col("distinct_contents") == 1, "PASS").otherwise("FAIL")
    return grouped.select(
        *by, "runs", "distinct_contents", (F.col("distinct_raw") == 1).alias("raw_identical"), status.alias("status")
    )


def diffs_vs_first(outputs: DataFrame, prints: DataFrame, first: str, key: str, columns: Sequence[str]) -> DataFrame:
    """Cell differences of every differing run to the first one, one representative run per distinct content.

    The representatives are found by hash; only their rows are read for the diff.
    """
    # One row per run: the list of representatives is metadata, and as literals it
    # prunes the run folders.
    content = {r[RUN]: r["content_hash"] for r in prints.select(RUN, "content_hash").collect()}
    chosen: dict[str, str] = {}
    for run in sorted(content):
        if content[run] != content[first]:
            chosen.setdefault(content[run], run)
    names = sorted(chosen.values())
    a = outputs.where(F.col(RUN) == first).select(key, *columns).withColumn(
        RUN, F.explode(F.expr(f"CAST({array(lit(n) for n in names)} AS ARRAY<STRING>)")))
    b = outputs.where(F.col(RUN).isin(*names)) if names else outputs.where("false")
    return cell_diff(a, b.select(RUN, key, *columns), key, columns, by=[RUN])
