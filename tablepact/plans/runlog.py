"""Summaries of a run log: health, consistency, outcomes, durations, severity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sql import lit, name
from ..operators.quantiles import medians

# Outcome and impact vocabulary of the severity rubric.
SILENT = ("CARRIED-ON-SILENTLY", "CARRIED-ON-EMPTY")
STOPPED = ("STOPPED-AT-INPUT", "STOPPED-MID-PIPELINE")


def health_by_scenario(log: DataFrame) -> DataFrame:
    """Runs, failures and success rate per case; ``log`` has ``case, failed``."""
    return log.groupBy("case").agg(
        F.count(F.lit(1)).alias("runs"), F.expr("count_if(failed)").alias("failed"),
        F.expr("avg(CASE WHEN failed THEN 0D ELSE 1D END)").alias("success_rate"))


def consistency_by_config(prints: DataFrame) -> DataFrame:
    """Runs, distinct contents and whether all agree, per configuration. Two levels: a hot
    configuration is folded per content before its contents are counted."""
    per_hash = prints.groupBy("config", "content_hash").agg(F.count(F.lit(1)).alias("n"))
    return per_hash.groupBy("config").agg(
        F.sum("n").alias("runs"), F.count(F.lit(1)).alias("distinct_hashes"),
        (F.count(F.lit(1)) == 1).alias("identical"))


def capability_heatmap(log: DataFrame, outcomes: Sequence[str]) -> DataFrame:
    """Case by outcome counts, one column per outcome."""
    return log.groupBy("case").agg(*[F.expr(f"count_if(outcome = {lit(o)})").alias(o) for o in outcomes])


def duration_vs_baseline(log: DataFrame, baseline) -> DataFrame:
    """Mean and median duration per case, and the mean's difference to the baseline case in percent."""
    mean = log.groupBy("case").agg(F.avg("duration").alias("mean"))
    mid = medians(log, ["case"], ["duration"]).select("case", F.col("value").alias("median"))
    base = mean.where(F.col("case") == baseline).agg(F.max("mean").alias("m")).scalar()
    return mean.join(mid, "case").withColumn("delta_pct", (F.col("mean") / base - 1) * 100)


def severity(outcome: str, impact: str, log_clarity: str) -> str:
    """Customer impact of a run: silent wrong data first, then unclear and clear failures."""
    o, i, c = name(outcome), name(impact), name(log_clarity)
    silent = ", ".join(lit(x) for x in SILENT)
    stopped = ", ".join(lit(x) for x in STOPPED)
    return (
        f"CASE WHEN {o} IN ({silent}) AND {i} <> 'CORRECT-OUTPUT' THEN 'Critical' "
        f"WHEN {o} IN ({stopped}) AND {c} <= 0 THEN 'High' WHEN {o} IN ({stopped}) THEN 'Medium' "
        f"WHEN {o} IN ({silent}) OR {o} = 'WARNED-AND-CONTINUED' THEN 'Low' ELSE 'Info' END"
    )
