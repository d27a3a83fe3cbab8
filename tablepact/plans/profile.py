"""Reference profile and the distribution checks (SEM-01, SEM-03, SEM-05)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contract import Contract
from ..functions import dates as D
from ..functions import numeric as N
from ..functions import text as X
from ..functions.sql import array, lit, name
from ..operators.aggregates import js_distance, shares
from ..operators.quantiles import quantiles
from ..sources.staging import materialize
from .runs import RUN, RunSet


def value_facts(df: DataFrame, contract: Contract, by: Sequence[str]) -> DataFrame:
    """Counted values of the drift columns, ``(by..., kind, column, v, s, n)``, in one scan.

    ``number`` carries v; ``share`` carries the text s; ``month`` the month number as
    text; ``window`` counts parsed dates inside (0) and outside (1) the window in v;
    ``bound`` carries the day number of a date, from which the date range is read.
    Cells are counted as they are written first; what they say is worked out once for each spelling.
    """
    texts, values, kinds = [], {"x": [], "d": []}, []
    for c in contract.columns:
        if c.name not in df.columns:
            continue
        raw, native = name(c.name), df.schema[c.name].dataType.typeName() != "string"

        def counted(text: str, value: str, parsed: str) -> str:
            """Counts ``text``; returns the condition that a counted text is of this kind."""
            if text not in texts:
                texts.append(text)
            here = f"_i = {texts.index(text)}"
            if value:
                values[value].append(f"WHEN {here} THEN {parsed}")
            return here

        def fact(when: str, kind: str, v: str = "CAST(NULL AS DOUBLE)", s: str = "CAST(NULL AS STRING)", column: str = c.name):
            kinds.append(f"CASE WHEN {when} THEN named_struct('kind', {lit(kind)}, 'column', {lit(column)}, 'v', CAST({v} AS DOUBLE), 's', CAST({s} AS STRING)) END")

        if c.numeric and c.name != contract.key:
            here = counted(f"CAST(CAST({raw} AS DOUBLE) AS STRING)" if native else raw, "x", "nanvl(CAST(_t AS DOUBLE), NULL)" if native else N.to_num("_t"))
            fact(f"{here} AND _x IS NOT NULL", "number", v="_x")
        if c.drift == "distribution":
            here = counted(f"CAST({raw} AS STRING)" if native else raw, "", "")
            fact(f"{here} AND {X.is_present('_t')}", "share", s="_t")
        if c.drift == "date":
            here = counted(f"CAST(CAST({raw} AS TIMESTAMP_NTZ) AS STRING)" if native else raw, "d", "CAST(_t AS TIMESTAMP_NTZ)" if native else D.to_date_ntz("_t"))
            fact(f"{here} AND _d IS NOT NULL", "month", s="month(_d)")
            fact(f"{here} AND _d IS NOT NULL", "bound", v="unix_date(CAST(_d AS DATE))")
            if c.min is not None:
                out = f"_d < {D.day_bound(c.min)} OR _d > {D.day_bound(c.max)}"
                fact(f"{here} AND _d IS NOT NULL", "window", v=f"CASE WHEN {out} THEN 1 ELSE 0 END")
    cells = array(f"named_struct('_i', {i}, '_t', {t})" for i, t in enumerate(texts)) if texts else "CAST(array() AS ARRAY<STRUCT<_i: INT, _t: STRING>>)"
    kinds = kinds or ["CAST(NULL AS STRUCT<kind: STRING, column: STRING, v: DOUBLE, s: STRING>)"]
    keys = [name(b) for b in by]
    spelled = df.selectExpr(*keys, f"inline({cells})").where("_t IS NOT NULL").groupBy(*by, "_i", "_t").agg(F.count(F.lit(1)).alias("n"))
    parsed = spelled.selectExpr("*", *(f"CASE {' '.join(whens) or 'WHEN false THEN NULL'} END AS _{v}" for v, whens in values.items()))
    return (
        parsed.selectExpr(*keys, "n", f"explode({array(kinds)}) AS f").where("f IS NOT NULL").select(*by, "f.*", F.col("n").alias("_n"))
        .groupBy(*by, "kind", "column", "v", "s").agg(F.sum("_n").alias("n"))
    )


def of_kind(facts: DataFrame, kind: str) -> DataFrame:
    """Facts of one kind; the predicate names ``n`` so that it stays above the shared aggregation."""
    return facts.where(f"CASE WHEN n > 0 THEN kind END = {lit(kind)}").drop("kind")


def profile(df: DataFrame, contract: Contract, by: Sequence[str] = ()) -> DataFrame:
    """Long profile of a trusted output; see :func:`profile_of`."""
    f, _ = materialize(value_facts(df, contract, by), "profile_facts")
    count = df.groupBy(*by).agg(F.count(F.lit(1)).cast("double").alias("value"))
    return profile_of(f, count, by)


def profile_of(f: DataFrame, count: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Long profile ``(by..., column, metric, key, value)`` of a trusted output.

    Medians and 5th/95th percentiles of the numeric columns, first and last date (as
    days since 1970-01-01), shares by month and by category, and the row count.
    """
    by = list(by)
    g = [*by, "column"]
    q = quantiles(of_kind(f, "number").select(*g, "v", "n"), g, [0.05, 0.5, 0.95])
    metric = F.when(F.col("prob") == 0.5, "median").when(F.col("prob") < 0.5, "p05").otherwise("p95")
    numbers = q.select(*g, metric.alias("metric"), F.lit("").alias("key"), "value")
    bounds = of_kind(f, "bound").groupBy(*g).agg(F.min("v").alias("min"), F.max("v").alias("max")).select(
        *g, F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in ("min", "max")])
                      ).alias("b")
    ).select(*g, "b.metric", F.lit("").alias("key"), "b.value")
    parts = [numbers, bounds]
    for kind, name in (("month", "month_share"), ("share", "share")):
        parts.append(shares(of_kind(f, kind), g, "s").select(
            *g, F.lit(name).alias("metric"), F.col("s").alias("key"), F.col("share").alias("value")
        ))
    count = count.select(
        *by, F.lit("*").alias("column"), F.lit("rows").alias("metric"), F.lit("").alias("key"), "value"
    )
    out = count
    for p in parts:
        out = out.unionByName(p)
    return out


def reference_shares(reference: DataFrame) -> DataFrame:
    """``(column, value, share)`` of a long profile."""
    return reference.where(F.col("metric").isin("share", "month_share")).select(
        "column", F.col("key").alias("value"), F.col("value").alias("share")
    )


def distribution_metrics(facts: DataFrame, rs: RunSet, reference: DataFrame) -> DataFrame:
    """JS distance of every category and month column to the reference: ``(run_id, column, js_distance)``.

    Columns the reference lacks, or the run's table lacks, have no row. Reference shares meet the runs by column name.
    """
    mine = facts.where("CASE WHEN n > 0 THEN kind END IN ('share', 'month')")
    mine = shares(mine, [RUN, "column"], "s").select(RUN, "column", F.col("s").alias("value"), "share")
    drift = [c.name for c in rs.contract.columns if c.drift in ("distribution", "date")]
    has = rs.run_headers().select(RUN, F.explode(F.array_distinct("header")).alias("column")).where(F.col("column").isin(*drift))
    ref = reference_shares(reference).join(has, "column").select(RUN, "column", "value", "share")
    known = ref.select(RUN, "column").distinct()
    return js_distance(mine.join(known, [RUN, "column"], "left_semi"), ref, [RUN, "column"])


def level_metrics(facts: DataFrame, reference: DataFrame, contract: Contract) -> DataFrame:
    """SEM-01: ``(run_id, median, reference_median, ratio)`` of the level column."""
    column = contract.level_column
    hist = of_kind(facts, "number").where(F.col("column") == column).select(RUN, "v", "n")
    mid = quantiles(hist, [RUN], [0.5]).select(RUN, F.col("value").alias("median"))
    ref = reference.where((F.col("column") == column) & (F.col("metric") == "median")).agg(F.max("value").alias("m"))
    ref_value = ref.scalar()
    return mid.withColumn("reference_median", ref_value).withColumn(
        "ratio", F.when(F.col("reference_median") == 0, F.lit(float("inf")))
        .otherwise(F.try_divide("median", "reference_median"))
    )


def window_metrics(facts: DataFrame) -> DataFrame:
    """SEM-03: ``(run_id, dates, out_of_window)``."""
    return of_kind(facts, "window").groupBy(RUN).agg(
        F.sum("n").alias("dates"),
        F.coalesce(F.sum(F.when(F.col("v") == 1, F.col("n"))), F.lit(0).cast("bigint")).alias("out_of_window"),
    )


def new_categories(facts: DataFrame, reference: DataFrame) -> DataFrame:
    """Category values that the reference does not have: ``(run_id, column, value, n)``."""
    known = reference.where("metric = 'share'").select("column", F.col("key").alias("s"))
    return of_kind(facts, "share").join(known, ["column", "s"], "left_anti").select(
        RUN, "column", F.col("s").alias("value"), "n"
    )
