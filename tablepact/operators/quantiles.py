"""Exact quantiles that no single task has to hold.

``percentile`` keeps every distinct value of a group in one buffer. Here the values are counted first (map-side
combined, so a value that fills a third of the table is one row) and a rank is then found by selection: every
double has a whole number that is ordered like it, and rounds of 21 of its 63 bits narrow the range in which the
rank lies. A round counts per bucket, so what it orders is at most 2**21 rows whatever the values are, and after
three rounds the range is one value. Tiny, narrow, negative and constant columns go the same way as any other.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sql import array, lit, name

#: Bits of a round; three rounds cover a double.
_STEP = 21


def _with_bits(df: DataFrame, v: str = "v") -> DataFrame:
    """``df`` with ``_bits``: a whole number that is ordered like the double ``v`` (not NaN): its exponent and mantissa,
    negative for negative values.

    Powers of two are exact, so the estimated exponent is put right by comparison and the mantissa is exact. Never NULL: a
    join on it adds no filter that would make the plans of its inputs differ, and all rounds read the same shuffled counts.
    """
    a = f"abs({v})"
    guess = df.withColumn("_g", F.expr(f"CASE WHEN {a} > 0 AND {a} < double('inf') THEN CAST(floor(log2({a})) AS INT) END"))
    exponent = guess.withColumn("_e", F.expr(f"_g - if(pow(2D, _g) > {a}, 1, 0) + if(pow(2D, _g) * 2 <= {a}, 1, 0)"))
    size = (f"CASE WHEN {a} < 2.2250738585072014E-308D THEN CAST({a} / 4.9E-324D AS BIGINT) WHEN {a} = double('inf') THEN {2047 * 2**52}L "
            f"ELSE (_e + 1022) * {2**52}L + CAST({a} / pow(2D, _e) * {float(2**52)!r}D AS BIGINT) END")
    return exponent.withColumn("_bits", F.expr(f"coalesce(if({v} < 0, -1L, 1L) * ({size}), 0L)")).drop("_g", "_e")


def value_counts(df: DataFrame, by: Sequence[str], columns: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Present numeric values and their counts, ``(by..., column, v, n)``, one pass for all columns.

    ``columns`` are names, or labels with expressions. The values are exploded before
    the NULL filter, which therefore stays above whatever ``df`` is (a deduplication,
    say) and leaves its plan reusable.
    """
    exprs = columns if isinstance(columns, Mapping) else {c: name(c) for c in columns}
    cells = array(f"named_struct('column', {lit(c)}, 'v', CAST({e} AS DOUBLE))" for c, e in exprs.items())
    return (
        df.select(*by, F.explode(F.expr(cells)).alias("_c")).select(*by, "_c.column", "_c.v")
        .where("v IS NOT NULL").groupBy(*by, "column", "v").agg(F.count(F.lit(1)).alias("n"))
    )


def quantiles(counts: DataFrame, by: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """``(by..., prob, value)`` from a ``(by..., v, n)`` table; linear interpolation.

    A group without values has no rows, nor has a group with a NULL name.
    """
    by = list(by)
    group = by or ["_all"]
    c = (counts if by else counts.withColumn("_all", F.lit(0))).select(*group, "v", "n")
    # Joins would add this to some of the rounds' inputs only, and they would no longer share one shuffle.
    c = _with_bits(c.dropna(subset=group))
    wanted = ", ".join(f"{float(p)!r}D" for p in probs)
    part = ", ".join(name(g) for g in group)
    rank = "p * (_total - 1)"
    ranks = (f"flatten(transform(array({wanted}), p -> transform(array(floor({rank}), ceil({rank})), (r, i) -> "
             f"named_struct('prob', p, 'side', i, 'frac', {rank} - floor({rank}), 'rank', r))))")
    here = "filter({}, r -> r.rank >= _end - _nb AND r.rank < _end)"
    inside = "transform({}, r -> named_struct('prob', r.prob, 'side', r.side, 'frac', r.frac, 'rank', r.rank - (_end - _nb)))"
    upper, sought = [], None
    for shift in (2 * _STEP, _STEP, 0):
        # The first round looks at all values; later ones only at those in a range that holds a rank, with the ranks
        # (and the places in the range) that it holds. A range is met once.
        values = c
        if sought is not None:
            values = c.withColumn("_at", F.shiftright("_bits", shift + _STEP)).join(sought, [*group, "_at"])
            upper = ["_at", "_ranks"]
        buckets = values.groupBy(*group, *upper, F.shiftright("_bits", shift).alias("_to")).agg(F.sum("n").alias("_nb"), F.max("v").alias("_v"))
        of = part + (", _at" if upper else "")
        spans = buckets.selectExpr(
            "*", f"sum(_nb) OVER (PARTITION BY {of} ORDER BY _to ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _end",
            *([] if upper else [f"sum(_nb) OVER (PARTITION BY {part}) AS _total"]))
        if not upper:
            spans = spans.withColumn("_ranks", F.expr(ranks))
        held = spans.withColumn("_ranks", F.expr(here.format("_ranks"))).where("size(_ranks) > 0")
        sought = held.select(*group, F.col("_to").alias("_at"), F.expr(inside.format("_ranks")).alias("_ranks"), *(["_v"] if not shift else []))
    out = sought.select(*group, "_v", F.explode("_ranks").alias("r")).groupBy(*group, F.col("r.prob").alias("prob"), F.col("r.frac").alias("_frac")).agg(
        F.max(F.when(F.col("r.side") == 0, F.col("_v"))).alias("_lo"), F.max(F.when(F.col("r.side") == 1, F.col("_v"))).alias("_hi"))
    value = ("CASE WHEN _hi = _lo THEN _lo WHEN _frac = 0.5 THEN (_lo + _hi) / 2 "
             "WHEN _frac < 0.5 THEN _lo + (_hi - _lo) * _frac ELSE _hi - (_hi - _lo) * (1 - _frac) END")
    return out.selectExpr(*map(name, by), "prob", f"{value} AS value")


def medians(df: DataFrame, by: Sequence[str], columns: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Exact interpolated medians, ``(by..., column, value)``."""
    group = [*by, "column"]
    return quantiles(value_counts(df, by, columns), group, [0.5]).select(*group, "value")


def median_map(df: DataFrame, columns: Mapping[str, str],
               rounding: Callable[[str, str], str] | None = None) -> Column:
    """Medians of several columns as one scalar subquery, a map with an entry per label."""
    value = "value"
    if rounding is not None:
        value = "CASE " + " ".join(f"WHEN column = {lit(c)} THEN {rounding('value', c)}" for c in columns) + " END"
    entries = F.expr(f"map_from_entries(collect_list(struct(column, {value})))")
    return medians(df, [], columns).agg(entries.alias("medians")).scalar()


def approx_quantiles(df: DataFrame, by: Sequence[str], value: str, probs: Sequence[float],
                     accuracy: int = 10000) -> DataFrame:
    """Sketch-based variant for when a rank error of 1/accuracy is acceptable."""
    arr = F.percentile_approx(F.col(value).cast("double"), [float(p) for p in probs], accuracy)
    q = df.groupBy(*by).agg(arr.alias("_q"))
    pairs = F.arrays_zip(F.array(*[F.lit(float(p)) for p in probs]).alias("prob"), F.col("_q").alias("value"))
    return q.select(*by, F.explode(pairs).alias("_p")).select(*by, "_p.prob", "_p.value")
