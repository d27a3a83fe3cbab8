"""Headers as tables: what the files of outputs and inputs say their columns are, compared by joins."""

from __future__ import annotations

import difflib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RUN, CASE = "run_id", "case"


def folder_value(file: Column, key: str) -> Column:
    """The value of ``key=value`` in a file's path."""
    return F.url_decode(F.regexp_extract(file, f"/{key}=([^/]+)/", 1))


def by_run(files: DataFrame, run: Column, case: Column) -> DataFrame:
    """``(run_id, case, header, layouts)`` from ``(file, header)``: a run has its first file's header; ``layouts`` counts
    the different headers among its files."""
    named = files.select(run.alias(RUN), case.alias(CASE), "file", "header")
    return named.groupBy(RUN, CASE).agg(
        F.sort_array(F.collect_set(F.struct("file", "header")))[0]["header"].alias("header"), F.count_distinct("header").alias("layouts"))


def _renames(missing: str, extra: str) -> Column:
    """``missing→found`` for each missing name with a similar one among the extra names. A row is one layout."""
    # Uses the standard library only, so workers need not have this package.
    def of(name: str, names: Sequence[str]) -> list[str]:
        return [f"{name}→{found}" for found in difflib.get_close_matches(name, list(names), n=1, cutoff=0.7)]

    @F.pandas_udf("array<string>")
    def match(m: pd.Series, e: pd.Series) -> pd.Series:
        return pd.Series([[r for name in a for r in of(name, b)] for a, b in zip(m, e, strict=True)])

    return match(missing, extra)


def compared(headers: DataFrame, names: Sequence[str]) -> DataFrame:
    """``headers`` with ``missing``, ``extra`` and ``renames`` against the wanted names; each layout is compared once."""
    want = F.array(*(F.lit(n) for n in names)).cast("array<string>")
    layouts = headers.select("header").distinct().select("header", F.array_except(want, "header").alias("missing"), F.array_except("header", want).alias("extra"))
    drifted = F.when((F.size("missing") > 0) & (F.size("extra") > 0), _renames("missing", "extra")).otherwise(F.array().cast("array<string>"))
    return headers.join(layouts.withColumn("renames", drifted), "header")


def drift(headers: DataFrame, baseline: Sequence[str], column: str = "header") -> DataFrame:
    """``headers`` with ``removed`` and ``added``: the names that ``column`` lacks or has beyond the baseline's."""
    base = F.array(*(F.lit(n) for n in baseline)).cast("array<string>")
    return headers.withColumns({"removed": F.array_except(base, column), "added": F.array_except(column, base)})
