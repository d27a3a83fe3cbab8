"""Typed equality of two raw cells, and fuzzy header names."""

from __future__ import annotations

import difflib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .dates import to_date_ntz
from .numeric import to_num
from .sql import lit, true
from .text import is_missing, strip


def tolerant_equal(a: str, b: str, dtype: str, tolerance: float) -> str:
    """Both missing, or equal as numbers within the tolerance, as dates, or as stripped text.

    Identical texts are parsed once, only to see that they are numbers or dates at all.
    """
    both_missing = f"({is_missing(a)} AND {is_missing(b)})"
    if dtype in ("int", "float"):
        near = f"abs({to_num(a)} - {to_num(b)}) <= {lit(float(tolerance))}"
        same = f"CASE WHEN {a} = {b} THEN {to_num(a)} IS NOT NULL ELSE {near} END"
    elif dtype == "date":
        same = f"CASE WHEN {a} = {b} THEN {to_date_ntz(a)} IS NOT NULL ELSE {to_date_ntz(a)} = {to_date_ntz(b)} END"
    else:
        same = f"({a} = {b} OR {strip(a)} = {strip(b)}) AND NOT {is_missing(a)} AND NOT {is_missing(b)}"
    return f"({both_missing} OR {true(same)})"


def close_name(name: str, candidates: Sequence[str], cutoff: float = 0.7) -> str | None:
    """Best fuzzy match of one column name (header metadata, a driver-side value)."""
    found = difflib.get_close_matches(name, list(candidates), n=1, cutoff=cutoff)
    return found[0] if found else None


def close_value(c: Column, candidates: Sequence[str], cutoff: float = 0.7) -> Column:
    """Best fuzzy match per row against a fixed candidate list.

    The sequence-matcher ratio has no built-in equivalent, so this is an Arrow batch
    UDF; apply it to distinct values.
    """

    names = list(candidates)

    # Uses the standard library only, so workers need not have this package.
    @F.pandas_udf("string")
    def match(s: pd.Series) -> pd.Series:
        return s.map(lambda v: next(iter(difflib.get_close_matches(v or "", names, n=1, cutoff=cutoff)), None))

    return match(c)
