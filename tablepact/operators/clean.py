"""Contract cleaner: ten steps, each a ``DataFrame -> DataFrame`` for ``transform``.

The order of the steps is part of the semantics. Columns that the input lacks are
skipped, columns the contract does not know pass through untouched, and ``_ord``
(the file position) travels along. Nothing is collected: the imputation medians are
one scalar subquery.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contract import Contract
from ..functions import dates as D
from ..functions import numeric as N
from ..functions import text as X
from ..functions.sql import in_list, lit, name
from .ordering import ORD, distinct_rows, sort_by_key
from .quantiles import median_map

Step = Callable[[DataFrame], DataFrame]
_REASON = "_reason"


def _apply(df: DataFrame, exprs: dict[str, str]) -> DataFrame:
    return df.withColumns({c: F.expr(e) for c, e in exprs.items()}) if exprs else df


def text_step(contract: Contract) -> Step:
    """1: normalise white space in the text columns."""
    return lambda df: _apply(df, {c: X.norm_ws(name(c)) for c in contract.text_columns if c in df.columns})


def case_step(contract: Contract) -> Step:
    """2: title or lower case, as the column's rules say."""

    def run(df: DataFrame) -> DataFrame:
        out = {}
        for c in contract.columns:
            if c.name in df.columns and "title_case" in c.rules:
                out[c.name] = X.title_case(name(c.name))
            elif c.name in df.columns and "lower_case" in c.rules:
                out[c.name] = X.lower(name(c.name))
        return _apply(df, out)

    return run


def map_step(contract: Contract) -> Step:
    """3: canonical spelling through the column's lookup."""
    return lambda df: _apply(
        df, {c.name: X.lookup_map(name(c.name), c.lookup) for c in contract.columns
             if c.lookup and c.name in df.columns}
    )


def date_step(contract: Contract) -> Step:
    """4: parse by the ordered formats and write ISO text; unparseable becomes empty."""
    return lambda df: _apply(
        df, {c.name: D.iso_date(D.parse_formats(name(c.name), contract.input_date_formats))
             for c in contract.columns if c.dtype == "date" and c.name in df.columns}
    )


def number_step(contract: Contract) -> Step:
    """5a: numeric columns as doubles; unparseable becomes NULL and is imputed later."""
    return lambda df: _apply(df, {c: N.to_num(name(c)) for c in contract.number_columns if c in df.columns})


def reject_rules(contract: Contract, columns: list[str]) -> list[tuple[str, str]]:
    """``(reason, condition)`` in contract order, over the state after the date and number steps.

    A missing number is not invalid; a missing date or category is.
    """
    rules = []
    for c in contract.columns:
        if c.name not in columns:
            continue
        v = name(c.name)
        if c.invalid_le is not None:
            rules.append((f"{c.name}_le", f"{v} <= {lit(c.invalid_le)}"))
        if c.invalid_lt is not None:
            rules.append((f"{c.name}_lt", f"{v} < {lit(c.invalid_lt)}"))
        if c.invalid_unparseable and c.dtype == "date":
            rules.append((f"{c.name}_unparseable", f"{v} = ''"))
        if c.invalid_not_allowed and c.allowed is not None:
            rules.append((f"{c.name}_not_allowed", f"coalesce({v}, '') NOT IN {in_list(c.allowed)}"))
    return rules


def reject_reason(df: DataFrame, contract: Contract) -> str:
    """First rule that makes a row invalid, else NULL."""
    whens = " ".join(f"WHEN {bad} THEN {lit(reason)}" for reason, bad in reject_rules(contract, df.columns))
    return f"CASE {whens} END" if whens else "CAST(NULL AS STRING)"


def reject_step(contract: Contract) -> Step:
    """5b: drop invalid rows."""
    return lambda df: df.where(f"{reject_reason(df, contract)} IS NULL")


def email_step(contract: Contract) -> Step:
    """6: values that must contain ``@`` and do not become empty."""
    return lambda df: _apply(
        df, {c.name: X.blank_unless_at(name(c.name)) for c in contract.columns
             if "contains_at" in c.rules and c.name in df.columns}
    )


def dedupe_step(contract: Contract) -> Step:
    """7: distinct on all columns (numbers compared as numbers), first position kept."""
    return lambda df: distinct_rows(df) if contract.dedupe else df


def impute_step(contract: Contract) -> Step:
    """8: medians of what is left, rounded; constants for empty text.

    The ``_ord`` predicate keeps the median branch on exactly the same deduplicated
    plan as the rows, so its shuffle is reused instead of computed again. A column
    without any value has no median and stays empty.
    """

    def run(df: DataFrame) -> DataFrame:
        out = {}
        present = [c for c in contract.imputed if c.name in df.columns]
        by_median = {c.name: name(c.name) for c in present if c.impute.method == "median"}
        if by_median:
            middle = median_map(df.where(F.col(ORD).isNotNull()), by_median,
                                lambda v, c: N.round_even(v, contract[c].impute.places))
            out = {c: F.coalesce(F.col(c), F.try_element_at(middle, F.lit(c))) for c in by_median}
        for c in present:
            if c.impute.method == "constant":
                out[c.name] = F.expr(X.default_if_missing(name(c.name), c.impute.value))
        return df.withColumns(out) if out else df

    return run


def format_step(contract: Contract) -> Step:
    """9: whole numbers as digits, decimals with their fixed places, empty when missing."""

    def run(df: DataFrame) -> DataFrame:
        out = {}
        for c in contract.columns:
            if c.name not in df.columns or not c.numeric:
                continue
            v = name(c.name)
            if c.name == contract.key:
                out[c.name] = f"coalesce(CAST({N.to_key(v)} AS STRING), '<NA>')"
            elif c.dtype == "int":
                out[c.name] = f"coalesce({N.int_text(v)}, '')"
            else:
                places = 2 if c.decimals is None else c.decimals
                out[c.name] = f"coalesce({N.fixed_decimal(v, places)}, '')"
        return _apply(df, out)

    return run


def sort_step(contract: Contract) -> Step:
    """10: ascending by key, stable; ``_ord`` is the position in the output afterwards."""

    def run(df: DataFrame) -> DataFrame:
        by = contract.sort_by
        if by is None or by not in df.columns:
            return df
        return sort_by_key(df, F.expr(N.to_key(name(by))))

    return run


STEPS: dict[str, Callable[[Contract], Step]] = {
    "text": text_step, "case": case_step, "map": map_step, "date": date_step, "number": number_step,
    "reject": reject_step, "email": email_step, "dedupe": dedupe_step, "impute": impute_step,
    "format": format_step, "sort": sort_step,
}


def clean(raw: DataFrame, contract: Contract, until: str | None = None) -> DataFrame:
    """Clean a raw string table (with ``_ord``); ``until`` stops after the named step."""
    df = raw
    for step, make in STEPS.items():
        df = df.transform(make(contract))
        if step == until:
            break
    return df


def row_accounting(raw: DataFrame, contract: Contract) -> DataFrame:
    """Waterfall ``rows_in = rows_out + duplicates + rejected per reason`` as one row per item.

    One shuffle: rows are counted per distinct content and reason.
    """
    df = raw
    for step in ("text", "case", "map", "date", "number"):
        df = df.transform(STEPS[step](contract))
    df = df.withColumn(_REASON, F.expr(reject_reason(df, contract))).transform(email_step(contract))
    cols = [c for c in df.columns if c != ORD]
    groups = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    items = [("rows_in", "sum(_n)"), ("duplicates", f"sum(CASE WHEN {_REASON} IS NULL THEN _n - 1 END)")]
    items += [(f"invalid:{r}", f"sum(CASE WHEN {_REASON} = {lit(r)} THEN _n END)")
              for r, _ in reject_rules(contract, raw.columns)]
    items += [("rows_out", f"count_if({_REASON} IS NULL)")]
    totals = groups.agg(*[F.expr(f"coalesce({e}, 0L)").alias(n) for n, e in items])
    rows = ", ".join(f"{i}, {lit(n)}, {name(n)}" for i, (n, _) in enumerate(items))
    return totals.selectExpr(f"stack({len(items)}, {rows}) AS (step, item, rows)")
