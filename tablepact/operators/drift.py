"""Controlled drift: schema drifts S1-S5, meaning drifts M1-M3, and the probe row."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import numeric as N
from ..functions.sql import array, lit, literal_map, name

# Fixed values of the drift cases.
DISCOUNT_CODES = ("SAVE10", "WELCOME5", "SPRING15", "VIP20")
ISO_CODES = {
    "usa": "US", "us": "US", "u.s.": "US", "united states": "US",
    "uk": "GB", "u.k.": "GB", "united kingdom": "GB", "aus": "AU", "au": "AU", "australia": "AU",
    "india": "IN", "nz": "NZ", "new zealand": "NZ",
}
PROBE_ORDER = {
    "customer_name": "Probe Tester", "email": "probe.tester1@example.com", "country": "Australia",
    "order_date": "06/15/2026", "product": "Desk Lamp", "category": "Home", "quantity": "1",
    "unit_price": "32.00", "status": "delivered",
}


def drop_column(df: DataFrame, name: str) -> DataFrame:
    return df.drop(name)


def rename_column(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.withColumnRenamed(old, new)


def insert_after(df: DataFrame, after: str, name: str, value: str) -> DataFrame:
    """Add a column (an expression) right behind a named one."""
    out = []
    for c in df.columns:
        out.append(F.col(c))
        if c == after:
            out.append(F.expr(value).alias(name))
    return df.select(*out)


def key_choice(key: str, values: Sequence[str]) -> str:
    """A pseudo-random choice that is a pure function of the key, so copies of a row agree."""
    return f"element_at({array(lit(v) for v in values)}, CAST(pmod({key} * 48271, 2147483647) % {len(values)} + 1 AS INT))"


def s1_drop(df: DataFrame) -> DataFrame:
    return drop_column(df, "country")


def s2_rename(df: DataFrame) -> DataFrame:
    return rename_column(df, "customer_name", "customer_full_name")


def s3_currency(df: DataFrame) -> DataFrame:
    return df.withColumn("unit_price", F.expr(N.currency_text("unit_price")))


def s4_add(df: DataFrame) -> DataFrame:
    """Discount code behind the product: three keys in ten have one, copies share it."""
    key = N.to_key("order_id")
    filled = f"pmod({key} * 7919, 1000003) % 10 < 3"
    return insert_after(df, "product", "discount_code",
                        f"CASE WHEN {filled} THEN {key_choice(key, DISCOUNT_CODES)} ELSE '' END")


def s5_combined(df: DataFrame) -> DataFrame:
    return df.transform(s1_drop).transform(s2_rename).transform(s3_currency).transform(s4_add)


def m1_cents(df: DataFrame) -> DataFrame:
    return df.withColumn("unit_price", F.expr(N.minor_units("unit_price")))


def m2_date_swap(df: DataFrame) -> DataFrame:
    return df.withColumn("order_date", F.expr(D.swap_day_month("order_date")))


def m3_iso_codes(df: DataFrame, codes: Mapping[str, str] = ISO_CODES) -> DataFrame:
    found = f"try_element_at({literal_map(codes)}, lower(trim(country)))"
    return df.withColumn("country", F.expr(f"CASE WHEN country = '' THEN '' ELSE {found} END"))


def probe_extra_row(df: DataFrame, order: str = "_ord") -> DataFrame:
    """Append one valid order with the next key at the end of the file."""
    last = df.selectExpr(f"{N.to_key('order_id')} AS k", f"{order} AS o").agg(
        F.expr("CAST(max(k) + 1 AS STRING)").alias("order_id"), F.expr("max(o) + 10").alias(order)
    )
    probe = last.select(*[
        F.col(c) if c in ("order_id", order) else F.lit(PROBE_ORDER.get(c, "")).alias(c) for c in df.columns
    ])
    return df.unionByName(probe)


CASES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "baseline": lambda df: df,
    "probe-extra-row": probe_extra_row,
    "S1": s1_drop, "S2": s2_rename, "S3": s3_currency, "S4": s4_add, "S5": s5_combined,
    "M1": m1_cents, "M2": m2_date_swap, "M3": m3_iso_codes,
}

#: Columns that a case computes anew. All others are the table's own, also under another name.
COMPUTED: dict[str, tuple[str, ...]] = {
    "S3": ("unit_price",), "S4": ("discount_code",), "S5": ("unit_price", "discount_code"),
    "M1": ("unit_price",), "M2": ("order_date",), "M3": ("country",),
}
RENAMED: dict[str, dict[str, str]] = {"S2": {"customer_full_name": "customer_name"}, "S5": {"customer_full_name": "customer_name"}}


def side_by_side(df: DataFrame, cases: Sequence[str]) -> tuple[DataFrame, dict[str, dict[str, str]]]:
    """Row-wise cases in one table: ``df`` and, for each case, only the columns it computes; and per case the column
    behind every name of its header. Cases that share a column then share the work on it."""
    tables, own = {}, list(df.columns)
    wide = df
    for case in cases:
        made = {c: f"{case}:{c}" for c in COMPUTED.get(case, ())}
        carried = [c for c in wide.columns if c not in own]
        drifted = CASES[case](wide.withColumn("_own", F.struct(*[F.col(name(c)) for c in own])))
        renamed = RENAMED.get(case, {})
        tables[case] = {c: made.get(c) or renamed.get(c, c) for c in drifted.columns if c != "_own" and c not in carried}
        wide = drifted.select("_own.*", *[F.col(name(c)) for c in carried], *[F.col(name(c)).alias(to) for c, to in made.items()])
    return wide, tables
