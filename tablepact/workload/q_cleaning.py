"""Contract cleaner (clean_*), row accounting, ground truth, manifest (2.9, G-9..G-12)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..contract import ORDERS
from ..functions import dates as D
from ..operators import drift as G
from ..operators.clean import clean, row_accounting
from ..operators.fingerprint import canonicalize, shared_fingerprints
from . import fixtures as fx
from . import oracle as O
from .registry import query

_N = f"(({O.normalised('messy', O.C)}) n)"


def _upto(step):
    def run(spark, sf):
        return clean(fx.messy(spark, sf), ORDERS, until=step).withColumnRenamed("_ord", "ord")
    return run


def _raw(**exprs):
    return "SELECT _ord AS ord, " + ", ".join(f"{exprs[c]} AS {c}" if c in exprs else c for c in O.C) + " FROM messy"


_text = {c: O.norm_ws(c) for c in ("customer_name", "email", "country", "product", "category", "status")}
_case = {**_text, "customer_name": O.title(_text["customer_name"]), "email": f"lower({_text['email']})",
         "status": f"lower({_text['status']})"}
_map = {**_case, "country": f"coalesce({O.case(f'lower({_text["country"]})', O.MAP)}, {_text['country']})"}
_date = {**_map, "order_date": f"coalesce(strftime({O._valid('order_date')}, '%Y-%m-%d'), '')"}

query("clean_step_text", _raw(**_text), ("messy",))(_upto("text"))
query("clean_step_case", _raw(**_case), ("messy",))(_upto("case"))
query("clean_step_map", _raw(**_map), ("messy",))(_upto("map"))
query("clean_step_date", _raw(**_date), ("messy",))(_upto("date"))
_VALID = f"({O.normalised('messy', O.C)}) n WHERE {O.reason(O.C)} IS NULL"
query("clean_step_invalid", f"SELECT _ord AS ord, {O.COLS} FROM {_VALID}", ("messy",))(_upto("reject"))
_MAIL = ", ".join("CASE WHEN contains(email, '@') THEN email ELSE '' END AS email" if c == "email" else c for c in O.C)
query("clean_step_email", f"SELECT _ord AS ord, {_MAIL} FROM {_VALID}", ("messy",))(_upto("email"))


def _after(select: str) -> str:
    return O.with_ctes(("messy",), "").strip() + ", " + O.cleaned_ctes("messy", O.C, "x") + " " + select


query("clean_step_dedupe", _after(f"SELECT _ord AS ord, {O.COLS} FROM xd"))(_upto("dedupe"))
_imp = {"quantity": "coalesce(quantity, round_even(mq, 0))",
        "unit_price": "coalesce(unit_price, CAST(format('{:.2f}', mp) AS DOUBLE))",
        "country": "CASE WHEN country = '' THEN 'Unknown' ELSE country END",
        "customer_name": "CASE WHEN customer_name = '' THEN 'Unknown' ELSE customer_name END"}
query("clean_step_impute", _after(
    "SELECT _ord AS ord, " + ", ".join(f"{_imp[c]} AS {c}" if c in _imp else c for c in O.C) + " FROM xd, xm"
))(_upto("impute"))


@query("clean_step_format", _after(f"SELECT {O.COLS} FROM xc"))
def _(spark, sf):
    return clean(fx.messy(spark, sf), ORDERS, until="format").drop("_ord")


@query("clean_step_sort", """
SELECT order_id, row_number() OVER (ORDER BY k) AS position FROM truth""", ("truth",))
def _(spark, sf):
    """Output positions: partition number and row inside it give the rank, without a global window."""
    out = clean(fx.messy(spark, sf), ORDERS).select("order_id", "_ord")
    part = out.withColumn("part", F.expr("shiftright(_ord, 33)"))
    from pyspark.sql import Window

    sizes = part.groupBy("part").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "before", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    return part.join(sizes, "part").selectExpr("order_id", "before + (_ord & 8589934591) + 1 AS position")


@query("clean_orders", f"SELECT {O.COLS} FROM truth", ("truth",))
def _(spark, sf):
    """Flagship: the whole cleaner; the oracle is the ground truth, not a second cleaner."""
    return clean(fx.messy(spark, sf), ORDERS).drop("_ord")


@query("row_accounting", """, n AS (""" + O.normalised("messy", O.C) + f"""),
r AS (SELECT *, {O.reason(O.C)} AS why, CASE WHEN contains(email, '@') THEN email ELSE '' END AS mail FROM n),
c AS (SELECT count(*) AS rows_in, count(*) FILTER (why = 'order_date_unparseable') AS d, count(*) FILTER (why = 'quantity_le') AS q,
  count(*) FILTER (why = 'unit_price_lt') AS p, count(*) FILTER (why = 'status_not_allowed') AS s, count(*) FILTER (why IS NULL) AS valid FROM r),
u AS (SELECT count(*) AS rows_out FROM (SELECT DISTINCT {O.COLS.replace('email', 'mail')} FROM r WHERE why IS NULL))
SELECT unnest(['rows_in', 'duplicates', 'invalid:order_date_unparseable', 'invalid:quantity_le', 'invalid:unit_price_lt',
  'invalid:status_not_allowed', 'rows_out']) AS item, unnest([rows_in, valid - rows_out, d, q, p, s, rows_out]) AS rows FROM c, u""", ("messy",))
def _(spark, sf):
    return row_accounting(fx.messy(spark, sf), ORDERS).select("item", "rows")


# ---------------------------------------------------------------- inputs and ground truth
@query("inject_defects", f"SELECT _ord AS ord, {O.COLS} FROM messy", ("messy",))
def _(spark, sf):
    return fx.messy_orders(spark, sf).withColumnRenamed("_ord", "ord")


@query("build_expected", f"SELECT {O.COLS} FROM truth", ("truth",))
def _(spark, sf):
    return fx.clean_truth(spark, sf).drop("k")


@query("agg_defect_counts", """
SELECT count(*) AS rows_in, count(DISTINCT order_id) AS unique_orders, count(*) FILTER (quantity = '') AS missing_quantity,
  count(*) FILTER (unit_price = '') AS missing_unit_price, count(*) FILTER (email = '') AS missing_email,
  count(*) FILTER (country = '') AS missing_country, count(*) FILTER (customer_name = '') AS missing_customer_name,
  count(*) FILTER (email <> '' AND NOT contains(email, '@')) AS malformed_email,
  count(*) FILTER (TRY_CAST(quantity AS INT) <= 0) AS quantity_le_zero, count(*) FILTER (starts_with(unit_price, '-')) AS negative_price,
  count(*) FILTER (regexp_matches(order_date, '^\\d{4}-')) AS iso_dates
FROM messy""", ("messy",))
def _(spark, sf):
    counts = {
        "missing_quantity": "quantity = ''", "missing_unit_price": "unit_price = ''", "missing_email": "email = ''",
        "missing_country": "country = ''", "missing_customer_name": "customer_name = ''",
        "malformed_email": "email <> '' AND NOT contains(email, '@')", "quantity_le_zero": "try_cast(quantity AS INT) <= 0",
        "negative_price": "startswith(unit_price, '-')", "iso_dates": "order_date RLIKE '^[0-9]{4}-'",
    }
    # Copies of an order are folded first, so distinct orders need no second pass.
    per_order = fx.messy(spark, sf).groupBy("order_id").agg(
        F.expr("count(*)").alias("n"), *[F.expr(f"count_if({e})").alias(k) for k, e in counts.items()])
    return per_order.agg(F.sum("n").alias("rows_in"), F.count(F.lit(1)).alias("unique_orders"),
                         *[F.sum(k).alias(k) for k in counts])


def _case_input(spark, sf, name):
    return G.CASES[name](fx.messy(spark, sf))


def _manifest_sql() -> str:
    parts = []
    for n, cols in O.DRIFT_COLUMNS.items():
        expected = "(SELECT count(*) FROM truth)" + (" + 1" if n == "probe-extra-row" else "")
        parts.append(f"SELECT {O.q(n)} AS \"case\", (SELECT count(*) FROM ({O.drifted(n)})) AS rows_in, "
                     f"{O.q(','.join(cols))} AS header, {expected} AS expected_rows_out")
    return " UNION ALL ".join(parts)


@query("dataset_manifest", _manifest_sql(), ("messy", "truth"))
def _(spark, sf):
    expected = fx.truth(spark, sf).agg(F.count(F.lit(1)).alias("n")).scalar()
    out = None
    for name in G.CASES:
        df = _case_input(spark, sf, name)
        header = ",".join(c for c in df.columns if c != "_ord")
        row = df.agg(F.count(F.lit(1)).alias("rows_in")).select(
            F.lit(name).alias("case"), "rows_in", F.lit(header).alias("header"),
            (expected + (1 if name == "probe-extra-row" else 0)).alias("expected_rows_out"))
        out = row if out is None else out.unionByName(row)
    return out


@query("manifest_content_hashes", """
SELECT unnest(['S1', 'S2', 'S3', 'S4', 'S5', 'M1', 'M2', 'M3']) AS "case", false AS same_as_baseline""")
def _(spark, sf):
    """Content hash of every drifted input against the baseline's. What the inputs share is rewritten and hashed once."""
    base = fx.messy(spark, sf).drop("_ord")
    wide, tables = G.side_by_side(base, ("baseline", "S1", "S2", "S3", "S4", "S5", "M1", "M2", "M3"))
    prints = shared_fingerprints(canonicalize(wide, [], wide.columns), tables)
    same = F.col("content_hash") == F.max(F.expr("CASE WHEN `table` = 'baseline' THEN content_hash END")).over(Window.partitionBy())
    return prints.select(F.col("table").alias("case"), same.alias("same_as_baseline")).where("case <> 'baseline'")


@query("manifest_day_split", """
SELECT count(*) FILTER (day(order_date) > 12) AS day_gt_12, count(*) FILTER (day(order_date) <= 12) AS day_le_12
FROM typed WHERE m >= 5 AND m NOT BETWEEN 21 AND 24""", ("typed",))
def _(spark, sf):
    """How many valid MM/DD rows a swapped date format loses, and how many it silently changes."""
    d = D.parse_formats("order_date", ["%m/%d/%Y"])
    valid = clean(fx.messy(spark, sf).withColumn("day", F.expr(f"day({d})")), ORDERS, until="reject")
    per_order = valid.where("day IS NOT NULL").groupBy("order_id").agg(F.max("day").alias("day"))
    return per_order.agg(F.expr("count_if(day > 12)").alias("day_gt_12"), F.expr("count_if(day <= 12)").alias("day_le_12"))


# ---------------------------------------------------------------- drift operators
for _case_name, _query_name in {
    "S1": "drift_s1_drop", "S2": "drift_s2_rename", "S3": "drift_s3_type", "S4": "drift_s4_add",
    "S5": "drift_s5_combined", "M1": "drift_m1_cents", "M2": "drift_m2_date_swap", "M3": "drift_m3_iso_codes",
    "probe-extra-row": "probe_extra_row",
}.items():
    def _drift(spark, sf, name=_case_name):
        return _case_input(spark, sf, name).withColumnRenamed("_ord", "ord")

    query(_query_name, f"SELECT _ord AS ord, * EXCLUDE (_ord) FROM ({O.drifted(_case_name)})", ("messy",))(_drift)


def _predicted_sql(n: str) -> str:
    cols = O.DRIFT_COLUMNS[n]
    return (O.with_ctes(("messy",), "").strip() + f", src AS ({O.drifted(n)}), " + O.cleaned_ctes("src", cols, "x")
            + f" SELECT {', '.join(cols)} FROM xc")


for _case_name in G.CASES:
    if _case_name == "baseline":
        continue

    def _predict(spark, sf, name=_case_name):
        return clean(_case_input(spark, sf, name), ORDERS).drop("_ord")

    query(f"predict_output_{_case_name.replace('-', '_')}", _predicted_sql(_case_name))(_predict)
