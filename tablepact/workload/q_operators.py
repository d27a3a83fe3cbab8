"""Joins, aggregations, windows, sorts, set operations (J-*, A-*, W-*, O-*, U-*) and D-*."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..contract import ORDERS
from ..functions import text as X
from ..operators import aggregates as A
from ..operators import drift as G
from ..operators import ordering as R
from ..operators.asof import asof_backward, newest_per_group
from ..operators.diff import cell_diff, first_diffs
from ..operators.fingerprint import canonicalize
from ..operators.quantiles import approx_quantiles, medians, quantiles, value_counts
from ..plans import determinism as T
from ..plans.headers import drift
from ..sources.staging import materialize
from . import fixtures as fx
from . import oracle as O
from .registry import query

table = fx.table


def run(spark, sf, name):
    return fx.runs(spark, sf).where(F.col("run_id") == name)


# ---------------------------------------------------------------- joins
@query("join_inner_cells", """
SELECT t.order_id, t.unit_price AS expected, r.unit_price AS actual FROM truth t
JOIN (SELECT order_id, min(unit_price) AS unit_price FROM runs WHERE run_id = 'bad_duplicate' GROUP BY 1) r USING (order_id)""",
       ("truth", "runs"))
def _(spark, sf):
    out = R.keep_first(run(spark, sf, "bad_duplicate").select("order_id", "_ord", "unit_price"), ["order_id"])
    e = fx.truth(spark, sf).select("order_id", F.col("unit_price").alias("expected"))
    return e.join(out.select("order_id", F.col("unit_price").alias("actual")), "order_id")


@query("join_left_reference", """
SELECT t.order_id, t.order_date AS reference, r.order_date AS actual FROM truth t
LEFT JOIN (SELECT * FROM runs WHERE run_id = 'bad_swap') r USING (order_id)""", ("truth", "runs"))
def _(spark, sf):
    out = R.keep_first(run(spark, sf, "bad_swap").select("order_id", "_ord", "order_date"), ["order_id"])
    b = fx.truth(spark, sf).select("order_id", F.col("order_date").alias("reference"))
    return b.join(out.select("order_id", F.col("order_date").alias("actual")), "order_id", "left")


@query("join_full_outer_diff", """
SELECT side, count(*) AS keys FROM (
  SELECT CASE WHEN o.o_orderkey IS NULL THEN 'right_only' WHEN l.k IS NULL THEN 'left_only' ELSE 'both' END AS side
  FROM orders o FULL JOIN (SELECT DISTINCT l_orderkey + 7 AS k FROM lineitem) l ON o.o_orderkey = l.k) GROUP BY 1""")
def _(spark, sf):
    """Which side holds each key: both sides are tagged and folded, no outer join."""
    a = table(spark, sf, "orders").selectExpr("o_orderkey AS k", "1 AS side")
    b = table(spark, sf, "lineitem").selectExpr("l_orderkey + 7 AS k", "2 AS side")
    sides = a.unionByName(b).groupBy("k").agg(F.expr("bit_or(side)").alias("s"))
    return sides.groupBy(F.expr("CASE s WHEN 1 THEN 'left_only' WHEN 2 THEN 'right_only' ELSE 'both' END").alias("side")
                         ).agg(F.count(F.lit(1)).alias("keys"))


@query("anti_missing_keys", """
SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def _(spark, sf):
    o, l = table(spark, sf, "orders").select("o_orderkey"), table(spark, sf, "lineitem").select("l_orderkey")
    return o.join(l, o.o_orderkey == l.l_orderkey, "left_anti")


@query("anti_unexpected_keys", """
SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_anti")


@query("semi_imputed_rows", """
SELECT order_id, quantity FROM truth WHERE order_id IN (SELECT order_id FROM messy WHERE quantity = '')""", ("truth", "messy"))
def _(spark, sf):
    gone = fx.messy(spark, sf).where(X.is_missing("quantity")).select("order_id")
    return fx.truth(spark, sf).select("order_id", "quantity").join(gone, "order_id", "left_semi")


@query("asof_upload", """
SELECT p.event_id, u.event_id AS upload_id, epoch_us(u.ts) // 1000 AS upload_ms
FROM (SELECT *, epoch_us(ts) // 1000 AS ms FROM events WHERE event_type = 'purchase') p
ASOF LEFT JOIN (SELECT *, epoch_us(ts) // 1000 AS ms FROM events WHERE event_type = 'signup') u
  ON p.user_id = u.user_id AND p.ms >= u.ms""")
def _(spark, sf):
    from ..functions.dates import to_epoch_ms

    e = table(spark, sf, "events").selectExpr("event_id", "user_id", "event_type", f"{to_epoch_ms('ts')} AS ms")
    left = e.where("event_type = 'purchase'").selectExpr("event_id", "user_id", "ms AS ts_ms")
    right = e.where("event_type = 'signup'").selectExpr("event_id AS upload_id", "user_id", "ms AS upload_ms")
    m = asof_backward(left, right, ["user_id"], "ts_ms", "upload_ms", ["upload_id"], "upload_id")
    return m.selectExpr("event_id", "match.upload_id", "match.upload_ms")


@query("asof_upload_one_feed", """
SELECT p.event_id, u.event_id AS upload_id FROM (SELECT *, epoch_us(ts) // 1000 AS ms FROM events WHERE event_type = 'purchase') p
ASOF LEFT JOIN (SELECT *, epoch_us(ts) // 1000 AS ms FROM events WHERE event_type = 'signup') u ON p.ms >= u.ms""")
def _(spark, sf):
    """One feed for all events: the timeline is cut into hours, so no task holds it whole."""
    from ..functions.dates import to_epoch_ms

    e = table(spark, sf, "events").selectExpr("event_id", "event_type", f"{to_epoch_ms('ts')} AS ms")
    left = e.where("event_type = 'purchase'").selectExpr("event_id", "ms AS ts_ms")
    right = e.where("event_type = 'signup'").selectExpr("event_id AS upload_id", "ms AS upload_ms")
    m = asof_backward(left, right, [], "ts_ms", "upload_ms", ["upload_id"], "upload_id")
    return m.selectExpr("event_id", "match.upload_id")


@query("broadcast_case_meta", """
SELECT run_id, count(*) AS rows, max(e) - count(*) AS missing FROM runs, (SELECT count(*) AS e FROM truth) GROUP BY 1""",
       ("runs", "truth"))
def _(spark, sf):
    """Case facts (one row per case, from the manifest) attached to every run."""
    facts = fx.truth(spark, sf).groupBy(F.lit("baseline").alias("case")).agg(F.count(F.lit(1)).alias("expected"))
    runs = fx.runs(spark, sf).groupBy("case", "run_id").agg(F.count(F.lit(1)).alias("rows"))
    return runs.join(facts, "case").selectExpr("run_id", "rows", "expected - rows AS missing")


# ---------------------------------------------------------------- aggregations
@query("agg_count_if", """
SELECT l_linestatus, count(*) FILTER (l_quantity > 45) AS quantity_gt_45, count(*) FILTER (l_discount > 0.09) AS discount_gt_9,
  count(*) FILTER (l_tax = 0) AS untaxed, count(*) FILTER (l_returnflag NOT IN ('A', 'N')) AS returned FROM lineitem GROUP BY 1""")
def _(spark, sf):
    rules = {"quantity_gt_45": "l_quantity > 45", "discount_gt_9": "l_discount > 0.09D", "untaxed": "l_tax = 0",
             "returned": "l_returnflag NOT IN ('A', 'N')"}
    return table(spark, sf, "lineitem").groupBy("l_linestatus").agg(
        *[F.expr(f"count_if({e})").alias(n) for n, e in rules.items()])


@query("agg_median", """
SELECT l_returnflag, round(median(l_extendedprice), 6) AS price, round(median(l_quantity), 6) AS quantity FROM lineitem GROUP BY 1""")
def _(spark, sf):
    m = medians(table(spark, sf, "lineitem"), ["l_returnflag"], ["l_extendedprice", "l_quantity"])
    pick = lambda c: F.max(F.expr(f"CASE WHEN column = '{c}' THEN round(value, 6) END"))
    return m.groupBy("l_returnflag").agg(pick("l_extendedprice").alias("price"), pick("l_quantity").alias("quantity"))


@query("agg_quantile", """
SELECT o_orderpriority, unnest([0.05, 0.5, 0.95])::DOUBLE AS prob,
  round(unnest(quantile_cont(o_totalprice, [0.05, 0.5, 0.95])), 6) AS value FROM orders GROUP BY 1""")
def _(spark, sf):
    by = ["o_orderpriority", "column"]
    counts = value_counts(table(spark, sf, "orders"), ["o_orderpriority"], ["o_totalprice"])
    return quantiles(counts, by, [0.05, 0.5, 0.95]).selectExpr("o_orderpriority", "prob", "round(value, 6) AS value")


@query("agg_quantile_approx")
def _(spark, sf):
    """Sketch-based switch for quantiles; approximate, so no value oracle."""
    return approx_quantiles(table(spark, sf, "orders"), ["o_orderpriority"], "o_totalprice", [0.05, 0.5, 0.95])


@query("agg_min_max", """
SELECT l_shipdate_min, l_shipdate_max, qmin, qmax FROM (SELECT strftime(min(l_shipdate), '%Y-%m-%d') AS l_shipdate_min,
  strftime(max(l_shipdate), '%Y-%m-%d') AS l_shipdate_max, min(l_quantity) AS qmin, max(l_quantity) AS qmax FROM lineitem)""")
def _(spark, sf):
    return table(spark, sf, "lineitem").agg(
        F.expr("CAST(CAST(min(l_shipdate) AS DATE) AS STRING)").alias("l_shipdate_min"),
        F.expr("CAST(CAST(max(l_shipdate) AS DATE) AS STRING)").alias("l_shipdate_max"),
        F.min("l_quantity").alias("qmin"), F.max("l_quantity").alias("qmax"))


@query("agg_value_share", """
SELECT run_id, country AS value, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY run_id), 6) AS share
FROM runs WHERE country IS NOT NULL GROUP BY 1, 2""", ("runs",))
def _(spark, sf):
    h = A.histogram(fx.runs(spark, sf), ["run_id"], ["country"])
    return A.shares(h, ["run_id", "column"]).selectExpr("run_id", "value", "n", "round(share, 6) AS share")


@query("agg_month_share", """
SELECT CAST(month(l_shipdate) AS INTEGER) AS month, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM lineitem GROUP BY 1""")
def _(spark, sf):
    h = table(spark, sf, "lineitem").groupBy(F.month("l_shipdate").alias("month")).agg(F.count(F.lit(1)).alias("n"))
    return A.shares(h, [], "month").selectExpr("month", "round(share, 6) AS share")


@query("agg_duplicate_count", """
SELECT (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS duplicate_keys,
  (SELECT count(*) FROM documents) - (SELECT count(DISTINCT text) FROM documents) AS duplicate_texts""")
def _(spark, sf):
    keys = A.duplicate_keys(table(spark, sf, "lineitem"), [], ["l_orderkey", "l_linenumber"]).agg(
        F.sum(F.col("n") - 1).alias("n"))
    texts = A.duplicate_rows(table(spark, sf, "documents"), [], ["text"])
    return keys.select(F.col("n").alias("duplicate_keys"), texts.scalar().alias("duplicate_texts"))


@query("agg_distinct_examples", """
SELECT run_id, value FROM (SELECT run_id, country AS value, row_number() OVER (PARTITION BY run_id ORDER BY country) AS r
  FROM (SELECT DISTINCT run_id, country FROM runs WHERE country NOT IN ('Australia', 'United States', 'United Kingdom', 'India',
    'New Zealand', 'Unknown'))) WHERE r <= 5""", ("runs",))
def _(spark, sf):
    h = A.histogram(fx.runs(spark, sf), ["run_id"], ["country"])
    allowed = ORDERS["country"].allowed
    return A.first_values(h.where(~F.col("value").isin(*allowed)), ["run_id"], 5).select("run_id", "value")


_JS = """
SELECT {by}, round(CASE WHEN sum(p) = 0 OR sum(q) = 0 THEN 1 ELSE sqrt(greatest(0, sum(
  CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2)) END, 6)
  AS js_distance FROM {src} GROUP BY {by}"""


@query("agg_js_distance", """
, s AS (SELECT day(ts) > 15 AS late, event_type || ':' || user_id % 20 AS v, user_id % 3 AS grp, count(*) AS n FROM events GROUP BY ALL),
t AS (SELECT late, grp, v, n / sum(n) OVER (PARTITION BY late, grp) AS share FROM s),
j AS (SELECT grp, v, sum(CASE WHEN late THEN 0 ELSE share END) AS p, sum(CASE WHEN late THEN share ELSE 0 END) AS q FROM t GROUP BY 1, 2)
""".replace(", s AS", "WITH s AS", 1) + _JS.format(by="grp", src="j"))
def _(spark, sf):
    """Event mix of the first against the second half of the month."""
    e = table(spark, sf, "events").selectExpr(
        "day(ts) > 15 AS late", "user_id % 3 AS grp", "concat(event_type, ':', user_id % 20) AS value")
    s = A.shares(e.groupBy("late", "grp", "value").agg(F.count(F.lit(1)).alias("n")), ["late", "grp"])
    d = A.js_distance(s.where("NOT late"), s.where("late"), ["grp"])
    return d.selectExpr("grp", "round(js_distance, 6) AS js_distance")


@query("drift_orderpriority_by_year", """
WITH s AS (SELECT year(o_orderdate) AS y, o_orderpriority AS v, count(*) AS n FROM orders GROUP BY ALL),
t AS (SELECT y, v, n / sum(n) OVER (PARTITION BY y) AS share FROM s),
j AS (SELECT a.y, a.v, a.share AS p, b.share AS q FROM t a JOIN t b ON a.v = b.v AND b.y = 1995 WHERE a.y > 1995)
""" + _JS.format(by="y", src="j"))
def _(spark, sf):
    """Priority mix of each later year against 1995."""
    o = table(spark, sf, "orders").selectExpr("CAST(year(o_orderdate) AS BIGINT) AS y", "o_orderpriority AS value")
    s = A.shares(o.groupBy("y", "value").agg(F.count(F.lit(1)).alias("n")), ["y"])
    years = s.where("y > 1995")
    # The base year's few shares are repeated for each later year that occurs.
    later = years.select("y").distinct().agg(F.collect_list("y").alias("ys")).scalar()
    base = s.where("y = 1995").select(F.explode(later).alias("y"), "value", "share")
    return A.js_distance(years, base, ["y"]).selectExpr("y", "round(js_distance, 6) AS js_distance")


# ---------------------------------------------------------------- windows
@query("win_keep_first", """
SELECT order_id, _ord AS ord, status FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY _ord) AS r FROM messy)
WHERE r = 1""", ("messy",))
def _(spark, sf):
    return R.keep_first(fx.messy(spark, sf).select("order_id", "_ord", "status"), ["order_id"]).selectExpr(
        "order_id", "_ord AS ord", "status")


@query("win_lag_break", """
SELECT run_id, count(*) AS rows, min(CASE WHEN k < prev THEN pos END) AS first_break FROM (
  SELECT run_id, CAST(order_id AS DOUBLE) AS k, lag(CAST(order_id AS DOUBLE)) OVER w AS prev, row_number() OVER w AS pos
  FROM runs WINDOW w AS (PARTITION BY run_id ORDER BY _ord)) GROUP BY 1
UNION ALL SELECT 'messy', count(*), min(CASE WHEN k < prev THEN pos END) FROM (
  SELECT CAST(order_id AS DOUBLE) AS k, lag(CAST(order_id AS DOUBLE)) OVER w AS prev, row_number() OVER w AS pos
  FROM messy WINDOW w AS (ORDER BY _ord))""", ("runs", "messy"))
def _(spark, sf):
    df = fx.runs(spark, sf).select("run_id", "_ord", "order_id").unionByName(
        fx.messy(spark, sf).select(F.lit("messy").alias("run_id"), "_ord", "order_id"))
    return R.order_breaks(df, ["run_id"], F.expr("CAST(order_id AS DOUBLE)"), rows=1 << 12).select(
        "run_id", "rows", "first_break")


@query("win_duplicates_all", """
SELECT order_id, _ord AS ord FROM (SELECT *, count(*) OVER (PARTITION BY order_id) AS n FROM messy) WHERE n > 1""", ("messy",))
def _(spark, sf):
    """Every member of a duplicate group: repeated keys are counted first, then their rows are kept."""
    df = fx.messy(spark, sf).select("order_id", "_ord")
    return df.join(A.duplicate_keys(df, [], ["order_id"]), "order_id", "left_semi").withColumnRenamed("_ord", "ord")


@query("win_latest_run", """
SELECT user_id, event_id, CAST(r AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r
  FROM events WHERE event_type <> 'error') WHERE r <= 3""")
def _(spark, sf):
    """Newest three runs per case that did not fail."""
    ok = table(spark, sf, "events").where("event_type <> 'error'")
    return newest_per_group(ok, ["user_id"], ["ts", "event_id"], 3).select("user_id", "event_id", "rank")


@query("win_group_consistent_value", f"""
SELECT _ord AS ord, order_id, {O._CODE} AS code FROM messy""", ("messy",))
def _(spark, sf):
    return G.s4_add(fx.messy(spark, sf)).selectExpr("_ord AS ord", "order_id", "discount_code AS code")


# ---------------------------------------------------------------- sorts, limits
@query("sort_by_key", """
SELECT order_id, _ord AS ord FROM messy ORDER BY CAST(order_id AS BIGINT), _ord""", ("messy",))
def _(spark, sf):
    m = fx.messy(spark, sf).selectExpr("_ord", "_ord AS ord", "order_id")
    return R.sort_by_key(m, F.expr("CAST(order_id AS BIGINT)")).select("order_id", "ord")


@query("sort_canonical", f"SELECT {O.COLS} FROM truth ORDER BY CAST(order_id AS BIGINT)", ("truth",))
def _(spark, sf):
    cols = ORDERS.names
    c = canonicalize(run(spark, sf, "bad_format").select(*cols), [], cols)
    return c.orderBy(F.expr("try_cast(order_id AS BIGINT)").asc_nulls_last(), *[x for x in cols if x != "order_id"])


@query("topk_values", """
SELECT value, n FROM (SELECT country AS value, count(*) AS n FROM messy WHERE country NOT IN ('', 'Australia', 'United States',
  'United Kingdom', 'India', 'New Zealand', 'Unknown') GROUP BY 1) ORDER BY n DESC, value LIMIT 10""", ("messy",))
def _(spark, sf):
    h = A.histogram(fx.messy(spark, sf), [], ["country"])
    bad = h.where(~F.col("value").isin(*ORDERS["country"].allowed)).drop("column")
    return bad.orderBy(F.desc("n"), F.asc("value")).limit(10)


@query("limit_examples", "SELECT DISTINCT order_id FROM messy WHERE quantity = '' ORDER BY CAST(order_id AS BIGINT) LIMIT 10", ("messy",))
def _(spark, sf):
    return fx.messy(spark, sf).where("quantity = ''").select("order_id").distinct().orderBy(
        F.expr("CAST(order_id AS BIGINT)")).limit(10)


@query("topk_newest", """
SELECT 'orders_clean_' || epoch_us(ts) // 1000 || '.csv' AS name, epoch_us(ts) // 1000 AS ts_ms FROM events
WHERE event_type = 'purchase' AND event_id % 7 <> 0 ORDER BY 2 DESC, 1 LIMIT 10""")
def _(spark, sf):
    from ..sources.tables import latest_outputs
    from .q_log import output_objects

    return latest_outputs(output_objects(spark, sf).where("dated"), "orders_clean", 10).select("name", "ts_ms")


# ---------------------------------------------------------------- sets
@query("set_distinct_rows", f"SELECT min(_ord) AS ord, {O.COLS} FROM messy GROUP BY ALL", ("messy",))
def _(spark, sf):
    return R.distinct_rows(fx.messy(spark, sf)).withColumnRenamed("_ord", "ord")


@query("set_except", """
SELECT order_id FROM messy EXCEPT SELECT order_id FROM truth""", ("messy", "truth"))
def _(spark, sf):
    return fx.messy(spark, sf).select("order_id").subtract(fx.truth(spark, sf).select("order_id"))


@query("set_union_rows", f"""
SELECT order_id, status FROM messy UNION ALL SELECT order_id, status FROM truth""", ("messy", "truth"))
def _(spark, sf):
    return fx.messy(spark, sf).select("order_id", "status").unionByName(fx.truth(spark, sf).select("order_id", "status"))


@query("set_header_diff", f"""
SELECT run_id, array_to_string(list_filter([{', '.join(O.q(c) for c in fx.COLUMNS)}], lambda c: NOT list_contains(present, c)), ',') AS removed,
  array_to_string(list_filter(present, lambda c: NOT list_contains([{', '.join(O.q(c) for c in fx.COLUMNS)}], c)), ',') AS added, rows FROM (
  SELECT run_id, list_filter([{', '.join(f"CASE WHEN count({c}) > 0 THEN '{c}' END" for c in [*fx.COLUMNS, fx.EXTRA])}], lambda c: c IS NOT NULL) AS present, count(*) AS rows FROM runs GROUP BY 1)""", ("runs",))
def _(spark, sf):
    """Columns that each run's stored files lack or add, with the run's rows."""
    diff = drift(fx.stored_headers(spark, sf), fx.COLUMNS).select("run_id", F.array_join("removed", ",").alias("removed"), F.array_join("added", ",").alias("added"))
    return fx.runs(spark, sf).groupBy("run_id").agg(F.count(F.lit(1)).alias("rows")).join(diff, "run_id")


@query("set_new_categories", """
SELECT run_id, country AS value, count(*) AS n FROM runs WHERE country NOT IN (SELECT country FROM truth) GROUP BY 1, 2""",
       ("runs", "truth"))
def _(spark, sf):
    h = A.histogram(fx.runs(spark, sf), ["run_id"], ["country"])
    known = fx.truth(spark, sf).select(F.col("country").alias("value"))
    return h.join(known, "value", "left_anti").select("run_id", "value", "n")


# ---------------------------------------------------------------- determinism and diff
@query("canonicalize", f"""
SELECT run_id, {', '.join(c if c not in ('unit_price',) else "CASE run_id WHEN 'bad_cents' THEN CAST(CAST(CAST(unit_price AS DOUBLE) AS BIGINT) AS VARCHAR) ELSE unit_price END AS unit_price" for c in O.C if c not in ('order_date', 'quantity', 'category', 'customer_name'))},
  CASE WHEN run_id = 'bad_format' THEN substr(order_date, 1, 10) ELSE order_date END AS order_date,
  CASE WHEN run_id = 'bad_format' THEN replace(quantity, '.0', '') ELSE quantity END AS quantity,
  CASE WHEN category = 'None' THEN '' ELSE category END AS category, trim(customer_name) AS customer_name FROM runs""", ("runs",))
def _(spark, sf):
    cols = ORDERS.names
    return canonicalize(fx.runs(spark, sf).select("run_id", *cols), ["run_id"], cols)


@query("run_fingerprint", f"""
, c AS (SELECT run_id, {', '.join(c for c in O.C if c not in ('order_date', 'quantity', 'category', 'customer_name', 'unit_price'))},
  CASE WHEN run_id = 'bad_format' THEN substr(order_date, 1, 10) ELSE order_date END AS order_date,
  CASE WHEN run_id = 'bad_format' THEN replace(quantity, '.0', '') ELSE quantity END AS quantity, unit_price,
  CASE WHEN category = 'None' THEN '' ELSE category END AS category, trim(customer_name) AS customer_name FROM runs),
f AS (SELECT run_id, count(*) AS rows, sum(hash({O.COLS})) AS h FROM c GROUP BY 1)
SELECT run_id, rows, h = (SELECT h FROM f WHERE run_id = 'good') AND run_id <> 'bad_reorder' AS same_as_good FROM f""", ("runs",))
def _(spark, sf):
    runs, heads, cols = fx.runs(spark, sf), fx.run_headers(), ORDERS.names
    prints, _ = materialize(T.run_fingerprints(spark, runs, heads, cols), "prints")  # one row per run
    good = prints.where("run_id = 'good'").agg(F.max("content_hash").alias("h")).scalar()
    return prints.select("run_id", "rows", (F.col("content_hash") == good).alias("same_as_good"))


_DIFF_COLS = [c for c in O.C if c != "order_id"]


def _diff_sql() -> str:
    cells = " UNION ALL ".join(
        f"SELECT r.run_id, t.order_id, '{c}' AS \"column\", t.{c} AS a, r.{c} AS b FROM truth t JOIN runs r USING (order_id) "
        f"WHERE r.run_id IN ('bad_missing', 'bad_cell', 'bad_range', 'bad_imputation') AND t.{c} IS DISTINCT FROM r.{c}"
        for c in _DIFF_COLS)
    return cells + """ UNION ALL SELECT 'bad_missing', order_id, '<row>', 'true', 'false' FROM truth
      WHERE order_id NOT IN (SELECT order_id FROM runs WHERE run_id = 'bad_missing')"""


@query("cell_diff", _diff_sql(), ("truth", "runs"))
def _(spark, sf):
    names = ["bad_missing", "bad_cell", "bad_range", "bad_imputation"]
    b = fx.runs(spark, sf).where(F.col("run_id").isin(*names)).select("run_id", *ORDERS.names)
    a = fx.truth(spark, sf).select(*ORDERS.names).withColumn("run_id", F.explode(F.array(*[F.lit(n) for n in names])))
    return cell_diff(a, b, "order_id", ORDERS.names, by=["run_id"]).drop("copies")


@query("cell_diff_duplicates", """
SELECT order_id, column0 AS "column", count(*) AS copies FROM (SELECT order_id, unnest(['customer_name', 'country', 'status']) AS column0
  FROM truth WHERE k % 500 = 65) GROUP BY ALL""", ("truth",))
def _(spark, sf):
    """A key repeated on one side: surplus cell values instead of all pairs of copies."""
    cols = ["customer_name", "country", "status"]
    a = fx.truth(spark, sf).select("order_id", *cols)
    b = run(spark, sf, "bad_duplicate").select("order_id", *cols)
    return cell_diff(a, b, "order_id", ["order_id", *cols]).select("order_id", "column", "copies")


@query("cell_diff_excerpt", """
SELECT t.order_id, 'quantity' AS "column", t.quantity AS a, r.quantity AS b FROM truth t JOIN runs r USING (order_id)
WHERE r.run_id = 'bad_imputation' AND t.quantity <> r.quantity ORDER BY t.k LIMIT 50""", ("truth", "runs"))
def _(spark, sf):
    d = cell_diff(fx.truth(spark, sf).select(*ORDERS.names), run(spark, sf, "bad_imputation").select(*ORDERS.names),
                  "order_id", ORDERS.names)
    return first_diffs(d, "order_id", 50).drop("copies")


@query("pairwise_vs_first", """
SELECT run_id, count(*) AS cells FROM (""" + " UNION ALL ".join(
    f"SELECT r.run_id FROM truth t JOIN runs r USING (order_id) WHERE r.run_id IN ('bad_cell', 'bad_null', 'bad_cents') "
    f"AND t.{c} IS DISTINCT FROM r.{c}" for c in _DIFF_COLS) + ") GROUP BY 1", ("truth", "runs"))
def _(spark, sf):
    names = ["good", "bad_cell", "bad_null", "bad_format", "bad_cents"]
    runs = fx.runs(spark, sf).where(F.col("run_id").isin(*names)).select("run_id", *ORDERS.names)
    heads = {r: h for r, h in fx.run_headers().items() if r in names}
    prints = T.run_fingerprints(spark, runs, heads, ORDERS.names)
    d = T.diffs_vs_first(runs, prints, "good", "order_id", [c for c in ORDERS.names if c != "order_id"])
    return d.groupBy("run_id").agg(F.count(F.lit(1)).alias("cells"))
