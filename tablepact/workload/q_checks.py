"""Checks over all saved runs (2.10): one flat query per check, then the full validation."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ..contract import ORDERS
from ..operators import drift as G
from ..operators.aggregates import status_counts, status_rollup, top_values
from ..operators.clean import clean
from ..operators.ordering import ORD
from ..plans import metrics as M
from ..plans import profile as P
from ..plans.headers import by_run, folder_value
from ..plans.runs import RunSet
from ..plans.validate import CHECKS, SEMANTIC, STRUCTURAL, summarize, validate_run, validate_runs
from ..sources.staging import materialize, new_path, staged
from ..sources.tables import csv_headers, read_check_reports, write_check_report, write_clean_csv
from . import fixtures as fx
from . import oracle as O
from .registry import query

NUMBERS = ("order_id", "quantity", "unit_price")
NULL_OK = ("email",)
ALLOWED = {c.name: c.allowed for c in ORDERS.columns if c.allowed}
RULES = {c.name: c.rules for c in ORDERS.columns if c.rules}
_NAMES = O._names


def _in(values) -> str:
    return "(" + ", ".join(O.q(v) for v in values) + ")"


def _rule(rule: str, v: str) -> str:
    return {
        "trimmed": f"regexp_replace({v}, '^{O.SPACE}+|{O.SPACE}+$', '', 'g') = {v}",
        "single_spaced": f"NOT contains({v}, '  ')", "title_case": f"{v} = {O.title(v)}",
        "lower_case": f"{v} = lower({v})", "contains_at": f"contains({v}, '@')",
    }[rule]


def cells(check: str):
    def run(spark, sf):
        rs = fx.run_set(spark, sf)
        m = M.cell_metrics(rs.outputs, ORDERS, ["run_id"], [check])
        return m.select("run_id", F.explode("cells").alias("c")).select("run_id", "c.*")
    return run


def _union(parts, src: str = "runs") -> str:
    return " UNION ALL ".join(p.format(src=src) for p in parts)


# ---------------------------------------------------------------- single-cell checks, as SQL over a runs table
def sch02_sql(src="runs") -> str:
    parts = []
    for c in ORDERS.columns:
        if c.dtype == "string":
            continue
        good = {"int": f"coalesce({O.num(c.name)} % 1 = 0, false)", "float": f"{O.num(c.name)} IS NOT NULL",
                "date": f"{O.dt(c.name)} IS NOT NULL"}[c.dtype]
        parts.append(f"SELECT run_id, '{c.name}' AS \"column\", count(*) FILTER (NOT {O.isnull(c.name)}) AS present, "
                     f"count(*) FILTER (NOT {O.isnull(c.name)} AND NOT {good}) AS violations FROM {src} GROUP BY 1")
    return " UNION ALL ".join(parts)


def cln02_sql(src="runs") -> str:
    return " UNION ALL ".join(
        f"SELECT run_id, '{c}' AS \"column\", count(*) FILTER ({c} IS NOT NULL AND {O.isnull(c)}) AS violations FROM {src} GROUP BY 1"
        for c in O.C if c not in NULL_OK)


def cln03_sql(src="runs") -> str:
    return " UNION ALL ".join(
        f"SELECT run_id, '{c}' AS \"column\", '{r}' AS rule, count(*) FILTER (NOT {O.isnull(c)} AND NOT ({_rule(r, c)})) AS violations "
        f"FROM {src} GROUP BY 1" for c, rules in RULES.items() for r in rules)


def cln04_sql(src="runs") -> str:
    return " UNION ALL ".join(
        f"SELECT run_id, '{c}' AS \"column\", count(*) FILTER (NOT {O.isnull(c)} AND {c} NOT IN {_in(a)}) AS violations "
        f"FROM {src} GROUP BY 1" for c, a in ALLOWED.items())


def cln05_sql(src="runs") -> str:
    g = lambda x: f"CASE WHEN {x} % 1 = 0 THEN CAST(CAST({x} AS BIGINT) AS VARCHAR) ELSE CAST({x} AS VARCHAR) END"
    q, p, d = O.num("quantity"), O.num("unit_price"), O.dt("order_date")
    return (
        f"SELECT run_id, 'quantity' AS \"column\", count(*) FILTER ({q} < 1 OR {q} > 20) AS violations, {g(f'min({q})')} AS min_seen, {g(f'max({q})')} AS max_seen FROM {src} GROUP BY 1 "
        f"UNION ALL SELECT run_id, 'unit_price', count(*) FILTER ({p} < 1 OR {p} > 1999.99), {g(f'min({p})')}, {g(f'max({p})')} FROM {src} GROUP BY 1 "
        f"UNION ALL SELECT run_id, 'order_date', count(*) FILTER ({d} < TIMESTAMP '2026-01-01' OR {d} > TIMESTAMP '2026-06-30'), "
        f"strftime(min({d}), '%Y-%m-%d'), strftime(max({d}), '%Y-%m-%d') FROM {src} GROUP BY 1")


def cln09_sql(src="runs") -> str:
    parts = [f"SELECT run_id, '{c}' AS \"column\", 'null_token' AS rule, count(*) FILTER ({c} <> '' AND {O.isnull(c)}) AS violations "
             f"FROM {src} GROUP BY 1" for c in O.C]
    for c, rule, rx in (("order_id", "not_integer_literal", r"-?\d+"), ("quantity", "not_integer_literal", r"-?\d+"),
                        ("unit_price", "not_2dp", r"-?\d+\.\d{2}"), ("order_date", "not_YYYY-MM-DD", r"\d{4}-\d{2}-\d{2}")):
        parts.append(f"SELECT run_id, '{c}', '{rule}', count(*) FILTER (NOT {O.isnull(c)} AND NOT regexp_full_match({c}, '{rx}')) "
                     f"FROM {src} GROUP BY 1")
    return " UNION ALL ".join(parts)


def _typed(columns):
    def wrap(fn):
        def run(spark, sf):
            return fn(spark, sf).select(*columns)
        return run
    return wrap


query("check_sch02_types", sch02_sql(), ("runs",))(_typed(["run_id", "column", "present", "violations"])(cells("SCH-02")))
query("check_cln02_nulls", cln02_sql(), ("runs",))(_typed(["run_id", "column", "violations"])(cells("CLN-02")))
query("check_cln03_text_rules", cln03_sql(), ("runs",))(_typed(["run_id", "column", "rule", "violations"])(cells("CLN-03")))
query("check_cln04_allowed", cln04_sql(), ("runs",))(_typed(["run_id", "column", "violations"])(cells("CLN-04")))
query("check_cln05_ranges", cln05_sql(), ("runs",))(
    _typed(["run_id", "column", "violations", "min_seen", "max_seen"])(cells("CLN-05")))
query("check_cln09_representation", cln09_sql(), ("runs",))(_typed(["run_id", "column", "rule", "violations"])(cells("CLN-09")))


@query("offending_values", " UNION ALL ".join(
    f"SELECT run_id, '{c}' AS \"column\", {c} AS value, count(*) AS n FROM runs WHERE NOT {O.isnull(c)} AND {c} NOT IN {_in(a)} GROUP BY 1, 3"
    for c, a in ALLOWED.items()), ("runs",))
def _(spark, sf):
    rs = fx.run_set(spark, sf)
    return M.offending_values(rs.outputs, ORDERS, ["run_id"], ["CLN-04"]).select("run_id", "column", "value", "n")


@query("offending_top_values", f"""
SELECT run_id, value, n FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY n DESC, value) AS r FROM (
  SELECT run_id, country AS value, count(*) AS n FROM runs WHERE NOT {O.isnull('country')} AND country NOT IN {_in(ALLOWED['country'])} GROUP BY 1, 2))
WHERE r <= 3""", ("runs",))
def _(spark, sf):
    rs = fx.run_set(spark, sf)
    bad = M.offending_values(rs.outputs, ORDERS, ["run_id"], ["CLN-04"])
    return top_values(bad, ["run_id", "column"], 3).select("run_id", "value", "n")


# ---------------------------------------------------------------- headers, rows, duplicates, order


def checked(*ids):
    def run(spark, sf):
        r = validate_runs(fx.run_set(spark, sf), list(ids))
        return r.select("run_id", "check_id", "status")
    return run


def _status(cond_fail: str, check: str, otherwise: str = "PASS", bad: str = "FAIL", src: str = "runs") -> str:
    return f"SELECT run_id, '{check}' AS check_id, CASE WHEN {cond_fail} THEN '{bad}' ELSE '{otherwise}' END AS status FROM {src} GROUP BY 1"


SCH01 = ("SELECT run_id, 'SCH-01' AS check_id, CASE WHEN run_id IN ('bad_rename', 'bad_drop') THEN 'FAIL' "
         "WHEN run_id = 'bad_reorder' THEN 'WARN' ELSE 'PASS' END AS status FROM runs GROUP BY 1")
SCH03 = "SELECT run_id, 'SCH-03' AS check_id, 'PASS' AS status FROM runs GROUP BY 1"
ROW03 = "SELECT run_id, 'ROW-03' AS check_id, CASE WHEN count(*) = 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM runs GROUP BY 1"
ROW01 = ("SELECT run_id, 'ROW-01' AS check_id, CASE WHEN count(*) = (SELECT count(*) FROM truth) THEN 'PASS' ELSE 'FAIL' END AS status "
         "FROM runs GROUP BY 1")


#: Headers from the rows: a run has the columns in which any of its cells is not NULL; one run's recipe also swaps two.
HEADERS = f"""present AS (SELECT run_id, list_filter([{', '.join(f"CASE WHEN count({c}) > 0 THEN '{c}' WHEN '{c}' = 'customer_name' AND count({fx.EXTRA}) > 0 THEN '{fx.EXTRA}' END" for c in O.C)}],
  lambda x: x IS NOT NULL) AS cols FROM runs GROUP BY 1),
headers AS (SELECT run_id, CASE WHEN run_id <> 'bad_reorder' THEN cols ELSE list_transform(cols, lambda x: CASE x WHEN 'product' THEN 'category'
  WHEN 'category' THEN 'product' ELSE x END) END AS header FROM present),
compared AS (SELECT *, list_filter([{', '.join(O.q(c) for c in O.C)}], lambda x: NOT list_contains(header, x)) AS missing,
  list_filter(header, lambda x: NOT list_contains([{', '.join(O.q(c) for c in O.C)}], x)) AS extra FROM headers)"""


@query("check_sch01_columns", f""", {HEADERS} SELECT run_id, array_to_string(header, ',') AS header, array_to_string(missing, ',') AS missing,
array_to_string(extra, ',') AS extra, CASE WHEN len(missing) + len(extra) > 0 THEN 'FAIL' WHEN header <> [{', '.join(O.q(c) for c in O.C)}] THEN 'WARN' ELSE 'PASS' END AS status,
CASE WHEN list_contains(missing, 'customer_name') AND list_contains(extra, '{fx.EXTRA}') THEN 'customer_name→{fx.EXTRA}' ELSE '' END AS renames FROM compared""", ("runs",))
def _(spark, sf):
    """SCH-01 from the headers of the runs' stored files."""
    rs = replace(fx.run_set(spark, sf), headers={}, cases={}, header_table=fx.stored_headers(spark, sf))
    status = validate_runs(rs, ["SCH-01"]).select("run_id", "status")
    text = [F.array_join(c, ",").alias(c) for c in ("header", "missing", "extra", "renames")]
    return rs.meta().select("run_id", *text).join(status, "run_id")


def _case_sql(n: str) -> str:
    """A drift case's input header, as its own SELECT says."""
    return f"SELECT '{n}' AS \"case\", (SELECT list(column_name) FROM (DESCRIBE SELECT * FROM drifted_{n.replace('-', '_')}) WHERE column_name <> '_ord') AS header"


@query("check_sch03_header_drift", ", " + ", ".join(f"drifted_{n.replace('-', '_')} AS ({O.drifted(n)})" for n in G.CASES)
       + ", heads AS (" + " UNION ALL ".join(map(_case_sql, G.CASES)) + """), base AS (SELECT header AS b FROM heads WHERE "case" = 'baseline')
SELECT "case" AS run_id, CASE WHEN header = b THEN 'PASS' ELSE 'WARN' END AS status, array_to_string(list_filter(b, lambda x: NOT list_contains(header, x)), ',') AS removed,
array_to_string(list_filter(header, lambda x: NOT list_contains(b, x)), ',') AS added FROM heads, base""", ("messy",))
def _(spark, sf):
    """SCH-03 of every drift case: the input is stored as CSV and its header read from the file."""
    path = new_path(spark, "case_files")
    for n, make in G.CASES.items():
        write_clean_csv(make(fx.messy(spark, sf)), f"{path}/case={n}", "gzip")
    case = folder_value(F.col("file"), "case")
    heads, _ = materialize(by_run(csv_headers(spark, path), case, case), "case_headers")
    truth = fx.truth(spark, sf).select(ORD, *fx.COLUMNS).withColumns({"run_id": F.lit("baseline"), "case": F.lit("baseline")})
    rs = RunSet(spark, ORDERS, truth, header_table=heads, input_header_table=heads, baseline_header=fx.COLUMNS)
    status = validate_runs(rs, ["SCH-03"]).select("run_id", "status")
    return rs.meta().select("run_id", F.array_join("input_removed", ",").alias("removed"), F.array_join("input_added", ",").alias("added")).join(status, "run_id")


query("check_row03_not_empty", ROW03, ("runs",))(checked("ROW-03"))
query("check_row01_count", ROW01, ("runs", "truth"))(checked("ROW-01"))

_ACC = f"""acc AS (SELECT r AS run_id,
  (SELECT count(*) FROM truth t WHERE NOT EXISTS (SELECT 1 FROM runs x WHERE x.run_id = r AND x.order_id = t.order_id)) AS missing_keys,
  (SELECT count(DISTINCT order_id) FROM runs x WHERE x.run_id = r AND order_id NOT IN (SELECT order_id FROM truth)) AS unexpected_keys,
  (SELECT count(*) - count(DISTINCT order_id) FROM runs x WHERE x.run_id = r) AS duplicate_key_rows
  FROM (SELECT unnest({_NAMES}) AS r))"""


@query("check_row02_accounting", f", {_ACC} SELECT * FROM acc", ("runs", "truth"))
def _(spark, sf):
    rs = fx.run_set(spark, sf)
    m = M.accounting_metrics(M.key_facts(rs, ["ROW-02"]))
    runs = rs.meta().select("run_id")
    cols = ["missing_keys", "unexpected_keys", "duplicate_key_rows"]
    return runs.join(m, "run_id", "left").select("run_id", *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in cols])


_DUP = ("SELECT run_id, count(*) - count(DISTINCT (order_id, customer_name, email, country, order_date, product, category, quantity, "
        "unit_price, status, customer_full_name)) AS duplicate_rows, count(*) - count(DISTINCT order_id) AS duplicate_keys FROM {src} GROUP BY 1")


@query("check_cln01_duplicates", _DUP.format(src="runs"), ("runs",))
def _(spark, sf):
    rs = fx.run_set(spark, sf)
    d = M.duplicate_metrics(rs)
    return rs.meta().select("run_id").join(d, "run_id", "left").select(
        "run_id", *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("duplicate_rows", "duplicate_keys")])


@query("check_cln07_sorted", """
SELECT run_id, min(CASE WHEN k < prev THEN pos END) + 1 AS first_break_row FROM (
  SELECT run_id, CAST(order_id AS DOUBLE) AS k, lag(CAST(order_id AS DOUBLE)) OVER w AS prev, row_number() OVER w AS pos
  FROM runs WINDOW w AS (PARTITION BY run_id ORDER BY _ord)) GROUP BY 1""", ("runs",))
def _(spark, sf):
    m = M.order_metrics(fx.run_set(spark, sf))
    return m.selectExpr("run_id", "coalesce(first_break, first_null) + 1 AS first_break_row")


# ---------------------------------------------------------------- by key
def _eq(c: str, a: str, b: str) -> str:
    both = f"({O.isnull(a)} AND {O.isnull(b)})"
    if c in NUMBERS:
        return f"({both} OR coalesce(abs({O.num(a)} - {O.num(b)}) <= 0.005, false))"
    if c == "order_date":
        return f"({both} OR coalesce({O.dt(a)} = {O.dt(b)}, false))"
    return f"({both} OR coalesce(trim({a}) = trim({b}) AND NOT {O.isnull(a)} AND NOT {O.isnull(b)}, false))"


_FIRST = ("f AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY run_id, order_id ORDER BY _ord) AS rn FROM runs) "
          "WHERE rn = 1)")
_REST = [c for c in O.C if c != "order_id"]


def cln08_sql() -> str:
    return f", {_FIRST} " + " UNION ALL ".join(
        f"SELECT f.run_id, '{c}' AS \"column\", count(*) AS compared, count(*) FILTER (f.{c} IS NOT NULL AND NOT {_eq(c, f'f.{c}', f't.{c}')}) AS mismatches "
        f"FROM f JOIN truth t USING (order_id) GROUP BY 1" for c in _REST)


@query("check_cln08_ground_truth", cln08_sql(), ("runs", "truth"))
def _(spark, sf):
    m = M.truth_metrics(M.key_facts(fx.run_set(spark, sf), ["CLN-08"]), ORDERS)
    return m.select("run_id", "compared", F.explode("mismatches").alias("m")).select("run_id", "compared", "m.*")


def cln06_sql() -> str:
    parts = []
    for c, kind in (("quantity", "median"), ("unit_price", "median"), ("country", "constant"), ("customer_name", "constant")):
        if kind == "median":
            target = f"(SELECT max(CAST({c} AS DOUBLE)) FROM truth WHERE order_id IN (SELECT order_id FROM messy WHERE {c} = ''))"
            wrong = f"NOT coalesce(abs({O.num('f.' + c)} - {target}) <= 0.011, false)"
        else:
            wrong = f"f.{c} <> 'Unknown'"
        parts.append(f"SELECT run_id, '{c}' AS \"column\", count(*) AS imputed_rows, count(*) FILTER ({wrong}) AS wrong FROM f "
                     f"WHERE f.{c} IS NOT NULL AND order_id IN (SELECT order_id FROM messy WHERE {c} = '') GROUP BY 1")
    return f", {_FIRST} " + " UNION ALL ".join(parts)


@query("check_cln06_imputation", cln06_sql(), ("runs", "truth", "messy"))
def _(spark, sf):
    rs = fx.run_set(spark, sf)
    return M.imputation_metrics(M.key_facts(rs, ["CLN-06"]), rs).select("run_id", "column", "imputed_rows", "wrong")


_RATIO = f"""rat AS (SELECT r AS run_id, {O.num('f.unit_price')} / {O.num('t.unit_price')} AS ratio
  FROM (SELECT unnest({_NAMES}) AS r) JOIN truth t ON t.order_id NOT IN (SELECT order_id FROM messy WHERE unit_price = '')
  LEFT JOIN f ON f.run_id = r AND f.order_id = t.order_id)"""


@query("check_sem02_per_key_ratio", f""", {_FIRST}, {_RATIO}
SELECT run_id, count(ratio) AS compared, count(*) FILTER (abs(ratio - 1) > 0.01) AS changed, round(median(ratio), 6) AS median_ratio
FROM rat GROUP BY 1""", ("runs", "truth", "messy"))
def _(spark, sf):
    m = M.ratio_metrics(M.key_facts(fx.run_set(spark, sf), ["SEM-02"]), ORDERS)
    return m.selectExpr("run_id", "compared", "changed", "round(median_ratio, 6) AS median_ratio")


_DATES = f"""dat AS (SELECT r AS run_id, {O.dt('t.order_date')} AS ref, {O.dt('f.order_date')} AS got
  FROM (SELECT unnest({_NAMES}) AS r), truth t LEFT JOIN f ON f.run_id = r AND f.order_id = t.order_id)"""
_SWAPPED = "got IS NOT NULL AND got <> ref AND month(got) = day(ref) AND day(got) = month(ref)"
_DATE_COUNTS = f"""SELECT run_id, count(*) AS compared, count(*) FILTER (got = ref) AS unchanged, count(*) FILTER ({_SWAPPED}) AS transposed,
  count(*) FILTER (got <> ref AND NOT ({_SWAPPED})) AS other, count(*) FILTER (got IS NULL) AS lost,
  count(*) FILTER (got IS NULL AND day(ref) > 12) AS lost_day_gt_12 FROM dat GROUP BY 1"""


@query("check_sem04_date_per_key", f", {_FIRST}, {_DATES} {_DATE_COUNTS}", ("runs", "truth"))
def _(spark, sf):
    return M.date_metrics(M.key_facts(fx.run_set(spark, sf), ["SEM-04"]))


# ---------------------------------------------------------------- distributions
_PROFILE = " UNION ALL ".join(
    [f"SELECT '{c}' AS \"column\", '{m}' AS metric, '' AS key, round(quantile_cont(CAST({c} AS DOUBLE), {p}), 6) AS value FROM truth"
     for c in ("quantity", "unit_price") for m, p in (("p05", 0.05), ("median", 0.5), ("p95", 0.95))]
    + ["SELECT '*', 'rows', '', CAST(count(*) AS DOUBLE) FROM truth"]
    + [f"SELECT 'order_date', '{m}', '', CAST(CAST({m}(CAST(order_date AS DATE)) AS DATE) - DATE '1970-01-01' AS DOUBLE) FROM truth" for m in ("min", "max")]
    + ["SELECT 'order_date', 'month_share', CAST(month(CAST(order_date AS DATE)) AS VARCHAR), round(count(*) / (SELECT count(*) FROM truth), 6) FROM truth GROUP BY 3"]
    + [f"SELECT '{c}', 'share', {c}, round(count(*) / (SELECT count(*) FROM truth), 6) FROM truth GROUP BY 3" for c in ALLOWED])


@query("profile_reference", _PROFILE, ("truth",))
def _(spark, sf):
    return P.profile(fx.truth(spark, sf).drop("_ord"), ORDERS).selectExpr("column", "metric", "key", "round(value, 6) AS value")


@query("check_sem01_level", f"""
SELECT run_id, round(median({O.num('unit_price')}), 6) AS median, round(median({O.num('unit_price')}) / (SELECT median(CAST(unit_price AS DOUBLE)) FROM truth), 6) AS ratio
FROM runs WHERE {O.num('unit_price')} IS NOT NULL GROUP BY 1""", ("runs", "truth"))
def _(spark, sf):
    rs = fx.run_set(spark, sf)
    ref = P.profile(rs.baseline, ORDERS)
    m = P.level_metrics(P.value_facts(rs.outputs, ORDERS, ["run_id"]), ref, ORDERS)
    return m.selectExpr("run_id", "round(median, 6) AS median", "round(ratio, 6) AS ratio")


def _js_ctes() -> str:
    values = " UNION ALL ".join(
        [f"SELECT {{run}}, '{c}' AS col, {c} AS v FROM {{src}} WHERE {c} IS NOT NULL AND NOT {O.isnull(c)}" for c in ALLOWED]
        + [f"SELECT {{run}}, 'order_date' AS col, CAST(month({O.dt('order_date')}) AS VARCHAR) AS v FROM {{src}} WHERE {O.dt('order_date')} IS NOT NULL"])
    mine = values.format(run="run_id", src="runs")
    ref = values.format(run="1 AS one", src="truth")
    return f"""sv AS (SELECT run_id, col, v, count(*) AS n FROM ({mine}) GROUP BY ALL),
sp AS (SELECT run_id, col, v, n / sum(n) OVER (PARTITION BY run_id, col) AS p FROM sv),
rv AS (SELECT col, v, count(*) / sum(count(*)) OVER (PARTITION BY col) AS q FROM ({ref}) GROUP BY col, v),
rr AS (SELECT run_id, col, v, q FROM rv JOIN (SELECT DISTINCT run_id, col FROM sv) USING (col)),
jj AS (SELECT run_id, col, coalesce(p, 0) AS p, coalesce(q, 0) AS q FROM sp FULL JOIN rr USING (run_id, col, v)),
js AS (SELECT run_id, col, sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
  + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2)) AS d FROM jj GROUP BY 1, 2)"""


def _distances(spark, sf):
    rs = fx.run_set(spark, sf)
    ref = P.profile(rs.baseline, ORDERS)
    facts = P.value_facts(rs.outputs, ORDERS, ["run_id"])
    return facts, P.distribution_metrics(facts, rs, ref)


@query("check_sem03_date_distribution", f""", {_js_ctes()}
SELECT run_id, dates, out_of_window, round(d, 6) AS month_jsd FROM (SELECT run_id, count(*) AS dates,
  count(*) FILTER ({O.dt('order_date')} < TIMESTAMP '2026-01-01' OR {O.dt('order_date')} > TIMESTAMP '2026-06-30') AS out_of_window
  FROM runs WHERE {O.dt('order_date')} IS NOT NULL GROUP BY 1) JOIN js USING (run_id) WHERE col = 'order_date'""", ("runs", "truth"))
def _(spark, sf):
    facts, d = _distances(spark, sf)
    d = d.where("column = 'order_date'").selectExpr("run_id", "round(js_distance, 6) AS month_jsd")
    return P.window_metrics(facts).join(d, "run_id")


@query("check_sem05_categoricals", f""", {_js_ctes()} SELECT run_id, col AS "column", round(d, 6) AS js_distance, d > 0.1 AS shifted
FROM js WHERE col <> 'order_date'""", ("runs", "truth"))
def _(spark, sf):
    _, d = _distances(spark, sf)
    return d.where("column <> 'order_date'").selectExpr(
        "run_id", "column", "round(js_distance, 6) AS js_distance", "js_distance > 0.1 AS shifted")


@query("sem05_new_values", """
SELECT run_id, country AS value, count(*) AS n FROM runs WHERE country NOT IN (SELECT country FROM truth) GROUP BY 1, 2""", ("runs", "truth"))
def _(spark, sf):
    rs = fx.run_set(spark, sf)
    ref = P.profile(rs.baseline, ORDERS)
    new = P.new_categories(P.value_facts(rs.outputs, ORDERS, ["run_id"]), ref)
    return new.where("column = 'country'").select("run_id", "value", "n")


# ---------------------------------------------------------------- everything together
def statuses_sql() -> str:
    """(run_id, check_id, status) of all structural and semantic checks over ``runs``."""
    any_bad = lambda check, sql, bad="FAIL": (
        f"SELECT run_id, '{check}' AS check_id, CASE WHEN sum(violations) > 0 THEN '{bad}' ELSE 'PASS' END AS status FROM ({sql}) GROUP BY 1")
    parts = [
        SCH01, SCH03, ROW03, ROW01,
        f"SELECT run_id, 'SCH-02' AS check_id, CASE WHEN bool_or(present > 0 AND (present - violations) / present < 0.995) THEN 'FAIL' ELSE 'PASS' END AS status FROM ({sch02_sql()}) GROUP BY 1",
        "SELECT run_id, 'ROW-02' AS check_id, CASE WHEN missing_keys + unexpected_keys + duplicate_key_rows > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM acc",
        f"SELECT run_id, 'CLN-01' AS check_id, CASE WHEN duplicate_rows + duplicate_keys > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM ({_DUP.format(src='runs')})",
        any_bad("CLN-02", cln02_sql()), any_bad("CLN-03", cln03_sql()), any_bad("CLN-04", cln04_sql()),
        any_bad("CLN-05", cln05_sql()), any_bad("CLN-09", cln09_sql(), "WARN"),
        f"SELECT run_id, 'CLN-06' AS check_id, CASE WHEN sum(wrong) > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM ({cln06_sql().split(_FIRST, 1)[1]}) GROUP BY 1",
        "SELECT run_id, 'CLN-07' AS check_id, CASE WHEN bool_or(k < prev) THEN 'FAIL' ELSE 'PASS' END AS status FROM (SELECT run_id, "
        "CAST(order_id AS DOUBLE) AS k, lag(CAST(order_id AS DOUBLE)) OVER (PARTITION BY run_id ORDER BY _ord) AS prev FROM runs) GROUP BY 1",
        f"SELECT run_id, 'CLN-08' AS check_id, CASE WHEN sum(mismatches) > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM ({cln08_sql().split(_FIRST, 1)[1]}) GROUP BY 1",
        f"SELECT r AS run_id, 'SEM-01' AS check_id, CASE WHEN m / (SELECT median(CAST(unit_price AS DOUBLE)) FROM truth) BETWEEN 1.0 / 3 AND 3 THEN 'PASS' ELSE 'FAIL' END AS status "
        f"FROM (SELECT unnest({_NAMES}) AS r) LEFT JOIN (SELECT run_id, median({O.num('unit_price')}) AS m FROM runs GROUP BY 1) ON run_id = r",
        "SELECT run_id, 'SEM-02' AS check_id, CASE WHEN count(ratio) = 0 THEN 'SKIP' WHEN count(*) FILTER (abs(ratio - 1) > 0.01) / count(ratio) <= 0.01 THEN 'PASS' ELSE 'FAIL' END AS status FROM rat GROUP BY 1",
        "SELECT run_id, 'SEM-04' AS check_id, CASE WHEN count(*) FILTER (got = ref) = count(*) THEN 'PASS' ELSE 'FAIL' END AS status FROM dat GROUP BY 1",
        f"SELECT run_id, 'SEM-03' AS check_id, CASE WHEN (SELECT d FROM js WHERE js.run_id = runs.run_id AND col = 'order_date') <= 0.1 AND count(*) FILTER ({O.dt('order_date')} < TIMESTAMP '2026-01-01' OR {O.dt('order_date')} > TIMESTAMP '2026-06-30') = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM runs GROUP BY 1",
        "SELECT run_id, 'SEM-05' AS check_id, CASE WHEN max(d) > 0.1 THEN 'FAIL' ELSE 'PASS' END AS status FROM js WHERE col <> 'order_date' GROUP BY 1",
    ]
    return f", {_ACC}, {_FIRST}, {_RATIO}, {_DATES}, {_js_ctes()}, st AS (" + " UNION ALL ".join(parts) + ")"


_NEEDS = ("runs", "truth", "messy")
ALL = (*STRUCTURAL, *SEMANTIC)


def results(spark, sf):
    """Check results of all saved runs, written once like the reports they are."""
    return staged(spark, f"{sf}|results", lambda: validate_runs(fx.run_set(spark, sf)))


@query("validate_all_runs", statuses_sql() + " SELECT * FROM st", _NEEDS)
def _(spark, sf):
    return validate_runs(fx.run_set(spark, sf)).select("run_id", "check_id", "status")


@query("validate_run", statuses_sql() + " SELECT check_id, status FROM st WHERE run_id = 'bad_cents'", _NEEDS)
def _(spark, sf):
    t = fx.truth(spark, sf).drop(ORD)
    out = fx.runs(spark, sf).where("run_id = 'bad_cents'").select(ORD, *ORDERS.names)
    r = validate_run(spark, ORDERS, out, inp=fx.messy(spark, sf).drop(ORD), expected=t, baseline=t, baseline_header=fx.COLUMNS)
    return r.select("check_id", "status")


@query("agg_status_rollup", statuses_sql() + """ SELECT run_id, CASE WHEN bool_or(status = 'FAIL') THEN 'FAIL' WHEN bool_or(status = 'WARN')
  THEN 'WARN' ELSE 'PASS' END AS result FROM st GROUP BY 1""", _NEEDS)
def _(spark, sf):
    return status_rollup(results(spark, sf), ["run_id"])


@query("agg_status_counts", statuses_sql() + """ SELECT run_id, """ + ", ".join(
    f"count(*) FILTER (status = '{s}') AS {s.lower()}" for s in ("PASS", "FAIL", "WARN", "SKIP")) + " FROM st GROUP BY 1", _NEEDS)
def _(spark, sf):
    return status_counts(results(spark, sf), ["run_id"])


@query("summarize_runs", statuses_sql() + """ SELECT run_id, CASE WHEN bool_or(status = 'FAIL') THEN 'FAIL' WHEN bool_or(status = 'WARN')
  THEN 'WARN' ELSE 'PASS' END AS result, coalesce(string_agg(CASE WHEN status = 'FAIL' THEN check_id END, ',' ORDER BY check_id), '') AS failed
  FROM st GROUP BY 1""", _NEEDS)
def _(spark, sf):
    return summarize(results(spark, sf)).select("run_id", "result", "failed")


@query("write_check_report", statuses_sql() + """ SELECT run_id, CASE WHEN bool_or(status = 'FAIL') THEN 'FAIL' WHEN bool_or(status = 'WARN')
  THEN 'WARN' ELSE 'PASS' END AS result, count(*) AS checks FROM st GROUP BY 1""", _NEEDS)
def _(spark, sf):
    """Reports as JSON, foldered by case and run, read back."""
    path = new_path(spark, "reports")
    write_check_report(results(spark, sf), path, {"reference": "ground truth"})
    return read_check_reports(spark, path).selectExpr("run_id", "result", "CAST(size(checks) AS BIGINT) AS checks")


# ---------------------------------------------------------------- predictions for drifted inputs
def _predicted(spark, sf, name):
    drifted = G.CASES[name](fx.messy(spark, sf))
    out = staged(spark, f"{sf}|prediction|{name}", lambda: clean(drifted, ORDERS))
    truth = fx.truth(spark, sf).drop(ORD)
    # The probe's own truth is the cleaner applied to the probe file.
    expected = out.drop(ORD) if name == "probe-extra-row" else truth
    rs = RunSet.single(spark, ORDERS, out, run="prediction", case=name, inp=drifted.drop(ORD), expected=expected,
                       baseline=truth, baseline_header=fx.COLUMNS)
    return validate_runs(rs)


def predicted_sql(n: str) -> str:
    """Statuses of the literal cleaner's output of one drift case, from SQL alone."""
    cols = O.DRIFT_COLUMNS[n]
    out = ", ".join(c if c in cols else f"NULL::VARCHAR AS {c}" for c in [*O.C, "customer_full_name"])
    head = O.with_ctes(("messy", "truth") if n != "probe-extra-row" else ("messy",), "").strip()
    head += f", src AS ({O.drifted(n)}), {O.cleaned_ctes('src', cols, 'x')}"
    head += f", runs AS (SELECT 'prediction' AS run_id, _ord, {out} FROM xc)"
    if n == "probe-extra-row":
        head += f", truth AS (SELECT CAST(order_id AS BIGINT) AS k, {O.COLS} FROM xc)"
    sql = statuses_sql().replace(O._names, "['prediction']")
    same = cols == O.C
    sch01 = SCH01.replace("'bad_rename', 'bad_drop'", "'-'" if same else "'prediction'").replace("'bad_reorder'", "'-'")
    sch03 = SCH03 if same else SCH03.replace("'PASS'", "'WARN'")
    sql = sql.replace(SCH01, sch01).replace(SCH03, sch03)
    return head + sql + " SELECT check_id, status FROM st"


for _name in G.CASES:
    def _predict(spark, sf, name=_name):
        return _predicted(spark, sf, name).select("check_id", "status")

    query(f"predict_case_{_name.replace('-', '_')}", predicted_sql(_name))(_predict)

assert set(ALL) < set(CHECKS)
