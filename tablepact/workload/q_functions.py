"""Scalar functions, projections and predicates (F-*, P-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..contract import ORDERS
from ..functions import compare as K
from ..functions import dates as D
from ..functions import numeric as N
from ..functions import text as X
from ..functions import web as H
from ..operators import drift as G
from ..operators.aggregates import share_where
from ..operators.clean import reject_reason
from . import fixtures as fx
from . import oracle as O
from .registry import query

table = fx.table

# Number and date texts in many spellings, derived from the event rows.
_N = "CAST(round(value * 100) AS BIGINT)"
NUMBER_TEXT = (
    f"CASE event_id % 14 WHEN 0 THEN concat({_N}, '') WHEN 1 THEN concat(' ', {_N}, '.5 ') WHEN 2 THEN concat({_N}, 'e2') "
    f"WHEN 3 THEN concat({_N}, 'd') WHEN 4 THEN concat('.', {_N}) WHEN 5 THEN concat({_N}, '.') WHEN 6 THEN 'inf' "
    f"WHEN 7 THEN 'nan' WHEN 8 THEN '' WHEN 9 THEN concat('-', {_N}, '.25') WHEN 10 THEN concat('$', {_N}) "
    f"WHEN 11 THEN concat({_N}, 'f') WHEN 12 THEN concat('+', {_N}) ELSE concat({_N}, ',5') END"
)
DATE_TEXT = (
    "CASE event_id % 9 WHEN 0 THEN {day} WHEN 1 THEN concat({day}, ' 10:20:30') WHEN 2 THEN replace({day}, '-', '') "
    "WHEN 3 THEN substr({day}, 1, 7) WHEN 4 THEN concat(' ', {day}, ' ') WHEN 5 THEN '2024-02-30' WHEN 6 THEN 'NaT' "
    "WHEN 7 THEN concat({day}, 'T00:00:00') ELSE 'soon' END"
)
_DAY_SPARK = "CAST(CAST(ts AS DATE) AS STRING)"
_DAY_DUCK = "strftime(ts, '%Y-%m-%d')"
_NUM = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|inf)\s*$"


def events(spark, sf):
    return table(spark, sf, "events")


@query("fn_is_null_token", """
SELECT event_id, coalesce(t, '') AS token, coalesce(t, '') IN ('', 'nan', 'NaN', 'NAN', 'None', 'none', 'null', 'NULL',
  'NaT', '<NA>') AS is_missing
FROM (SELECT event_id, ['', 'nan', 'NaN', 'NAN', 'None', 'none', 'null', 'NULL', 'NaT', '<NA>', ' nan', 'Nan', 'NONE',
  'n/a', NULL][event_id % 15 + 1] AS t FROM events)""")
def _(spark, sf):
    tokens = "array('', 'nan', 'NaN', 'NAN', 'None', 'none', 'null', 'NULL', 'NaT', '<NA>', ' nan', 'Nan', 'NONE', 'n/a', NULL)"
    t = events(spark, sf).selectExpr("event_id", f"element_at({tokens}, CAST(event_id % 15 + 1 AS INT)) AS t")
    return t.selectExpr("event_id", "coalesce(t, '') AS token", f"{X.is_missing('t')} AS is_missing")


@query("fn_norm_ws", f"SELECT doc_id, {O.norm_ws('text')} AS text FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").selectExpr("doc_id", f"{X.norm_ws('text')} AS text")


@query("fn_title_case", f"SELECT doc_id, {O.title('text')} AS text FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").selectExpr("doc_id", f"{X.title_case('text')} AS text")


@query("fn_lower", "SELECT doc_id, lower(text) AS text FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").selectExpr("doc_id", f"{X.lower('text')} AS text")


@query("fn_lookup_map", f"""
SELECT _ord AS ord, country AS raw, coalesce({O.case('lower(trim(country))', O.MAP)}, trim(country)) AS country FROM messy""",
       ("messy",))
def _(spark, sf):
    lookup = ORDERS["country"].lookup
    return fx.messy(spark, sf).selectExpr(
        "_ord AS ord", "country AS raw", f"{X.lookup_map('trim(country)', lookup)} AS country")


@query("fn_to_num", f"""
SELECT event_id, t AS raw, CASE WHEN regexp_matches(t, '{_NUM}') THEN TRY_CAST(trim(t) AS DOUBLE) END AS value
FROM (SELECT event_id, {NUMBER_TEXT} AS t FROM events)""")
def _(spark, sf):
    t = events(spark, sf).selectExpr("event_id", f"{NUMBER_TEXT} AS t")
    return t.selectExpr("event_id", "t AS raw", f"{N.to_num('t')} AS value")


@query("fn_to_date", f"""
SELECT event_id, t AS raw, strftime(CASE event_id % 9 WHEN 0 THEN d WHEN 1 THEN d + INTERVAL '10:20:30' HOUR TO SECOND
  WHEN 2 THEN d WHEN 3 THEN date_trunc('month', d) WHEN 4 THEN d WHEN 7 THEN d END, '%Y-%m-%d %H:%M:%S') AS ts
FROM (SELECT event_id, {DATE_TEXT.format(day=_DAY_DUCK)} AS t, date_trunc('day', ts) AS d FROM events)""".replace(
    "INTERVAL '10:20:30' HOUR TO SECOND", "INTERVAL 37230 SECOND"))
def _(spark, sf):
    t = events(spark, sf).selectExpr("event_id", f"{DATE_TEXT.format(day=_DAY_SPARK)} AS t")
    return t.selectExpr("event_id", "t AS raw", f"date_format({D.to_date_ntz('t')}, 'yyyy-MM-dd HH:mm:ss') AS ts")


@query("fn_parse_multi_format", """
SELECT _ord AS ord, order_date AS raw,
  strftime(coalesce(try_strptime(order_date, '%m/%d/%Y'), try_strptime(order_date, '%Y-%m-%d')), '%Y-%m-%d') AS day
FROM messy""", ("messy",))
def _(spark, sf):
    parsed = D.parse_formats("order_date", ORDERS.input_date_formats)
    return fx.messy(spark, sf).selectExpr("_ord AS ord", "order_date AS raw", f"CAST({parsed} AS STRING) AS day")


@query("fn_iso_date", """
SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS iso FROM orders""")
def _(spark, sf):
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey", f"{D.iso_date('CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate END')} AS iso")


@query("fn_month_day", """
SELECT l_orderkey, l_linenumber, CAST(month(l_shipdate) AS INTEGER) AS month, CAST(day(l_shipdate) AS INTEGER) AS day
FROM lineitem""")
def _(spark, sf):
    return table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "month(l_shipdate) AS month", "day(l_shipdate) AS day")


@query("fn_contains_at", "SELECT doc_id, contains(text, '@') AS has_at FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").selectExpr("doc_id", f"{X.contains_at('text')} AS has_at")


@query("fn_fixed_decimal", """
SELECT event_id, format('{:.2f}', x) AS two, CAST(round_even(x, 0) AS BIGINT) AS whole, format('{:.2f}', y) AS eighths,
  format('{:.3f}', h3) AS three, format('{:.4f}', h4) AS four, format('{:.2f}', far) AS far
FROM (SELECT event_id, (CAST(round(value * 100) AS BIGINT) * 10 + 5) / 1000.0::DOUBLE * (CASE WHEN event_id % 3 = 0 THEN -1 ELSE 1 END) AS x,
  (event_id % 4001) / 8.0::DOUBLE AS y, (event_id * 10 + 5) / 10000.0::DOUBLE AS h3, (event_id * 10 + 5) / 100000.0::DOUBLE AS h4,
  (event_id + 1)::DOUBLE * CASE event_id % 3 WHEN 0 THEN 1e20 WHEN 1 THEN 1e37 ELSE 1e28 END AS far FROM events)""")
def _(spark, sf):
    e = events(spark, sf).selectExpr(
        "event_id", f"({_N} * 10 + 5) / 1000D * (CASE WHEN event_id % 3 = 0 THEN -1 ELSE 1 END) AS x",
        "(event_id % 4001) / 8D AS y", "(event_id * 10 + 5) / 10000D AS h3", "(event_id * 10 + 5) / 100000D AS h4",
        "CAST(event_id + 1 AS DOUBLE) * CASE event_id % 3 WHEN 0 THEN 1e20D WHEN 1 THEN 1e37D ELSE 1e28D END AS far")
    return e.selectExpr("event_id", f"{N.fixed_decimal('x')} AS two", f"CAST({N.round_even('x')} AS BIGINT) AS whole", f"{N.fixed_decimal('y')} AS eighths",
                        f"{N.fixed_decimal('h3', 3)} AS three", f"{N.fixed_decimal('h4', 4)} AS four", f"{N.fixed_decimal('far')} AS far")


@query("fn_full_match", r"""
SELECT event_id, t AS raw, regexp_full_match(t, '-?\d+') AS is_int, regexp_full_match(t, '-?\d+\.\d{2}') AS is_2dp
FROM (SELECT event_id, """ + NUMBER_TEXT + " AS t FROM events)")
def _(spark, sf):
    t = events(spark, sf).selectExpr("event_id", f"{NUMBER_TEXT} AS t")
    return t.selectExpr("event_id", "t AS raw", f"{X.full_match('t', '-?[0-9]+')} AS is_int",
                        f"{X.full_match('t', '-?[0-9]+[.][0-9]{2}')} AS is_2dp")


@query("fn_extract_epoch_ms", """
SELECT event_id, name, ms, strftime(make_timestamp(ms * 1000) + INTERVAL 630 MINUTE, '%Y-%m-%dT%H:%M:%S') || '+10:30' AS local_time
FROM (SELECT event_id, 'orders_clean_' || epoch_us(ts) // 1000 || '.csv' AS name, epoch_us(ts) // 1000 AS ms FROM events)""")
def _(spark, sf):
    e = events(spark, sf).selectExpr("event_id", f"concat('orders_clean_', {D.to_epoch_ms('ts')}, '.csv') AS name")
    e = e.selectExpr("*", f"{D.epoch_ms_in_name('name')} AS ms")
    return e.selectExpr("event_id", "name", "ms", f"{D.local_iso('ms')} AS local_time")


@query("fn_currency_text", """
SELECT _ord AS ord, CASE WHEN unit_price = '' THEN '' ELSE (CASE WHEN CAST(unit_price AS DOUBLE) < 0 THEN '-' ELSE '' END)
  || '$' || format('{:,.2f}', abs(CAST(unit_price AS DOUBLE)) * 3) END AS price
FROM messy""", ("messy",))
def _(spark, sf):
    m = fx.messy(spark, sf).selectExpr(
        "_ord AS ord", "CASE WHEN unit_price = '' THEN '' ELSE CAST(CAST(unit_price AS DOUBLE) * 3 AS STRING) END AS p")
    return m.selectExpr("ord", f"{N.currency_text('p')} AS price")


@query("fn_to_minor_units", """
SELECT _ord AS ord, CASE WHEN unit_price = '' THEN ''
  ELSE CAST(CAST(round_even(CAST(unit_price AS DOUBLE) * 100, 0) AS BIGINT) AS VARCHAR) END AS cents
FROM messy""", ("messy",))
def _(spark, sf):
    return fx.messy(spark, sf).selectExpr("_ord AS ord", f"{N.minor_units('unit_price')} AS cents")


@query("fn_swap_day_month", """
SELECT _ord AS ord, order_date AS raw, coalesce(strftime(try_strptime(order_date, '%m/%d/%Y'), '%d/%m/%Y'), order_date) AS swapped
FROM messy""", ("messy",))
def _(spark, sf):
    return fx.messy(spark, sf).selectExpr("_ord AS ord", "order_date AS raw", f"{D.swap_day_month('order_date')} AS swapped")


@query("fn_close_name")
def _(spark, sf):
    """Closest allowed country of every spelling; the ratio has no SQL counterpart."""
    names = fx.messy(spark, sf).groupBy("country").agg(F.count(F.lit(1)).alias("n"))
    return names.withColumn("closest", K.close_value(F.col("country"), ORDERS["country"].allowed))


@query("fn_ratio", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_discount <> 0 THEN round(l_tax / l_discount, 6) END AS ratio FROM lineitem""")
def _(spark, sf):
    return table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", f"round({N.ratio('l_tax', 'l_discount')}, 6) AS ratio")


@query("fn_log2_sqrt", """
SELECT event_id, round(CASE WHEN p > 0 THEN p * log2(p / 3) ELSE 0 END, 6) AS term, round(sqrt(greatest(0, p - 5)), 6) AS root
FROM (SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 0 ELSE value END AS p FROM events)""")
def _(spark, sf):
    e = events(spark, sf).selectExpr("event_id", "CASE WHEN event_id % 10 = 0 THEN 0D ELSE value END AS p")
    return e.selectExpr("event_id", f"round({N.log2_term('p', '3D')}, 6) AS term", "round(sqrt(greatest(0D, p - 5)), 6) AS root")


_ID = (r"\d+|[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}|[0-9a-f]{24}|[A-Za-z0-9_-]{20,}")


@query("fn_path_template", f"""
SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host,
  array_to_string(list_transform(string_split(regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1), '/'),
    lambda s: CASE WHEN regexp_full_match(s, '{_ID}') THEN '{{id}}' ELSE s END), '/') AS template
FROM pages""")
def _(spark, sf):
    return table(spark, sf, "pages").selectExpr(
        "page_id", f"{H.url_host('url')} AS host", f"{H.path_template(H.url_path('url'))} AS template")


_BODY = ("CASE event_id % 11 WHEN 0 THEN props WHEN 1 THEN concat('[', props, ', ', props, ']') WHEN 2 THEN '[]' "
         "WHEN 3 THEN concat('oops ', props) WHEN 4 THEN '\"text\"' WHEN 5 THEN '12' WHEN 6 THEN '1.5' WHEN 7 THEN 'null' "
         "WHEN 8 THEN '[[1, 2], [3]]' WHEN 9 THEN concat('{\"b\": 1, \"a\": 2, \"c\": 3, \"d\": 4, \"e\": 5, \"f\": 6, \"g\": 7, "
         "\"h\": 8, \"i\": ', props, '}') ELSE '[\"x\", true]' END")


@query("fn_json_shape", """
SELECT event_id, CASE event_id % 11 WHEN 0 THEN '{k}' WHEN 1 THEN '[2 × {k}]' WHEN 2 THEN '[0 × ]' WHEN 3 THEN '(non-JSON)'
  WHEN 4 THEN 'str' WHEN 5 THEN 'int' WHEN 6 THEN 'float' WHEN 7 THEN 'NoneType' WHEN 8 THEN '[2 × [2 × int]]'
  WHEN 9 THEN '{b, a, c, d, e, f, g, h…}' ELSE '[2 × str]' END AS shape
FROM events WHERE json_valid(props)""")
def _(spark, sf):
    e = events(spark, sf).selectExpr("event_id", f"{_BODY} AS body")
    return e.selectExpr("event_id", f"{H.json_shape('body')} AS shape")


@query("fn_default_if_missing", """
SELECT _ord AS ord, CASE WHEN country = '' THEN 'Unknown' ELSE country END AS country FROM messy""", ("messy",))
def _(spark, sf):
    return fx.messy(spark, sf).selectExpr("_ord AS ord", f"{X.default_if_missing('country', 'Unknown')} AS country")


@query("fn_abs_tolerance_eq", """
SELECT event_id, a, b, CASE WHEN event_id % 6 = 5 THEN event_id % 12 = 5 ELSE abs(CAST(a AS DOUBLE) - CAST(b AS DOUBLE)) <= 0.005 END AS same
FROM (SELECT event_id, CASE WHEN event_id % 6 = 5 THEN 'nan' ELSE '' || n || '.100' END AS a,
  CASE WHEN event_id % 12 = 5 THEN '' WHEN event_id % 6 = 5 THEN '7' ELSE '' || n || '.10' || (event_id % 9) END AS b
  FROM (SELECT event_id, CAST(round(value * 100) AS BIGINT) AS n FROM events))""")
def _(spark, sf):
    e = events(spark, sf).selectExpr("event_id", f"{_N} AS n").selectExpr(
        "event_id", "CASE WHEN event_id % 6 = 5 THEN 'nan' ELSE concat(n, '.100') END AS a",
        "CASE WHEN event_id % 12 = 5 THEN '' WHEN event_id % 6 = 5 THEN '7' ELSE concat(n, '.10', event_id % 9) END AS b")
    return e.selectExpr("event_id", "a", "b", f"{K.tolerant_equal('a', 'b', 'float', 0.005)} AS same")


# ---------------------------------------------------------------- projections, predicates
@query("drop_column", f"SELECT _ord AS ord, {', '.join(c for c in O.C if c != 'country')} FROM messy", ("messy",))
def _(spark, sf):
    return G.drop_column(fx.messy(spark, sf), "country").withColumnRenamed("_ord", "ord")


@query("rename_column", f"""
SELECT _ord AS ord, {', '.join('customer_name AS customer_full_name' if c == 'customer_name' else c for c in O.C)} FROM messy""",
       ("messy",))
def _(spark, sf):
    return G.rename_column(fx.messy(spark, sf), "customer_name", "customer_full_name").withColumnRenamed("_ord", "ord")


@query("insert_column_at", f"SELECT _ord AS ord, {O.COLS}, length(product) AS product_length FROM messy", ("messy",))
def _(spark, sf):
    df = G.insert_after(fx.messy(spark, sf), "product", "product_length", "CAST(length(product) AS BIGINT)")
    return df.withColumnRenamed("_ord", "ord")


def _numbered(spark, sf):
    from ..operators.clean import clean

    return clean(fx.messy(spark, sf), ORDERS, until="number")


@query("filter_invalid_rows", f"""
SELECT _ord AS ord, {O.COLS} FROM n WHERE {O.reason(O.C)} IS NULL""".replace("FROM n", f"FROM ({O.normalised('messy', O.C)}) n"),
       ("messy",))
def _(spark, sf):
    df = _numbered(spark, sf)
    return df.where(f"{reject_reason(df, ORDERS)} IS NULL").withColumnRenamed("_ord", "ord")


@query("pred_in_set", f"""
SELECT status, status IN {O.STATUSES} AS allowed, count(*) AS n FROM messy GROUP BY ALL""", ("messy",))
def _(spark, sf):
    from ..functions.sql import in_list

    allowed = ORDERS["status"].allowed
    return fx.messy(spark, sf).selectExpr("status", f"status IN {in_list(allowed)} AS allowed").groupBy(
        "status", "allowed").agg(F.count(F.lit(1)).alias("n"))


@query("pred_range", """
SELECT _ord AS ord, quantity, coalesce(TRY_CAST(quantity AS DOUBLE) < 1 OR TRY_CAST(quantity AS DOUBLE) > 15, false) AS outside
FROM messy""", ("messy",))
def _(spark, sf):
    x = N.to_num("quantity")
    return fx.messy(spark, sf).selectExpr("_ord AS ord", "quantity", f"coalesce({x} < 1 OR {x} > 15, false) AS outside")


@query("pred_text_rules", f"""
SELECT run_id, order_id, regexp_replace(v, '^{O.SPACE}+|{O.SPACE}+$', '', 'g') = v AS trimmed, NOT contains(v, '  ') AS single_spaced,
  v = {O.title('v')} AS title_case, v = lower(v) AS lower_case, contains(v, '@') AS contains_at
FROM (SELECT run_id, order_id, customer_name AS v FROM runs WHERE customer_name IS NOT NULL AND run_id = 'bad_text')
UNION ALL SELECT 'messy', CAST(_ord AS VARCHAR), regexp_replace(v, '^{O.SPACE}+|{O.SPACE}+$', '', 'g') = v, NOT contains(v, '  '),
  v = {O.title('v')}, v = lower(v), contains(v, '@') FROM (SELECT _ord, customer_name AS v FROM messy)""", ("runs", "messy"))
def _(spark, sf):
    rules = [f"{X.rule_holds(r, 'v')} AS {r}" for r in ("trimmed", "single_spaced", "title_case", "lower_case", "contains_at")]
    bad = fx.runs(spark, sf).where("run_id = 'bad_text' AND customer_name IS NOT NULL").selectExpr(
        "run_id", "order_id", "customer_name AS v")
    raw = fx.messy(spark, sf).selectExpr("'messy' AS run_id", "CAST(_ord AS STRING) AS order_id", "customer_name AS v")
    return bad.unionByName(raw).selectExpr("run_id", "order_id", *rules)


@query("custom_rule", """
SELECT run_id, count(*) AS violations FROM runs WHERE product IS NOT NULL AND NOT contains(product, ' ') OR length(product) > 11
GROUP BY run_id""", ("runs",))
def _(spark, sf):
    X.register_rule("two_short_words", lambda c: f"contains({c}, ' ') AND length({c}) <= 11")
    return fx.runs(spark, sf).where(f"product IS NOT NULL AND NOT {X.rule_holds('two_short_words', 'product')}").groupBy(
        "run_id").agg(F.count(F.lit(1)).alias("violations"))


@query("select_unknown_passthrough", """
SELECT order_id, discount_code FROM (SELECT *, """ + O._CODE + """ AS discount_code FROM truth)""", ("truth",))
def _(spark, sf):
    """The cleaner keeps a column the contract does not know."""
    from ..operators.clean import clean

    return clean(G.s4_add(fx.messy(spark, sf)), ORDERS).select("order_id", "discount_code")


@query("exclude_imputed", """
SELECT order_id, unit_price FROM truth WHERE order_id NOT IN (SELECT order_id FROM messy WHERE unit_price = '')""",
       ("truth", "messy"))
def _(spark, sf):
    gone = fx.messy(spark, sf).where(X.is_missing("unit_price")).select("order_id")
    return fx.truth(spark, sf).join(gone, "order_id", "left_anti").select("order_id", "unit_price")


@query("filter_noise_hosts", """
SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host FROM pages
WHERE NOT regexp_matches(regexp_extract(url, '^[a-z]+://([^/?#]+)', 1), 'google|gstatic|sentry|segment|intercom|hotjar|posthog|mixpanel|clarity|doubleclick|facebook|fonts\\.|cloudflareinsights|stripe|hubspot|linkedin')""")
def _(spark, sf):
    p = table(spark, sf, "pages").selectExpr("page_id", f"{H.url_host('url')} AS host")
    return p.where(f"NOT {H.is_noise_host('host')}")


@query("agg_fraction", """
SELECT l_returnflag, round(avg(CASE WHEN l_quantity > 45 THEN 1.0 ELSE 0.0 END), 6) AS large_share FROM lineitem GROUP BY 1""")
def _(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.expr(f"round({share_where('l_quantity > 45')}, 6)").alias("large_share"))
