"""Sources and sinks (S-*), provenance, run log and traffic (R-*), native contracts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..contract import ORDERS, Contract
from ..functions import dates as D
from ..operators.clean import clean
from ..plans import metrics as M
from ..plans import profile as P
from ..plans import runlog as L
from ..plans.determinism import determinism, run_fingerprints
from ..plans.provenance import input_provenance, no_output
from ..sources import tables as S
from ..sources.staging import materialize, new_path
from . import fixtures as fx
from . import oracle as O
from .registry import query

table = fx.table


# ---------------------------------------------------------------- sources and sinks
#: Files of the scan: 4,000 keys each, three layouts in turn; every seventh row has a quoted line break, some rows are ragged.
FILE_KEYS = 4000
_LAYOUTS = [ORDERS.names, ORDERS.names[::-1], [*(n for n in ORDERS.names if n != "category"), "note"]]


def messy_files(spark, sf):
    """The messy table as CSV text files under one folder, as uploads of several tools would leave them."""
    def quoted(c):
        return f"""CASE WHEN {c} RLIKE '[",\\\\n]' THEN concat('"', replace({c}, '"', '""'), '"') ELSE {c} END"""

    rows = fx.messy(spark, sf).selectExpr("*", "CAST(order_id AS BIGINT) AS k").selectExpr("*", f"k DIV {FILE_KEYS} AS f").selectExpr(
        "* EXCEPT (product)", """CASE WHEN k % 7 = 0 THEN concat(product, '\\n"', 'x', '",') ELSE product END AS product""", "concat('n', CAST(k AS STRING)) AS note")
    layouts = []
    for names in _LAYOUTS:
        every = "array(" + ", ".join(quoted(n) for n in names) + ")"
        short = f"slice({every}, 1, {len(names) - 1})"
        layouts.append(f"array_join(CASE WHEN k % 11 = 0 THEN {short} WHEN k % 13 = 0 THEN concat({every}, array('more')) ELSE {every} END, ',')")
    heads = [",".join(names) for names in _LAYOUTS]
    pick = lambda items: f"CASE f % 3 WHEN 0 THEN {items[0]} WHEN 1 THEN {items[1]} ELSE {items[2]} END"
    lines = rows.selectExpr("f", "_ord", f"{pick(layouts)} AS line")
    body = lines.groupBy("f").agg(F.sort_array(F.collect_list(F.struct("_ord", "line"))).alias("rows"))
    text = body.selectExpr("f", f"concat({pick([repr(h) for h in heads])}, '\\n', array_join(rows.line, '\\n')) AS value")
    path = new_path(spark, "messy_files")
    text.write.partitionBy("f").text(path)
    return path


def _cell(n):
    """Expected cell: the last one of a short row is empty, a column that the file lacks is NULL."""
    last = " ".join(f"WHEN f % 3 = {i} AND k % 11 = 0 THEN ''" for i, names in enumerate(_LAYOUTS) if names[-1] == n)
    lacks = " ".join(f"WHEN f % 3 = {i} THEN NULL" for i, names in enumerate(_LAYOUTS) if n not in names)
    return f"CASE {lacks} {last} ELSE {n} END AS {n}" if last or lacks else n


def _expected_text():
    texts = []
    for names in _LAYOUTS:
        every = [f"""CASE WHEN regexp_matches({n}, '[",\\n]') THEN '"' || replace({n}, '"', '""') || '"' ELSE {n} END""" for n in names]
        texts.append(f"CASE WHEN k % 11 = 0 THEN concat_ws(',', {', '.join(every[:-1])}) WHEN k % 13 = 0 THEN concat_ws(',', {', '.join(every)}, 'more') END")
    return f"CASE f % 3 WHEN 0 THEN {texts[0]} WHEN 1 THEN {texts[1]} ELSE {texts[2]} END"


@query("scan_raw_strings", f"""SELECT f, row_number() OVER (PARTITION BY f ORDER BY _ord) AS pos, {', '.join(_cell(n) for n in [*ORDERS.names, 'note'])}, {_expected_text()} AS corrupt
FROM (SELECT * REPLACE (CASE WHEN k % 7 = 0 THEN product || chr(10) || '"x",' ELSE product END AS product), 'n' || k AS note, k // {FILE_KEYS} AS f
FROM (SELECT *, CAST(order_id AS BIGINT) AS k FROM messy))""", ("messy",))
def _(spark, sf):
    """Files of three layouts with line breaks in cells and ragged rows, scanned as one raw table in file order."""
    # Small tables lack the layout that has notes, so the columns are named.
    scanned = S.scan_raw_strings(spark, messy_files(spark, sf), [*ORDERS.names, "note"], corrupt="corrupt")
    of_file = Window.partitionBy("f").orderBy("_ord")
    rows = scanned.withColumn("f", F.regexp_extract("_ord.file", "f=([0-9]+)", 1).cast("long")).withColumn("pos", F.row_number().over(of_file).cast("long"))
    return rows.select("f", "pos", *ORDERS.names, "note", "corrupt")


@query("write_clean_csv", f"SELECT {O.COLS} FROM truth", ("truth",))
def _(spark, sf):
    path = new_path(spark, "clean_csv")
    S.write_clean_csv(clean(fx.messy(spark, sf), ORDERS), path)
    return S.scan_raw_strings(spark, path).drop("_ord")


def output_objects(spark, sf):
    """Output objects from purchase events; one in seven has no time in its name."""
    ms = D.to_epoch_ms("ts")
    return table(spark, sf, "events").where("event_type = 'purchase'").selectExpr(
        "event_id", "event_id % 7 <> 0 AS dated",
        f"concat('orders_clean_', CASE WHEN event_id % 7 <> 0 THEN CAST({ms} AS STRING) ELSE CAST(event_id AS STRING) END, '.csv') AS name",
        f"{ms} + 5 AS created_ms", "CAST(value * 100 AS BIGINT) AS size")


_OBJECTS = """SELECT event_id, event_id % 7 <> 0 AS dated, 'orders_clean_' || CASE WHEN event_id % 7 <> 0 THEN epoch_us(ts) // 1000 ELSE event_id END || '.csv' AS name,
  epoch_us(ts) // 1000 + 5 AS created_ms, CASE WHEN event_id % 7 <> 0 THEN epoch_us(ts) // 1000 ELSE epoch_us(ts) // 1000 + 5 END AS ts_ms
  FROM events WHERE event_type = 'purchase'"""


@query("latest_outputs", f"SELECT name, ts_ms FROM ({_OBJECTS}) ORDER BY ts_ms DESC, name LIMIT 20")
def _(spark, sf):
    return S.latest_outputs(output_objects(spark, sf), "orders_clean", 20).select("name", "ts_ms")


@query("list_objects")
def _(spark, sf):
    """Listing of the driver's own files, names and sizes only."""
    return S.latest_outputs(S.list_objects(spark, sf)).select("name", "size")


@query("file_fingerprint", """
SELECT page_id, sha256(html) AS sha256, (page_id % 5 <> 0) AS etag_matches_md5 FROM pages""")
def _(spark, sf):
    """Whole page bodies as uploaded objects; every fifth one carries a wrong store tag."""
    p = table(spark, sf, "pages").withColumn(
        "etag", F.expr("concat('\"', CASE WHEN page_id % 5 <> 0 THEN md5(html) ELSE md5(url) END, '\"')"))
    return p.selectExpr("page_id", *[f"{e} AS {c}" for c, e in S.object_fingerprint("html", "etag").items()])


@query("file_hashes")
def _(spark, sf):
    """SHA-256 and MD5 of every file of the driver's folder."""
    return S.file_fingerprints(spark, sf).selectExpr("element_at(split(path, '/'), -1) AS name", "length", "sha256", "md5")


def uploads(spark, sf):
    """Upload log rows from signup events, one feed per user."""
    ms = D.to_epoch_ms("ts")
    return table(spark, sf, "events").where("event_type = 'signup'").selectExpr(
        "user_id AS feed", f"{ms} AS uploaded_at_ms", "concat('case-', event_id % 10) AS case",
        "sha2(CAST(event_id % 10 AS STRING), 256) AS sha256", "event_id AS seq")


@query("append_event_log", """
SELECT "case", count(*) AS uploads, max(uploaded_at_ms) AS last_ms, count(*) FILTER (sha256 = sha256(CAST(seq % 10 AS VARCHAR))) AS intact
FROM (SELECT 'case-' || event_id % 10 AS "case", epoch_us(ts) // 1000 AS uploaded_at_ms, sha256(CAST(event_id % 10 AS VARCHAR)) AS sha256, event_id AS seq
  FROM events WHERE event_type = 'signup') GROUP BY 1""")
def _(spark, sf):
    """Two appends to one log, then read back."""
    path = new_path(spark, "uploads")
    log = uploads(spark, sf).selectExpr(
        f"{D.local_iso('uploaded_at_ms')} AS uploaded_at_local", "uploaded_at_ms", "case", "concat(case, '.csv') AS file",
        "sha256", "'orders.csv' AS uri", "CAST(seq AS STRING) AS version_id", "true AS etag_matches_md5")
    S.append_event_log(log.where("uploaded_at_ms % 2 = 0"), path)
    S.append_event_log(log.where("uploaded_at_ms % 2 = 1"), path)
    return S.read_event_log(spark, path).groupBy("case").agg(
        F.expr("count(*)").alias("uploads"), F.max("uploaded_at_ms").alias("last_ms"),
        F.expr("count_if(sha256 = sha2(CAST(CAST(version_id AS BIGINT) % 10 AS STRING), 256))").alias("intact"))


@query("read_run_results", 'SELECT \'baseline\' AS "case", run_id, count(*) AS rows FROM runs GROUP BY 2', ("runs",))
def _(spark, sf):
    """Saved outputs foldered by case and run; one scan discovers all of them."""
    path = new_path(spark, "results")
    S.write_run_output(fx.runs(spark, sf), path)
    return S.read_run_results(spark, path).groupBy("case", "run_id").agg(F.count(F.lit(1)).alias("rows"))


@query("save_load_profile", """
SELECT 'unit_price' AS "column", 'median' AS metric, '' AS key, round(median(CAST(unit_price AS DOUBLE)), 6) AS value FROM truth
UNION ALL SELECT 'unit_price', 'p05', '', round(quantile_cont(CAST(unit_price AS DOUBLE), 0.05), 6) FROM truth
UNION ALL SELECT 'unit_price', 'p95', '', round(quantile_cont(CAST(unit_price AS DOUBLE), 0.95), 6) FROM truth""", ("truth",))
def _(spark, sf):
    """The profile of the newest run without FAIL is frozen, then read back as the reference."""
    from ..plans.validate import summarize, validate_runs

    rs = fx.run_set(spark, sf)
    verdicts = summarize(validate_runs(rs, ["SCH-01", "CLN-01", "CLN-07"]))
    newest = verdicts.where("result <> 'FAIL' AND run_id IN ('good', 'bad_order')").agg(F.max("run_id").alias("r")).scalar()
    frozen = fx.runs(spark, sf).where(F.col("run_id") == newest).select(*ORDERS.names)
    path = new_path(spark, "profile")
    S.save_profile(P.profile(frozen, ORDERS), path)
    return S.load_profile(spark, path).where("column = 'unit_price'").selectExpr("column", "metric", "key", "round(value, 6) AS value")


# ---------------------------------------------------------------- provenance
_ASOF = """
, o AS (SELECT event_id, user_id AS feed, epoch_us(ts) // 1000 AS ts_ms, 'case-' || event_id % 10 AS c FROM events WHERE event_type = 'purchase'),
u AS (SELECT event_id AS seq, user_id AS feed, epoch_us(ts) // 1000 AS ms, 'case-' || event_id % 10 AS c FROM events WHERE event_type = 'signup')
""".replace(", o AS", "WITH o AS", 1)


@query("check_inp01_provenance", _ASOF + """
SELECT o.event_id, CASE WHEN o.event_id % 11 = 0 OR u.seq IS NULL THEN 'SKIP' WHEN u.c = o.c THEN 'PASS' ELSE 'FAIL' END AS status
FROM o ASOF LEFT JOIN u ON o.feed = u.feed AND o.ts_ms >= u.ms""")
def _(spark, sf):
    outs = output_objects(spark, sf)
    e = table(spark, sf, "events").where("event_type = 'purchase'").selectExpr(
        "event_id", "user_id AS feed", f"CASE WHEN event_id % 11 <> 0 THEN {D.to_epoch_ms('ts')} END AS ts_ms",
        "concat('case-', event_id % 10) AS case", "sha2(CAST(event_id % 10 AS STRING), 256) AS sha256",
        "CAST(event_id AS STRING) AS run_id")
    del outs
    return input_provenance(e, uploads(spark, sf), ["feed"]).select("event_id", "status")


@query("check_no_output", _ASOF + """
SELECT u.feed, CASE WHEN max(u.ms) > coalesce((SELECT max(ts_ms) FROM o WHERE o.feed = u.feed), 0) THEN 'NO-OUTPUT' ELSE 'OUTPUT' END AS result
FROM u GROUP BY u.feed""")
def _(spark, sf):
    outs = table(spark, sf, "events").where("event_type = 'purchase'").selectExpr("user_id AS feed", f"{D.to_epoch_ms('ts')} AS ts_ms")
    return no_output(outs, uploads(spark, sf), ["feed"]).select("feed", "result")


# ---------------------------------------------------------------- HTTP captures
_TYPES = ["xhr", "fetch", "document", "script"]


def http_entries(spark, sf):
    """Capture entries from the pages: method, status, headers and body vary with the page."""
    p = table(spark, sf, "pages")
    return p.selectExpr(
        "page_id AS seq", "element_at(array('GET', 'POST', 'GET'), CAST(page_id % 3 AS INT) + 1) AS method",
        "CASE WHEN page_id % 13 = 0 THEN 'https://www.googletagmanager.com/collect/9' ELSE "
        "regexp_replace(url, '//[a-z.-]*[.]([a-z-]+[.]example)', '//$1') END AS url",
        "element_at(array('xhr', 'fetch', 'document', 'script'), CAST(page_id % 4 AS INT) + 1) AS resource_type",
        "CASE WHEN page_id % 8 = 2 THEN 'application/json' ELSE 'text/html' END AS mime",
        "element_at(array(200, 200, 404, 201), CAST(page_id % 4 AS INT) + 1) AS status",
        "CASE WHEN page_id % 5 = 0 THEN '' ELSE concat('{\"id\": ', page_id, ', \"n\": [1]}') END AS body",
        "CASE WHEN page_id % 2 = 0 THEN array('authorization', 'accept') ELSE array('cookie') END AS header_names")


_ENTRIES = """
e AS (SELECT page_id, ['GET', 'POST', 'GET'][page_id % 3 + 1] AS method,
  CASE WHEN page_id % 13 = 0 THEN 'https://www.googletagmanager.com/collect/9' ELSE
    regexp_replace(url, '//[a-z.-]*[.]([a-z-]+[.]example)', '//\\1') END AS url,
  ['xhr', 'fetch', 'document', 'script'][page_id % 4 + 1] AS rt, page_id % 8 = 2 AS js, [200, 200, 404, 201][page_id % 4 + 1] AS status,
  page_id % 5 = 0 AS empty, page_id % 2 = 0 AS auth FROM pages),
c AS (SELECT *, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host,
  array_to_string(list_transform(string_split(regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1), '/'),
    lambda s: CASE WHEN regexp_full_match(s, '\\d+|[A-Za-z0-9_-]{20,}') THEN '{id}' ELSE s END), '/') AS path
  FROM e WHERE NOT contains(url, 'google') AND (rt IN ('xhr', 'fetch') OR js))"""


@query("endpoint_summary", "WITH" + _ENTRIES + """
SELECT method, host, path, count(*) AS calls, count(*) FILTER (status = 200) AS n200, count(*) FILTER (status = 404) AS n404,
  concat_ws(',', CASE WHEN bool_or(auth) THEN 'authorization' END, CASE WHEN bool_or(NOT auth) THEN 'cookie' END) AS auth,
  CASE WHEN bool_or(status < 400 AND NOT empty) THEN '{id, n}' ELSE '' END AS shape
FROM c GROUP BY 1, 2, 3""")
def _(spark, sf):
    return S.endpoint_summary(http_entries(spark, sf)).selectExpr(
        "method", "host", "path", "calls", "coalesce(try_element_at(statuses, 200), 0L) AS n200",
        "coalesce(try_element_at(statuses, 404), 0L) AS n404", "array_join(auth, ',') AS auth", "shape")


@query("agg_endpoint_summary", "WITH" + _ENTRIES + """
SELECT method, host, count(*) AS calls FROM c GROUP BY 1, 2""")
def _(spark, sf):
    return S.endpoint_summary(http_entries(spark, sf)).groupBy("method", "host").agg(F.sum("calls").alias("calls"))


@query("read_http_log", "WITH" + _ENTRIES + " SELECT page_id, method, url, rt AS resource_type, status FROM e")
def _(spark, sf):
    """Captures written as nested JSON, one document per host, and read back as entries."""
    path = new_path(spark, "har")
    e = http_entries(spark, sf)
    entry = F.expr(
        "named_struct('_resourceType', resource_type, 'request', named_struct('method', method, 'url', url, 'headers', "
        "transform(header_names, h -> named_struct('name', h, 'value', 'x'))), 'response', named_struct('status', status, "
        "'content', named_struct('mimeType', mime, 'text', CAST(seq AS STRING))))")
    # A capture file is one document, so captures are cut into files of at most 1000 entries.
    docs = e.select(F.floor(F.col("seq") / 1000).alias("part"), entry.alias("e")).groupBy("part").agg(
        F.struct(F.collect_list("e").alias("entries")).alias("log"))
    docs.select("part", "log").write.partitionBy("part").json(path)
    return S.read_http_log(spark, path).selectExpr(
        "CAST(body AS BIGINT) AS page_id", "method", "url", "resource_type", "status")


# ---------------------------------------------------------------- run log
def run_log(spark, sf):
    return table(spark, sf, "events").selectExpr(
        "event_id", "user_id % 10 AS case", "ts", "value AS duration", "event_type = 'error' AS failed", "event_type AS outcome")


@query("health_by_scenario", """
SELECT user_id % 10 AS "case", count(*) AS runs, count(*) FILTER (event_type = 'error') AS failed,
  round(avg(CASE WHEN event_type = 'error' THEN 0.0 ELSE 1.0 END), 6) AS success_rate FROM events GROUP BY 1""")
def _(spark, sf):
    return L.health_by_scenario(run_log(spark, sf)).selectExpr("case", "runs", "failed", "round(success_rate, 6) AS success_rate")


@query("consistency_by_config", """
SELECT user_id % 10 AS config, count(*) AS runs, count(DISTINCT props) AS distinct_hashes, count(DISTINCT props) = 1 AS identical
FROM events GROUP BY 1""")
def _(spark, sf):
    hashes = table(spark, sf, "events").selectExpr("user_id % 10 AS config", "sha2(props, 256) AS content_hash")
    return L.consistency_by_config(hashes)


@query("capability_heatmap", """
SELECT user_id % 10 AS "case", """ + ", ".join(
    f"count(*) FILTER (event_type = '{t}') AS {t}" for t in ("click", "error", "purchase", "signup", "view")) + " FROM events GROUP BY 1")
def _(spark, sf):
    return L.capability_heatmap(run_log(spark, sf), ["click", "error", "purchase", "signup", "view"])


@query("duration_vs_baseline", """
, d AS (SELECT user_id % 10 AS c, avg(value) AS mean, median(value) AS med FROM events GROUP BY 1)
SELECT c AS "case", round(mean, 6) AS mean, round(med, 6) AS median, round((mean / (SELECT mean FROM d WHERE c = 0) - 1) * 100, 4) AS delta_pct FROM d
""".replace(", d AS", "WITH d AS", 1))
def _(spark, sf):
    return L.duration_vs_baseline(run_log(spark, sf), 0).selectExpr(
        "case", "round(mean, 6) AS mean", "round(median, 6) AS median", "round(delta_pct, 4) AS delta_pct")


@query("severity_classify", """
SELECT event_id, CASE WHEN event_type = 'view' AND user_id % 2 = 0 THEN 'Critical' WHEN event_type IN ('error', 'click') AND user_id % 3 = 0 THEN 'High'
  WHEN event_type IN ('error', 'click') THEN 'Medium' WHEN event_type = 'view' OR event_type = 'purchase' THEN 'Low' ELSE 'Info' END AS severity FROM events""")
def _(spark, sf):
    e = table(spark, sf, "events").selectExpr(
        "event_id", "CASE event_type WHEN 'view' THEN 'CARRIED-ON-SILENTLY' WHEN 'error' THEN 'STOPPED-AT-INPUT' "
        "WHEN 'click' THEN 'STOPPED-MID-PIPELINE' WHEN 'purchase' THEN 'WARNED-AND-CONTINUED' ELSE '' END AS outcome",
        "CASE WHEN event_type = 'view' AND user_id % 2 = 0 THEN 'DEGRADED-OUTPUT' ELSE 'CORRECT-OUTPUT' END AS impact",
        "CASE WHEN user_id % 3 = 0 THEN 0 ELSE 2 END AS log_clarity")
    return e.selectExpr("event_id", f"{L.severity('outcome', 'impact', 'log_clarity')} AS severity")


# ---------------------------------------------------------------- native typed tables
LINEITEM = Contract.from_dict({"key": "l_orderkey", "columns": [
    {"name": "l_orderkey", "dtype": "int"}, {"name": "l_quantity", "dtype": "float", "min": 1, "max": 45},
    {"name": "l_discount", "dtype": "float", "min": 0, "max": 0.08}, {"name": "l_tax", "dtype": "float", "min": 0.01, "max": 0.08},
    {"name": "l_returnflag", "dtype": "string", "allowed": ["A", "N"]}, {"name": "l_linestatus", "dtype": "string", "allowed": ["O"]},
    {"name": "l_shipdate", "dtype": "date", "min": "1995-06-01", "max": "2001-06-30"}]})
_NATIVE = " UNION ALL ".join([
    "SELECT 'l_quantity' AS \"column\", 'CLN-05' AS check_id, count(*) FILTER (l_quantity < 1 OR l_quantity > 45) AS violations FROM lineitem",
    "SELECT 'l_discount', 'CLN-05', count(*) FILTER (l_discount < 0 OR l_discount > 0.08) FROM lineitem",
    "SELECT 'l_tax', 'CLN-05', count(*) FILTER (l_tax < 0.01 OR l_tax > 0.08) FROM lineitem",
    "SELECT 'l_shipdate', 'CLN-05', count(*) FILTER (l_shipdate < TIMESTAMP '1995-06-01' OR l_shipdate > TIMESTAMP '2001-06-30') FROM lineitem",
    "SELECT 'l_returnflag', 'CLN-04', count(*) FILTER (l_returnflag NOT IN ('A', 'N')) FROM lineitem",
    "SELECT 'l_linestatus', 'CLN-04', count(*) FILTER (l_linestatus NOT IN ('O')) FROM lineitem"])


@query("contract_lineitem", _NATIVE)
def _(spark, sf):
    cells = M.cell_metrics(table(spark, sf, "lineitem"), LINEITEM, [], ["CLN-04", "CLN-05"])
    return cells.select(F.explode("cells").alias("c")).select("c.column", "c.check_id", "c.violations")


ORDERS_NATIVE = Contract.from_dict({"key": "o_orderkey", "columns": [
    {"name": "o_orderkey", "dtype": "int"}, {"name": "o_orderstatus", "dtype": "string", "allowed": ["F", "O"]},
    {"name": "o_orderpriority", "dtype": "string", "allowed": ["1-URGENT", "2-HIGH", "3-MEDIUM"]},
    {"name": "o_orderdate", "dtype": "date", "min": "1996-01-01", "max": "2000-12-31"}]})


@query("contract_orders", """
SELECT 'o_orderstatus' AS "column", count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) AS violations FROM orders
UNION ALL SELECT 'o_orderpriority', count(*) FILTER (o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')) FROM orders
UNION ALL SELECT 'o_orderdate', count(*) FILTER (o_orderdate < TIMESTAMP '1996-01-01' OR o_orderdate > TIMESTAMP '2000-12-31') FROM orders""")
def _(spark, sf):
    cells = M.cell_metrics(table(spark, sf, "orders"), ORDERS_NATIVE, [], ["CLN-04", "CLN-05"])
    return cells.select(F.explode("cells").alias("c")).select("c.column", "c.violations")


CUSTOMER = Contract.from_dict({"key": "c_custkey", "columns": [
    {"name": "c_custkey", "dtype": "int"}, {"name": "c_mktsegment", "dtype": "string", "allowed": ["BUILDING", "MACHINERY"]},
    {"name": "c_acctbal", "dtype": "float", "min": 0, "max": 9000}]})


@query("contract_customer", """
SELECT 'c_mktsegment' AS "column", count(*) FILTER (c_mktsegment NOT IN ('BUILDING', 'MACHINERY')) AS violations FROM customer
UNION ALL SELECT 'c_acctbal', count(*) FILTER (c_acctbal < 0 OR c_acctbal > 9000) FROM customer""")
def _(spark, sf):
    cells = M.cell_metrics(table(spark, sf, "customer"), CUSTOMER, [], ["CLN-04", "CLN-05"])
    return cells.select(F.explode("cells").alias("c")).select("c.column", "c.violations")


@query("check_det01_identical", """
SELECT 'baseline' AS "case", 18 AS runs, false AS raw_identical, 'FAIL' AS status
UNION ALL SELECT 'reformatted', 3, false, 'PASS'""".replace("18 AS runs", "CAST(count(DISTINCT run_id) AS BIGINT) AS runs").replace(
    "AS status\nUNION", "AS status FROM runs\nUNION").replace("'reformatted', 3", "'reformatted', CAST(3 AS BIGINT)"), ("runs",))
def _(spark, sf):
    """All saved runs together, and the three that differ in formatting or row order only."""
    runs, heads = fx.runs(spark, sf), fx.run_headers()
    prints, _ = materialize(run_fingerprints(spark, runs, heads, ORDERS.names), "prints")  # one row per run, read twice
    same = prints.where("run_id IN ('good', 'bad_format', 'bad_order')").withColumn("case", F.lit("reformatted"))
    every = prints.withColumn("case", F.lit("baseline")).unionByName(same)
    return determinism(every).select("case", "runs", "raw_identical", "status")
