"""DuckDB counterparts of the fixtures: CTEs that the oracle queries share.

They rebuild the messy input, the ground truth and the saved runs from the driver
tables in plain SQL, without any of this package's expressions.
"""

from __future__ import annotations

from . import fixtures as fx

C = fx.COLUMNS
COLS = ", ".join(C)


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def case(c: str, mapping: dict[str, str]) -> str:
    return f"CASE {c} " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in mapping.items()) + " END"


def pick(values: list[str], index: str) -> str:
    return "[" + ", ".join(q(v) for v in values) + f"][CAST({index} AS INT) + 1]"


NULLS = "('', 'nan', 'NaN', 'NAN', 'None', 'none', 'null', 'NULL', 'NaT', '<NA>')"


def isnull(c: str) -> str:
    return f"(coalesce({c}, '') IN {NULLS})"


def num(c: str) -> str:
    return f"TRY_CAST({c} AS DOUBLE)"


def dt(c: str) -> str:
    return f"TRY_CAST({c} AS TIMESTAMP)"


def title(c: str) -> str:
    runs = r"[\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+"
    return (f"array_to_string(list_transform(regexp_extract_all({c}, '{runs}'), "
            "lambda w: CASE w[1] WHEN 'ß' THEN 'Ss' ELSE upper(w[1]) END || lower(w[2:])), '')")


# Unicode white space, spelled out: the oracle's own \s is ASCII only.
SPACE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def norm_ws(c: str) -> str:
    return f"trim(regexp_replace({c}, '{SPACE}+', ' ', 'g'), ' ')"


_variant = "CASE country " + " ".join(
    f"WHEN {q(c)} THEN {pick(v, 'h % 3')}" for c, v in fx.VARIANTS.items()) + " END"

CTES: dict[str, tuple[tuple[str, ...], str]] = {}

CTES["typed"] = ((), f"""
  SELECT o_orderkey AS k, o_orderkey % 100 AS m, o_orderkey // 100 AS h, CAST(o_orderkey AS VARCHAR) AS order_id,
    {case('c_mktsegment', fx.NAMES)} AS customer_name, 'c' || c_custkey || '@example.com' AS email,
    {pick(fx.COUNTRIES, 'c_nationkey % 5')} AS country,
    CAST(DATE '2026-01-01' + CAST(o_orderkey % 181 AS INT) AS DATE) AS order_date,
    p_name AS product, {pick(fx.CATEGORIES, 'p_partkey % 5')} AS category,
    1 + o_orderkey % 20 AS quantity, CAST(p_retailprice AS DECIMAL(10, 2)) AS unit_price,
    CASE WHEN o_orderkey % 10 = 7 THEN 'cancelled'
      ELSE {case('o_orderstatus', {'F': 'delivered', 'O': 'shipped', 'P': 'pending'})} END AS status
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN part ON p_partkey = o_orderkey % 200""")

CTES["med"] = (("typed",), """
  SELECT quantile_cont(CASE WHEN m NOT BETWEEN 5 AND 8 THEN CAST(quantity AS DOUBLE) END, 0.5) AS mq,
    quantile_cont(CASE WHEN m NOT BETWEEN 9 AND 12 THEN CAST(unit_price AS DOUBLE) END, 0.5) AS mp
  FROM typed WHERE m >= 5""")

CTES["truth"] = (("typed", "med"), """
  SELECT k, order_id, CASE WHEN m = 18 THEN 'Unknown' ELSE customer_name END AS customer_name,
    CASE WHEN m BETWEEN 13 AND 15 OR m BETWEEN 19 AND 20 THEN '' ELSE email END AS email,
    CASE WHEN m BETWEEN 16 AND 17 THEN 'Unknown' ELSE country END AS country,
    strftime(order_date, '%Y-%m-%d') AS order_date, product, category,
    CAST(CASE WHEN m BETWEEN 5 AND 8 THEN CAST(round_even(mq, 0) AS BIGINT) ELSE quantity END AS VARCHAR) AS quantity,
    CAST(CASE WHEN m BETWEEN 9 AND 12 THEN CAST(mp AS DECIMAL(10, 2)) ELSE unit_price END AS VARCHAR) AS unit_price,
    status
  FROM typed, med WHERE m >= 5""")

CTES["messy"] = (("typed",), f"""
  SELECT ((k * 7919) % 1000003) * 10 + (k // 1000003) * 10000030 + copy AS _ord, order_id,
    CASE WHEN m = 18 THEN '' WHEN m BETWEEN 37 AND 44 THEN
        CASE h % 3 WHEN 0 THEN upper(customer_name) WHEN 1 THEN lower(customer_name)
          ELSE '  ' || replace(customer_name, ' ', '   ') || ' ' END
      WHEN copy = 1 AND m BETWEEN 59 AND 60 THEN upper(customer_name) ELSE customer_name END AS customer_name,
    CASE WHEN m BETWEEN 13 AND 15 THEN '' WHEN m BETWEEN 19 AND 20 THEN replace(email, '@', '')
      WHEN m BETWEEN 51 AND 53 THEN upper(email) ELSE email END AS email,
    CASE WHEN m BETWEEN 16 AND 17 THEN '' WHEN m BETWEEN 25 AND 36 OR (copy = 1 AND m BETWEEN 59 AND 60)
      THEN {_variant} ELSE country END AS country,
    CASE WHEN m = 3 THEN {pick(fx.BAD_DATES, 'h % 3')} WHEN m BETWEEN 21 AND 24 THEN strftime(order_date, '%Y-%m-%d')
      ELSE strftime(order_date, '%m/%d/%Y') END AS order_date,
    CASE WHEN m BETWEEN 54 AND 55 THEN ' ' || product || '  ' ELSE product END AS product, category,
    CASE WHEN m = 0 THEN '0' WHEN m = 1 THEN '-1' WHEN m BETWEEN 5 AND 8 THEN ''
      ELSE CAST(quantity AS VARCHAR) END AS quantity,
    CASE WHEN m = 2 THEN '-' || CAST(unit_price AS VARCHAR) WHEN m BETWEEN 9 AND 12 THEN ''
      ELSE CAST(unit_price AS VARCHAR) END AS unit_price,
    CASE WHEN m = 4 THEN {pick(fx.BAD_STATUSES, 'h % 4')}
      WHEN m BETWEEN 45 AND 50 OR (copy = 1 AND m BETWEEN 59 AND 60) THEN upper(status) ELSE status END AS status
  FROM (SELECT *, unnest(CASE WHEN m BETWEEN 56 AND 60 THEN [0, 1] ELSE [0] END) AS copy FROM typed)""")

_names = "[" + ", ".join(q(r) for r in fx.RUNS) + "]"
CTES["runs"] = (("truth",), f"""
  SELECT run_id, CASE WHEN run_id = 'bad_order' THEN -k * 2 ELSE k * 2 + copy END AS _ord, order_id,
    CASE WHEN run_id = 'bad_rename' THEN NULL WHEN run_id = 'bad_text' AND k % 500 = 68
      THEN '  ' || upper(customer_name) ELSE customer_name END AS customer_name,
    email,
    CASE WHEN run_id = 'bad_drop' THEN NULL WHEN run_id = 'bad_category' AND country = 'United States' THEN 'USA'
      WHEN run_id = 'bad_iso' THEN coalesce({case('country', fx.ISO2)}, country) ELSE country END AS country,
    CASE WHEN run_id = 'bad_range' AND k % 500 = 70
        THEN strftime(CAST(order_date AS DATE) + INTERVAL 12 MONTH, '%Y-%m-%d')
      WHEN run_id = 'bad_format' THEN order_date || ' 00:00:00'
      WHEN run_id = 'bad_swap' THEN strftime(CAST(order_date AS DATE), '%Y-%d-%m') ELSE order_date END AS order_date,
    product, CASE WHEN run_id = 'bad_null' AND k % 500 = 67 THEN 'None' ELSE category END AS category,
    CASE WHEN run_id = 'bad_range' AND k % 500 = 69 THEN '99'
      WHEN run_id = 'bad_imputation' AND k % 100 BETWEEN 5 AND 8 THEN '4'
      WHEN run_id = 'bad_format' THEN quantity || '.0' ELSE quantity END AS quantity,
    CASE WHEN run_id = 'bad_type' THEN '$' || format('{{:,.2f}}', CAST(unit_price AS DOUBLE))
      WHEN run_id = 'bad_cents' THEN CAST(CAST(CAST(unit_price AS DECIMAL(10, 2)) * 100 AS DECIMAL(12, 2)) AS VARCHAR)
      WHEN run_id = 'bad_cell' AND k = 1234 THEN '999.99' ELSE unit_price END AS unit_price,
    status, CASE WHEN run_id = 'bad_rename' THEN customer_name END AS customer_full_name
  FROM (SELECT *, unnest(CASE WHEN run_id = 'bad_duplicate' AND k % 500 = 65 THEN [0, 1] ELSE [0] END) AS copy
        FROM (SELECT *, unnest({_names}) AS run_id FROM truth)
        WHERE NOT (run_id = 'bad_missing' AND k % 500 = 66)
          AND NOT (run_id = 'bad_swap' AND day(CAST(order_date AS DATE)) > 12))""")


def with_ctes(needs: tuple[str, ...], body: str) -> str:
    """Prefix a query with the CTEs it needs, dependencies first."""
    order: list[str] = []

    def add(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            add(d)
        order.append(n)

    for n in needs:
        add(n)
    if not order:
        return body.strip()
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in order) + "\n" + body.strip()


# ---------------------------------------------------------------- literal cleaner
def _valid(col: str) -> str:
    """Strict parse by the two input formats."""
    return f"coalesce(try_strptime({col}, '%m/%d/%Y'), try_strptime({col}, '%Y-%m-%d'))"


MAP = {"usa": "United States", "us": "United States", "u.s.": "United States", "united states": "United States",
       "uk": "United Kingdom", "u.k.": "United Kingdom", "united kingdom": "United Kingdom", "aus": "Australia",
       "au": "Australia", "australia": "Australia", "india": "India", "nz": "New Zealand", "new zealand": "New Zealand"}
STATUSES = "('pending', 'shipped', 'delivered', 'cancelled')"


def normalised(source: str, columns: list[str]) -> str:
    """Steps 1-4 and the numeric parse."""
    rules = {
        "customer_name": title(norm_ws("customer_name")), "email": f"lower({norm_ws('email')})",
        "status": f"lower({norm_ws('status')})", "product": norm_ws("product"), "category": norm_ws("category"),
        "country": f"coalesce({case(f'lower({norm_ws("country")})', MAP)}, {norm_ws('country')})",
        "order_date": f"coalesce(strftime({_valid('order_date')}, '%Y-%m-%d'), '')",
        "quantity": num("quantity"), "unit_price": num("unit_price"),
    }
    return f"SELECT _ord, {', '.join(f'{rules.get(c, c)} AS {c}' for c in columns)} FROM {source}"


def reason(columns: list[str]) -> str:
    tests = [("order_date", "order_date = ''", "order_date_unparseable"), ("quantity", "quantity <= 0", "quantity_le"),
             ("unit_price", "unit_price < 0", "unit_price_lt"),
             ("status", f"status NOT IN {STATUSES}", "status_not_allowed")]
    return "CASE " + " ".join(f"WHEN {t} THEN {q(r)}" for c, t, r in tests if c in columns) + " END"


def cleaned_ctes(source: str, columns: list[str], p: str) -> str:
    """CTE chain ``{p}n, {p}d, {p}m, {p}c``: normalised, deduplicated, medians, cleaned."""
    names = ", ".join(columns)
    mail = ", ".join("CASE WHEN contains(email, '@') THEN email ELSE '' END AS email" if c == "email" else c
                     for c in columns)
    out = {
        "customer_name": "CASE WHEN customer_name = '' THEN 'Unknown' ELSE customer_name END",
        "country": "CASE WHEN country = '' THEN 'Unknown' ELSE country END",
        "quantity": "coalesce(CAST(CAST(round_even(coalesce(quantity, round_even(mq, 0)), 0) AS BIGINT) AS VARCHAR), '')",
        "unit_price": "coalesce(format('{:.2f}', coalesce(unit_price, CAST(format('{:.2f}', mp) AS DOUBLE))), '')",
    }
    return f"""{p}n AS ({normalised(source, columns)}),
{p}d AS (SELECT min(_ord) AS _ord, {names} FROM (SELECT _ord, {mail} FROM {p}n WHERE {reason(columns)} IS NULL)
  GROUP BY {names}),
{p}m AS (SELECT quantile_cont(quantity, 0.5) AS mq, quantile_cont(unit_price, 0.5) AS mp FROM {p}d),
{p}c AS (SELECT row_number() OVER (ORDER BY CAST(order_id AS BIGINT), _ord) AS _ord,
  {', '.join(f'{out.get(c, c)} AS {c}' for c in columns)} FROM {p}d, {p}m)"""


# ---------------------------------------------------------------- drifted inputs
_FILLED = "(CAST(order_id AS BIGINT) * 7919 % 1000003) % 10 < 3"
DRIFT_COLUMNS = {
    "baseline": C, "probe-extra-row": C, "S1": [c for c in C if c != "country"],
    "S2": ["customer_full_name" if c == "customer_name" else c for c in C], "S3": C,
    "S4": [x for c in C for x in ((c, "discount_code") if c == "product" else (c,))],
    "M1": C, "M2": C, "M3": C,
}
DRIFT_COLUMNS["S5"] = [
    x for c in C if c != "country"
    for x in (("customer_full_name",) if c == "customer_name" else (c, "discount_code") if c == "product" else (c,))
]
_CURRENCY = ("CASE WHEN unit_price = '' THEN '' ELSE (CASE WHEN CAST(unit_price AS DOUBLE) < 0 THEN '-' ELSE '' END) "
             "|| '$' || format('{:,.2f}', abs(CAST(unit_price AS DOUBLE))) END")
_CODE = ("CASE WHEN " + _FILLED + " THEN ['SAVE10', 'WELCOME5', 'SPRING15', 'VIP20']"
         "[CAST((CAST(order_id AS BIGINT) * 48271 % 2147483647) % 4 + 1 AS INT)] ELSE '' END")
DRIFT_EXPRS: dict[str, dict[str, str]] = {
    "S2": {"customer_full_name": "customer_name"}, "S3": {"unit_price": _CURRENCY}, "S4": {"discount_code": _CODE},
    "S5": {"customer_full_name": "customer_name", "unit_price": _CURRENCY, "discount_code": _CODE},
    "M1": {"unit_price": "CASE WHEN unit_price = '' THEN '' ELSE "
                         "CAST(CAST(round_even(CAST(unit_price AS DOUBLE) * 100, 0) AS BIGINT) AS VARCHAR) END"},
    "M2": {"order_date": "coalesce(strftime(try_strptime(order_date, '%m/%d/%Y'), '%d/%m/%Y'), order_date)"},
    "M3": {"country": "CASE WHEN country = '' THEN '' ELSE " + case("lower(trim(country))", {
        k: {"United States": "US", "United Kingdom": "GB", "Australia": "AU", "India": "IN", "New Zealand": "NZ"}[v]
        for k, v in MAP.items()}) + " END"},
}
PROBE = {"customer_name": "Probe Tester", "email": "probe.tester1@example.com", "country": "Australia",
         "order_date": "06/15/2026", "product": "Desk Lamp", "category": "Home", "quantity": "1",
         "unit_price": "32.00", "status": "delivered"}


def drifted(name: str) -> str:
    """SELECT of a drift case's input from ``messy``."""
    exprs = DRIFT_EXPRS.get(name, {})
    sql = f"SELECT _ord, {', '.join(f'{exprs[c]} AS {c}' if c in exprs else c for c in DRIFT_COLUMNS[name])} FROM messy"
    if name == "probe-extra-row":
        sql += (" UNION ALL SELECT max(_ord) + 10, CAST(max(CAST(order_id AS BIGINT)) + 1 AS VARCHAR), "
                + ", ".join(q(PROBE[c]) for c in C[1:]) + " FROM messy")
    return sql
