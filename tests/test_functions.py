"""Expressions against Python's own semantics, value by value."""

import json
import math
import random
from datetime import datetime

import pytest

from tablepact.functions import compare, dates, numeric, text, web
from tablepact.functions.sql import lit


def evaluate(spark, values, expr, type_="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, c {type_}").repartition(2)
    return [r[1] for r in df.selectExpr("i", f"{expr} AS r").orderBy("i").collect()]


TEXTS = ["", "  a  b ", "O'NEIL", "mary-ann HALL", "27in monitor", "sci-fi", " x ", "\tq\x1cz\n", "émile ZOLA", "a　 b", "ß"]


def test_text_rules_match_python(spark):
    assert evaluate(spark, TEXTS, text.strip("c")) == [t.strip() for t in TEXTS]
    assert evaluate(spark, TEXTS, text.norm_ws("c")) == [" ".join(t.split()) for t in TEXTS]
    assert evaluate(spark, TEXTS, text.title_case("c")) == [t.title() for t in TEXTS]
    assert evaluate(spark, TEXTS, text.rule_holds("trimmed", "c")) == [t == t.strip() for t in TEXTS]
    assert evaluate(spark, TEXTS, text.rule_holds("single_spaced", "c")) == ["  " not in t for t in TEXTS]


def test_missing_tokens_are_exact(spark):
    values = [*text.MISSING_TOKENS, " nan", "Nan", "n/a", None]
    assert evaluate(spark, values, text.is_missing("c")) == [True] * 10 + [False] * 3 + [True]


def test_lookup_passes_unknown_through(spark):
    got = evaluate(spark, ["USA", "usa", "Peru", ""], text.lookup_map("c", {"Usa": "United States"}))
    assert got == ["United States", "United States", "Peru", ""]


def test_unknown_rule_is_an_error():
    with pytest.raises(KeyError):
        text.rule_holds("no_such_rule", "c")


def test_fixed_decimal_matches_python_formatting(spark):
    rng = random.Random(7)
    xs = [0.0, 2.675, 0.125, 0.375, 1.005, 0.005, 0.015, 0.025, 0.045, 0.055, 0.0049999999999999996, 9.995, 99.995, 0.995, -2.675, 1e15 + 0.3]
    xs += [rng.randrange(0, 10**9) / 1000 for _ in range(3000)] + [k / 8 for k in range(200)] + [rng.uniform(0, 1) for _ in range(2000)]
    assert evaluate(spark, xs, numeric.fixed_decimal("c"), "double") == [f"{x:.2f}" for x in xs]
    assert evaluate(spark, xs, numeric.fixed_decimal("c + 0"), "double") == [f"{x:.2f}" for x in xs]
    assert evaluate(spark, xs, numeric.round_even("c"), "double") == [float(round(x)) for x in xs]


def test_to_num_rejects_suffixes_and_nan(spark):
    values = ["12", " 1.5 ", "1e3", ".5", "5.", "1d", "1f", "0x1", "nan", "", "abc", "-3", "+4", "1,5"]
    assert evaluate(spark, values, numeric.to_num("c")) == [12, 1.5, 1000, .5, 5, None, None, None, None, None, None, -3, 4, None]
    assert evaluate(spark, ["inf", "-Infinity"], numeric.to_num("c")) == [math.inf, -math.inf]


def test_keys_are_exact_beyond_2_53(spark):
    assert evaluate(spark, ["9007199254740993", "1001.7", " 5 ", "x"], numeric.to_key("c")) == [9007199254740993, 1001, 5, None]


def test_dates(spark):
    values = ["2026-03-14", "2026-03-14 10:20:30", "20260314", "2026-02-30", "9999-12-31", "", "NaT", " 2026-03-14 ", "x"]
    d = datetime(2026, 3, 14)
    assert evaluate(spark, values, dates.to_date_ntz("c")) == [d, d.replace(hour=10, minute=20, second=30), d, None, None, None, None, d, None]
    got = evaluate(spark, ["02/30/2026", "1/2/2026", "2026-3-4", "01/02/26", "1/2/2026 x"],
                   f"CAST({dates.parse_formats('c', ['%m/%d/%Y', '%Y-%m-%d'])} AS STRING)")
    assert got == [None, "2026-01-02", "2026-03-04", None, None]
    assert evaluate(spark, ["03/14/2026", "13/45/2026", "2026-01-02"], dates.swap_day_month("c")) == ["14/03/2026", "13/45/2026", "2026-01-02"]
    with pytest.raises(ValueError):
        dates.spark_pattern("%j")


def test_local_time_has_summer_and_winter_offset(spark):
    names = ["x_1767225600000.csv", "x_1782864000123.csv"]
    got = evaluate(spark, names, dates.local_iso(dates.epoch_ms_in_name("c")))
    assert got == ["2026-01-01T10:30:00+10:30", "2026-07-01T09:30:00+09:30"]


def test_currency_and_minor_units(spark):
    values = ["1249.5", "-1249.50", "", "0.015", "19.99"]
    assert evaluate(spark, values, numeric.currency_text("c")) == ["$1,249.50", "-$1,249.50", "", "$0.01", "$19.99"]
    assert evaluate(spark, values, numeric.minor_units("c")) == ["124950", "-124950", "", "2", "1999"]


def test_json_shapes(spark):
    def shape(t):
        if not t:
            return ""
        try:
            v = json.loads(t)
        except ValueError:
            return "(non-JSON)"
        if isinstance(v, dict):
            return "{" + ", ".join(list(v)[:8]) + ("…" if len(v) > 8 else "") + "}"
        if isinstance(v, list):
            return f"[{len(v)} × {shape(json.dumps(v[0])) if v else ''}]"
        return type(v).__name__

    docs = ['{"b": 1, "a": 2}', "[]", "[1]", '["x"]', "[null]", "[[1.5], []]", "oops", "", "3", "2.0", "true", "null", '"s"',
            json.dumps({f"k{i}": i for i in range(9)}), '[{"z": 1, "y": 2}, 3]', "{}"]
    assert evaluate(spark, docs, web.json_shape("c")) == [shape(d) for d in docs]


def test_path_template(spark):
    paths = ["/api/12/x", "/u/0123456789abcdef01234567/y", "/t/abcdefghijklmnopqrstuvwxyz", "/a/b1"]
    assert evaluate(spark, paths, web.path_template("c")) == ["/api/{id}/x", "/u/{id}/y", "/t/{id}", "/a/b1"]


def test_tolerant_equal(spark):
    pairs = [("1.00", "1.004", "float"), ("1.00", "1.006", "float"), ("", "nan", "float"), ("abc", "abc", "float"),
             ("2026-01-01", "2026-01-01 00:00:00", "date"), (" a ", "a", "string"), ("a", "", "string")]
    got = [evaluate(spark, ["x"], compare.tolerant_equal(lit(a), lit(b), t, 0.005))[0] for a, b, t in pairs]
    assert got == [True, False, True, False, True, True, False]


def test_close_name():
    assert compare.close_name("customer_name", ["customer_full_name", "email"]) == "customer_full_name"
    assert compare.close_name("country", ["price"]) is None


def test_rounding_by_plain_arithmetic_agrees_with_python(spark):
    rng = random.Random(21)
    values = [0.0, -0.0, 0.5, 1.5, 2.5, -0.5, -1.5, 0.005, 0.015, 2.675, 1.005, -2.675, 0.0025, 99.995, 1e11 + 0.005, 2.0**46, 2.0**46 - 0.5, 2.0**52 + 0.5,
              2.0**53 - 1, 703687441776.635, 703687441776.645, 0.0049999999999999996, 0.994999999999999999, 1e-320, -1e-9, 123456.78]
    values += [rng.choice([-1, 1]) * rng.randint(0, 10**7) / rng.choice([1, 2, 8, 100, 200, 1000, 2000]) for _ in range(400)]
    values += [rng.uniform(-1, 1) * 10.0 ** rng.randint(-6, 15) for _ in range(400)]
    for places in (1, 2, 3, 4):
        want = [f"{v:.{places}f}" if v != 0 else f"{0.0:.{places}f}" for v in values]
        assert evaluate(spark, values, numeric.fixed_decimal("c", places), "double") == want, places
    assert evaluate(spark, values, numeric.int_text("c"), "double") == [str(round(v)) for v in values]
    # Lambdas are evaluated outside of generated code; whole numbers below 2**53 need none.
    below = numeric.int_text("c").split("ELSE concat(")[1].split(" ELSE ")[0]
    assert "transform" not in below and "rint" in below
