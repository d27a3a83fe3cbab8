"""Operators against brute force on small data, including skewed and repeated keys."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablepact.contract import ORDERS, ORDERS_DOC, Contract
from tablepact.operators import aggregates as A
from tablepact.operators import ordering as R
from tablepact.operators.asof import asof_backward, newest_per_group
from tablepact.operators.clean import clean, row_accounting
from tablepact.operators.diff import cell_diff
from tablepact.operators.fingerprint import canonicalize, fingerprints
from tablepact.operators.quantiles import _with_bits, quantiles, value_counts
from tablepact.workload import fixtures as fx


def test_quantiles_match_numpy_at_any_shape(spark):
    rng = random.Random(3)
    tiny = 5e-324
    columns = {
        "skewed": [5.0] * 400 + [rng.gauss(0, 100) for _ in range(601)], "few": [float(i) for i in range(10)], "zero": [-0.0, 0.0],
        "narrow": [1 + i * 2**-52 for i in range(500)], "tiny": [i * tiny for i in range(-50, 51)], "one": [7.25], "same": [-3.5] * 99,
        "small": [1e-300 * rng.random() for _ in range(300)], "wide": [rng.choice([-1, 1]) * 10.0 ** rng.randint(-300, 300) for _ in range(301)],
        "powers": [2.0**e for e in range(-1074, 1024, 7)] + [-(2.0**e) for e in range(-1074, 1024, 5)], "largest": [1.7976931348623157e308, -1.0],
    }
    data = [(g, x) for g, xs in columns.items() for x in xs]
    df = spark.createDataFrame(data, "g string, x double").repartition(5)
    probs = [0.0, 0.05, 0.5, 0.95, 1.0]
    got = {(r.g, r.prob): r.value for r in quantiles(value_counts(df, ["g"], ["x"]).drop("column"), ["g"], probs).collect()}
    for g, xs in columns.items():
        for p in probs:
            assert got[(g, p)] == pytest.approx(np.quantile(xs, p), rel=1e-12, abs=tiny), (g, p)


def test_whole_numbers_are_ordered_like_their_doubles(spark):
    rng = random.Random(9)
    xs = [0.0, 5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, float("inf"), 1.0, 1 - 2**-53, 1 + 2**-52]
    xs += [2.0**e * f for e in range(-1070, 1020, 11) for f in (1, 1 - 2**-53, 1 + 2**-52)] + [rng.lognormvariate(0, 200) for _ in range(500)]
    xs = sorted({s * x for x in xs for s in (1, -1)})
    df = _with_bits(spark.createDataFrame([(x,) for x in xs], "v double"))
    bits = {r.v: r._bits for r in df.collect()}
    expect = [int(np.float64(abs(x)).view(np.int64)) * (-1 if x < 0 else 1) for x in xs]
    assert [bits[x] for x in xs] == expect


def test_median_without_values_has_no_row(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert quantiles(value_counts(df, [], ["x"]).drop("column"), [], [0.5]).count() == 0


def test_js_distance_is_symmetric_and_bounded(spark):
    a = spark.createDataFrame([("x", "u", 0.7), ("x", "v", 0.3), ("y", "u", 1.0)], "g string, value string, share double")
    b = spark.createDataFrame([("x", "u", 0.1), ("x", "w", 0.9)], "g string, value string, share double")
    ab = {r.g: r.js_distance for r in A.js_distance(a, b, ["g"]).collect()}
    ba = {r.g: r.js_distance for r in A.js_distance(b, a, ["g"]).collect()}
    assert ab["y"] == 1.0 and 0 < ab["x"] < 1 and ab["x"] == pytest.approx(ba["x"])
    assert all(r.js_distance == 0 for r in A.js_distance(a, a, ["g"]).collect())


def test_order_breaks_across_buckets(spark):
    for values, brk, null in [([1, 2, 3, 4, 5, 6], None, None), ([1, 2, 3, 2, 5, 6], 4, None), ([1, 2, 0, 3, 4, 5], 3, None),
                              ([1, None, 3, 4, 4, 9], None, 2), ([5, 4, 3, 2, 1, 0], 2, None)]:
        df = spark.createDataFrame(
            [(i, None if v is None else float(v)) for i, v in enumerate(values)], "_ord long, v double").withColumn("g", F.lit(1)).repartition(3)
        r = R.order_breaks(df, ["g"], F.col("v"), rows=2).collect()[0]
        assert (r.rows, r.first_break, r.first_null) == (6, brk, null)


def test_asof_matches_brute_force(spark):
    rng = random.Random(5)
    ups = [(f, rng.randrange(0, 400), i) for i in range(150) for f in ("hot",)] + [("cold", 50, 900), ("cold", 50, 901)]
    outs = [("hot", rng.randrange(-20, 420), i) for i in range(200)] + [("cold", 49, 800), ("cold", 50, 801), ("none", 1, 802)]
    left = spark.createDataFrame(outs, "feed string, ts long, out long").repartition(4)
    right = spark.createDataFrame(ups, "feed string, ms long, seq long").withColumn("id", F.col("seq")).repartition(4)
    got = {r.out: r.id for r in asof_backward(left, right, ["feed"], "ts", "ms", ["id"], "seq", bucket_ms=7).select("out", "match.id").collect()}
    for feed, ts, out in outs:
        best = max(((ms, s) for f, ms, s in ups if f == feed and ms <= ts), default=(None, None))
        assert got[out] == best[1]
    assert len(got) == len(outs)


def test_newest_per_group(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("a", 2), ("b", 1)], "g string, t int")
    assert sorted((r.g, r.t) for r in newest_per_group(df, ["g"], ["t"], 2).collect()) == [("a", 2), ("a", 3), ("b", 1)]


def test_duplicates_under_a_hot_row(spark):
    df = spark.createDataFrame([("h", "x")] * 500 + [(f"k{i}", "y") for i in range(300)] + [("k1", "y"), ("k1", None)], "k string, v string").repartition(6)
    assert A.duplicate_rows(df, [], ["k", "v"]).collect()[0].duplicate_rows == 500
    assert {r.k: r.n for r in A.duplicate_keys(df, [], ["k"]).collect()} == {"h": 500, "k1": 3}


def test_cell_diff_lists_cells_rows_and_surplus(spark):
    a = spark.createDataFrame([("1", "x", "p"), ("2", "x", "p"), ("3", "x", "p")] + [("h", "x", str(i % 2)) for i in range(50)], "k string, c string, d string")
    b = spark.createDataFrame([("1", "y", "p"), ("3", "x", "p"), ("4", "x", "p")] + [("h", "x", "0") for i in range(50)], "k string, c string, d string")
    got = {(r.k, r.column, r.a, r.b, r.copies) for r in cell_diff(a, b, "k", ["c", "d"]).collect()}
    assert got == {("1", "c", "x", "y", 1), ("2", "<row>", "true", "false", 1), ("4", "<row>", "false", "true", 1),
                   ("h", "d", "1", None, 25), ("h", "d", None, "0", 25)}


def test_fingerprint_ignores_order_and_formatting_only(spark, sf):
    cols = ORDERS.names
    t = fx.truth(spark, sf).select(*cols)

    def print_of(df):
        return fingerprints(canonicalize(df, [], cols), [], cols).collect()[0].content_hash

    base = print_of(t)
    assert print_of(t.repartition(7)) == base
    assert print_of(t.withColumn("quantity", F.concat("quantity", F.lit(".0")))) == base
    assert print_of(t.withColumn("unit_price", F.expr("CASE WHEN order_id = '65' THEN '1.00' ELSE unit_price END"))) != base
    swapped = t.select(*[F.col({"product": "category", "category": "product"}.get(c, c)).alias(c) for c in cols])
    assert print_of(swapped) != base
    assert print_of(t.unionByName(t.limit(1))) != base


def test_cleaner_equals_truth_and_is_idempotent(spark, sf):
    once = clean(fx.messy(spark, sf), ORDERS)
    cols = ORDERS.names
    truth = fx.truth(spark, sf).select(*cols)
    assert once.select(*cols).exceptAll(truth).count() == 0 and truth.exceptAll(once.select(*cols)).count() == 0
    twice = clean(once, ORDERS)
    assert twice.select(*cols).exceptAll(truth).count() == 0 and twice.count() == truth.count()
    ids = [int(r.order_id) for r in once.select("order_id").collect()]
    assert ids == sorted(ids)


def test_cleaner_edge_rows(spark):
    cols = ORDERS.names
    rows = [
        (1, "1", "ann lee", "A@X.ORG", "peru", "1/2/2026", "p", "c", "2", "2.675", "Shipped"),
        (2, "2", "", "", "", "2026-01-02", "p", "c", "", "", "pending"),
        (3, "x", "bo", "b", "uk", "2026-01-02", "p", "c", "5.0", "abc", "pending"),
        (4, "4", "bo", "b", "uk", "", "p", "c", "5", "1", "pending"),
    ]
    df = spark.createDataFrame(rows, "_ord long, " + ", ".join(f"{c} string" for c in cols))
    got = {r.order_id: r for r in clean(df, ORDERS).collect()}
    assert set(got) == {"1", "2", "<NA>"}
    assert (got["1"].unit_price, got["1"].country, got["1"].email, got["1"].customer_name) == ("2.67", "peru", "a@x.org", "Ann Lee")
    assert (got["2"].quantity, got["2"].unit_price, got["2"].country, got["2"].customer_name) == ("4", "2.67", "Unknown", "Unknown")
    assert (got["<NA>"].quantity, got["<NA>"].unit_price, got["<NA>"].country, got["<NA>"].email) == ("5", "2.67", "United Kingdom", "")
    empty = clean(df.where("_ord = 2"), ORDERS).collect()[0]
    assert (empty.quantity, empty.unit_price) == ("", "")


def test_row_accounting_balances(spark, sf):
    items = {r["item"]: r["rows"] for r in row_accounting(fx.messy(spark, sf), ORDERS).collect()}
    lost = sum(v for k, v in items.items() if k == "duplicates" or k.startswith("invalid:"))
    assert items["rows_in"] - lost == items["rows_out"] == 1425 and items["rows_in"] == 1575


def test_cleaner_plan_shares_its_shuffle(spark, sf):
    """One deduplication shuffle for rows and medians, no Python worker, no local collection."""
    df = clean(fx.messy(spark, sf), ORDERS, until="format")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    reused = [x for x in plan.splitlines() if "ReusedExchange" in x and "hashpartitioning(order_id" in x]
    assert reused, "the medians have to read the rows' own deduplication shuffle"
    assert "ReusedSubquery" in plan


def test_contract_document_round_trip(tmp_path):
    yaml = pytest.importorskip("yaml")
    p = tmp_path / "c.yaml"
    p.write_text(yaml.safe_dump(ORDERS_DOC, sort_keys=False), encoding="utf-8")
    assert Contract.from_yaml(p) == ORDERS
    with pytest.raises(ValueError):
        Contract.from_dict({"key": "nope", "columns": [{"name": "a"}]})


def test_drift_cases_side_by_side_have_the_hashes_of_their_own_tables(spark):
    from tablepact.operators import drift as G
    from tablepact.operators.fingerprint import shared_fingerprints

    columns = [c for c in ORDERS.names]
    rows = [(str(i), f"N{i}", None if i == 3 else f"n{i}@x", ["usa", "", "India"][i % 3], f"0{1 + i % 9}/0{1 + i % 7}/2026", "Desk Lamp", "Home",
             str(i % 4), ["1249.5", "", "7.125", "nan"][i % 4], "shipped") for i in range(40)]
    df = spark.createDataFrame(rows + rows[:3], ", ".join(f"{c} string" for c in columns)).repartition(3)
    cases = ("baseline", "S1", "S2", "S3", "S4", "S5", "M1", "M2", "M3")
    wide, tables = G.side_by_side(df, cases)
    cells = wide.collect()
    for case in ("S5", "M1", "M2", "M3"):
        drifted = G.CASES[case](df)
        assert list(tables[case]) == drifted.columns
        assert sorted(str([r[at] for at in tables[case].values()]) for r in cells) == sorted(str(list(r)) for r in drifted.collect()), case
    got = {r["table"]: r.content_hash for r in shared_fingerprints(canonicalize(wide, [], wide.columns), tables).collect()}
    for case in ("baseline", "S5"):
        drifted = G.CASES[case](df)
        alone = fingerprints(canonicalize(drifted, [], drifted.columns), [], drifted.columns).first()
        assert got[case] == alone.content_hash, case
    assert len(set(got.values())) == len(cases)


def test_manifest_hashes_read_the_input_twice_for_all_cases(spark, sf):
    from tablepact.workload.catalog import QUERIES

    plan = QUERIES["manifest_content_hashes"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") <= 2, plan


def test_cell_diff_shuffles_the_cells_of_differing_keys_only(spark):
    a = spark.range(3000).selectExpr("CAST(id AS STRING) AS k", "concat('c', id) AS c", "CAST(NULL AS STRING) AS d")
    b = a.where("k <> '7'").selectExpr("k", "if(k IN ('11', '12'), 'x', c) AS c", "if(k = '13', '', d) AS d")
    b = b.unionByName(b.where("k IN ('20', '21')")).unionByName(spark.sql("SELECT CAST(NULL AS STRING) AS k, 'z' AS c, 'z' AS d"))
    d = cell_diff(a, b, "k", ["c", "d"])
    got = {(r.k, r.column, r.a, r.b, r.copies) for r in d.collect()}
    assert got == {("7", "<row>", "true", "false", 1), (None, "<row>", "false", "true", 1), ("11", "c", "c11", "x", 1), ("12", "c", "c12", "x", 1),
                   ("13", "d", None, "", 1), ("20", "c", None, "c20", 1), ("20", "d", None, None, 1), ("21", "c", None, "c21", 1), ("21", "d", None, None, 1)}
    files = d.inputFiles()
    assert files and all("diff_rows" in f for f in files)
    assert spark.read.parquet(*files).count() == 1 + 1 + 3 * 2 + 2 * 3
