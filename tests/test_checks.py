"""Every check passes on the ground truth and fires on the defect it is for."""

import json

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tablepact.contract import ORDERS
from tablepact.operators.aggregates import duplicate_rows
from tablepact.plans import metrics as M
from tablepact.plans.determinism import determinism, run_fingerprints
from tablepact.plans.provenance import input_provenance, no_output
from tablepact.plans.validate import summarize, validate_run
from tablepact.sources import tables as S
from tablepact.streaming.landing import validate_landing
from tablepact.workload import fixtures as fx
from tablepact.workload.q_checks import results


@pytest.fixture(scope="module")
def by_run(spark, sf):
    out = {}
    for r in results(spark, sf).collect():
        out.setdefault(r.run_id, {})[r.check_id] = r
    return out


def fired(checks):
    return {c: r.status for c, r in checks.items() if r.status != "PASS"}


def test_truth_passes_everything(by_run):
    assert fired(by_run["good"]) == {} and len(by_run["good"]) == 20


EXPECTED = {
    "bad_duplicate": {"CLN-01": "FAIL", "ROW-01": "FAIL", "ROW-02": "FAIL"},
    "bad_missing": {"ROW-01": "FAIL", "ROW-02": "FAIL", "SEM-04": "FAIL"},
    "bad_rename": {"SCH-01": "FAIL"}, "bad_drop": {"SCH-01": "FAIL"}, "bad_reorder": {"SCH-01": "WARN"},
    "bad_null": {"CLN-02": "FAIL", "CLN-08": "FAIL", "CLN-09": "WARN"},
    "bad_text": {"CLN-03": "FAIL", "CLN-08": "FAIL"},
    "bad_category": {"CLN-04": "FAIL", "CLN-08": "FAIL", "SEM-05": "FAIL"},
    "bad_range": {"CLN-05": "FAIL", "CLN-08": "FAIL", "SEM-03": "FAIL", "SEM-04": "FAIL"},
    "bad_imputation": {"CLN-06": "FAIL", "CLN-08": "FAIL"},
    "bad_order": {"CLN-07": "FAIL"}, "bad_format": {"CLN-09": "WARN"},
    "bad_cents": {"CLN-05": "FAIL", "CLN-06": "FAIL", "CLN-08": "FAIL", "SEM-01": "FAIL", "SEM-02": "FAIL"},
    "bad_iso": {"CLN-04": "FAIL", "CLN-08": "FAIL", "SEM-05": "FAIL"},
    "bad_cell": {"CLN-08": "FAIL"},
}


@pytest.mark.parametrize("run", EXPECTED)
def test_defect_fires_its_checks(by_run, run):
    assert fired(by_run[run]) == EXPECTED[run]


def test_type_defect(by_run):
    f = fired(by_run["bad_type"])
    assert f["SCH-02"] == "FAIL" and f["SEM-01"] == "FAIL" and f["SEM-02"] == "SKIP" and "CLN-05" not in f


def test_messages_name_the_finding(by_run):
    assert "customer_name→customer_full_name" in by_run["bad_rename"]["SCH-01"].message
    assert "unit change" in by_run["bad_cents"]["SEM-01"].message
    assert json.loads(by_run["bad_cents"]["SEM-02"].details)["median_ratio"] == pytest.approx(100)
    assert "customer_name:trimmed" in by_run["bad_text"]["CLN-03"].message
    swap = json.loads(by_run["bad_swap"]["SEM-04"].details)
    assert swap["transposed"] > 0 and swap["lost"] == swap["lost_day_gt_12"]


def test_rollup(spark, sf):
    s = {r.run_id: r for r in summarize(results(spark, sf)).collect()}
    assert s["good"].result == "PASS" and s["bad_format"].result == "WARN" and s["bad_cents"].result == "FAIL"
    assert s["bad_order"].failed == "CLN-07"


def test_empty_output_and_no_context(spark, sf):
    empty = fx.truth(spark, sf).where("false")
    r = {x.check_id: x.status for x in validate_run(spark, ORDERS, empty).collect()}
    assert r["ROW-03"] == "FAIL" and r["ROW-01"] == r["ROW-02"] == r["CLN-06"] == r["CLN-08"] == r["SEM-01"] == "SKIP"


def test_output_without_key_column(spark, sf):
    t = fx.truth(spark, sf)
    r = {x.check_id: x.status for x in validate_run(
        spark, ORDERS, t.drop("order_id"), inp=fx.messy(spark, sf).drop("_ord"), expected=t.drop("_ord"),
        baseline=t.drop("_ord")).collect()}
    assert r["SCH-01"] == "FAIL" and {r[c] for c in ("ROW-02", "CLN-06", "CLN-07", "CLN-08", "SEM-02", "SEM-04")} == {"SKIP"}


def test_imputation_target_falls_back_to_known_median(spark, sf):
    t = fx.truth(spark, sf)
    run = lambda m: {x.check_id: x.status for x in validate_run(
        spark, ORDERS, t, inp=fx.messy(spark, sf).drop("_ord"), medians=m).collect()}["CLN-06"]
    assert run({"quantity": 11.0, "unit_price": 909.4}) == "PASS"
    assert run({"quantity": 4.0, "unit_price": 909.4}) == "FAIL"


def test_wide_contract_is_split_by_column(spark, sf, monkeypatch):
    one = M.cell_metrics(fx.truth(spark, sf), ORDERS, []).selectExpr("inline(cells)")
    monkeypatch.setattr(M, "CHUNK", 9)
    many = M.cell_metrics(fx.truth(spark, sf), ORDERS, []).selectExpr("inline(cells)")
    assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, many.collect()), key=str)


def test_determinism_formatting_only(spark, sf):
    heads = {r: h for r, h in fx.run_headers().items() if r in ("good", "bad_format", "bad_cell")}
    prints = run_fingerprints(spark, fx.runs(spark, sf).where(F.col("run_id").isin(*heads)), heads, ORDERS.names)
    prints = prints.withColumn("case", F.when(F.col("run_id") == "bad_cell", "b").otherwise("a"))
    d = {r.case: r for r in determinism(prints).collect()}
    assert d["a"].status == "PASS" and not d["a"].raw_identical and d["b"].status == "SKIP"


def test_provenance_and_no_output(spark):
    ups = spark.createDataFrame([(100, "S1", "h1", 1), (200, "M1", "h2", 2)], "uploaded_at_ms long, case string, sha256 string, seq long")
    outs = spark.createDataFrame([("a", "S1", "h1", 150), ("b", "S1", "h1", 200), ("c", "S1", "h1", 50), ("d", "M1", "h2", None)],
                                 "run_id string, case string, sha256 string, ts_ms long")
    assert {r.run_id: r.status for r in input_provenance(outs, ups).collect()} == {"a": "PASS", "b": "FAIL", "c": "SKIP", "d": "SKIP"}
    assert no_output(outs.where("ts_ms < 200"), ups).collect()[0].result == "NO-OUTPUT"
    assert no_output(outs, ups).collect()[0].result == "OUTPUT"


def test_csv_keeps_order_blanks_and_byte_order_mark(spark, tmp_path):
    body = "﻿order_id,note\n" + "".join(f'{i}," x ""q"" {i}"\n' for i in range(2000)) + "2000,\n"
    (tmp_path / "in.csv").write_text(body, encoding="utf-8")
    df = S.scan_raw_strings(spark, str(tmp_path / "in.csv"))
    assert df.columns == ["_ord", "order_id", "note"]
    rows = df.orderBy("_ord").collect()
    assert [r.order_id for r in rows] == [str(i) for i in range(2001)]
    assert rows[5].note == ' x "q" 5' and rows[-1].note == ""
    S.write_clean_csv(df.orderBy("_ord"), str(tmp_path / "out"))
    assert S.scan_raw_strings(spark, str(tmp_path / "out")).drop("_ord").exceptAll(df.drop("_ord")).count() == 0


def test_landing_stream_sees_drift_and_merges_batches(spark, sf, tmp_path):
    t = fx.truth(spark, sf).drop("_ord").orderBy(F.col("order_id").cast("long"))
    land, rep, state = (str(tmp_path / n) for n in ("land", "rep", "state"))
    half = t.count() // 2

    def drop(run, df, name):
        folder = tmp_path / "land" / f"run_id={run}"
        folder.mkdir(parents=True, exist_ok=True)
        df.toPandas().to_csv(folder / name, index=False)

    def go():
        validate_landing(spark, ORDERS, land, rep, state, expected=t).awaitTermination()
        return {r.run_id: r for r in S.read_check_reports(spark, rep).collect()}

    def check(report, check_id):
        return next((c.status, c.message) for c in report.checks if c.check_id == check_id)

    drop("whole", t, "a.csv")
    drop("S1", t.drop("country"), "a.csv")
    drop("S2", t.withColumnRenamed("customer_name", "customer_full_name"), "a.csv")
    drop("S4", t.withColumn("discount_code", F.lit("")), "a.csv")
    drop("007", t.limit(half), "a.csv")
    got = go()
    assert set(got) == {"whole", "S1", "S2", "S4", "007"} and got["whole"].result == "PASS"
    assert check(got["S1"], "SCH-01")[0] == "FAIL" and "country" in check(got["S1"], "SCH-01")[1]
    assert "customer_name→customer_full_name" in check(got["S2"], "SCH-01")[1] and "discount_code" in check(got["S4"], "SCH-01")[1]
    assert check(got["007"], "ROW-02")[0] == "FAIL"
    # The second half lands in a batch of its own; the run is then whole.
    drop("007", t.offset(half), "b.csv")
    got = go()
    assert got["007"].result == "PASS" and check(got["007"], "ROW-02")[0] == "PASS" and len(got) == 5
    # A batch whose commit was lost is repeated and changes nothing.
    commits = sorted((tmp_path / "state" / "checkpoint" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    for f in (commits[-1], commits[-1].with_name(f".{commits[-1].name}.crc")):
        f.unlink(missing_ok=True)
    again = go()
    assert {r: (x.result, len(x.checks)) for r, x in again.items()} == {r: (x.result, len(x.checks)) for r, x in got.items()}
    assert S.read_check_reports(spark, rep).count() == 5


def test_comparisons_by_key_need_no_copies_per_run(spark, sf):
    rs = fx.run_set(spark, sf)
    patterns, _, _ = M.key_patterns(rs)
    plan = patterns._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "SortAggregate" not in plan and "CartesianProduct" not in plan

    def counted(r):
        return {tuple(x) for x in M.key_facts(r).where("run_id = 'bad_missing' OR run_id = 'bad_duplicate'").collect()}

    copies = fx.runs(spark, sf).where("run_id IN ('bad_missing', 'bad_duplicate')")
    many = copies
    heads = {r: fx.COLUMNS for r in ("bad_missing", "bad_duplicate")}
    for i in range(12):
        many = many.unionByName(copies.withColumn("run_id", F.concat("run_id", F.lit(f"_{i}"))))
        heads |= {f"{r}_{i}": fx.COLUMNS for r in ("bad_missing", "bad_duplicate")}
    large = replace(rs, outputs=many, headers=heads, cases={r: "baseline" for r in heads})
    assert counted(large) == counted(rs) and any(f[1] == "ROW-02" and f[4] > 0 for f in counted(rs))


def test_repeated_reference_keys_do_not_multiply_rows(spark, sf):
    rs = fx.run_set(spark, sf)
    twice = replace(rs, expected=rs.expected.unionByName(rs.expected), baseline=rs.baseline.unionByName(rs.baseline))
    assert sorted(map(str, M.key_facts(twice).collect())) == sorted(map(str, M.key_facts(rs).collect()))


def test_saved_runs_are_neither_shuffled_nor_stored(spark, sf):
    runs = fx.runs(spark, sf)
    assert sorted(runs.inputFiles()) == sorted(fx.truth(spark, sf).inputFiles())
    assert "Exchange" not in runs._jdf.queryExecution().executedPlan().toString()


def test_rows_without_copies_are_not_shuffled_whole(spark, request):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.autoBroadcastJoinThreshold"))
    rows = spark.range(3000).selectExpr("'a' AS run", "id % 2999 AS k", "repeat(cast(id % 2999 AS string), 50) AS text")
    found = duplicate_rows(rows, ["run"], ["k", "text"])
    assert "BroadcastHashJoin" in found._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in found.collect()] == [("a", 1)]


def test_compressed_csv_keeps_headers(spark, sf, tmp_path):
    S.write_clean_csv(fx.truth(spark, sf), str(tmp_path / "out"), "gzip")
    assert list((tmp_path / "out").glob("*.csv.gz"))
    assert {tuple(r.header) for r in S.csv_headers(spark, str(tmp_path / "out")).collect()} == {tuple(ORDERS.names)}


def test_outputs_meet_references_unsorted(spark, sf, request):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.autoBroadcastJoinThreshold"))
    patterns, _, _ = M.key_patterns(fx.run_set(spark, sf), ["SEM-02", "SEM-04"])
    plan = patterns._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "BuildRight" in plan
    of_outputs = plan.split("ShuffledHashJoin")[0]
    assert "SortMergeJoin" not in of_outputs and "Sort [" not in of_outputs


def test_repeated_keys_are_found_by_hashes(spark, monkeypatch):
    stored, write = [], M.materialize
    monkeypatch.setattr(M, "materialize", lambda df, name: stored.append(df.columns) or write(df, name))
    a = spark.createDataFrame([("x", 1), ("x", 1), ("x", 2), ("y", 1), ("y", 3), ("y", 3), ("y", 3)], "group string, _k long")
    b = spark.createDataFrame([(None, 1), (None, 2), (None, 2)], "group string, _k long")
    found = M._repeated({"outputs": a, "baseline": b})
    assert stored[0] == ["_h"]  # eight bytes a row are shuffled
    assert {s: (sorted(map(tuple, df.collect()), key=str), n) for s, (df, n) in found.items()} == {
        "outputs": ([("x", 1, 2), ("y", 3, 3)], 2), "baseline": ([(None, 2, 2)], 1)}
    none = M._repeated({"outputs": b.limit(0), "baseline": a.distinct()})
    assert all(n == 0 and not df.collect() and df.columns == ["group", "_k", "n"] for df, n in none.values())
