"""What keeps the work of a query in proportion to its rows: plans, and results on cells that take the short ways."""

from pyspark.sql import functions as F

from tablepact.operators.fingerprint import canonicalize, column_classes


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_canonical_cells_are_not_shuffled(spark):
    df = spark.createDataFrame([("a", "1.50"), ("a", "2"), ("b", "x")], "run string, v string")
    out = canonicalize(df, ["run"], ["v"])
    assert "Exchange hashpartitioning" not in plan_of(out)
    assert sorted(map(tuple, out.collect())) == [("a", "1.50"), ("a", "2.00"), ("b", "x")]


def test_classes_and_canonical_cells_of_odd_spellings(spark):
    whole = {" 7": "7", "007": "7", "+7": "7", "1e3": "1000", "7.0": "7", "12 ": "12", "nan": "", "123456789012345678": "123456789012345678", "-0": "0"}
    decimal = {"1.50": "1.50", "1.5": "1.50", "0.005": "0.01", "0.015": "0.01", "01.50": "1.50", "1.50 ": "1.50", "1.e5": "100000.00", "-1.50": "-1.50", "15": "15.00", "NULL": ""}
    date = {"2026-01-05": "2026-01-05", "2026-1-5": "2026-01-05", "2026-01-5 ": "2026-01-05", "20260105": "2026-01-05", "2026-01-05 10:00:00": "2026-01-05", " 2026-01-05": "2026-01-05", "None": ""}
    text = {"a ": "a", "I": "I", "inf": "inf", "12x": "12x", "2026-13-45": "2026-13-45", "É ": "É", "\u00a0b": "b", "": ""}
    for kind, cells in (("int", whole), ("decimal", decimal), ("date", date), ("text", text)):
        df = spark.createDataFrame([("r", v, v) for v in cells] + [("r", None, "lacks")], "run string, v string, was string")
        assert column_classes(df, ["run"], ["v"]).first().v == kind
        got = {r.was: r.v for r in canonicalize(df, ["run"], ["v"]).collect()}
        assert got == cells | {"lacks": None}
        assert {r.was: r.v for r in canonicalize(df, [], ["v"]).collect()} == got
    mixed = spark.createDataFrame([("2026-01-05",), ("12",)], "v string").withColumn("run", F.lit("r"))
    assert column_classes(mixed, ["run"], ["v"]).first().v == "text"
    assert column_classes(mixed.limit(0), [], ["v"]).first().v == "text"


def test_large_files_are_hashed_as_streams(spark, tmp_path, monkeypatch):
    import hashlib
    import random

    from tablepact.sources import tables as S

    monkeypatch.setattr(S, "WHOLE_FILE", 1000)
    r = random.Random(1)
    noise = r.randbytes(300_000)
    files = {"noise": noise, "ended": noise + b"\n", "marked": b"\xef\xbb\xbf" + noise, "marked ended": b"\xef\xbb\xbf" + noise + b"\n", "feeds": b"\n" * 5000,
             "carriage": b"\r\n" * 3000 + b"\r", "one line": b"x" * 200_000, "small": b"a\nb", "noise.gz": noise}
    for n, body in files.items():
        (tmp_path / n).write_bytes(body)
    got = S.file_fingerprints(spark, str(tmp_path))
    rows = {r.path.rsplit("/", 1)[-1]: r for r in got.collect()}
    assert {r.path for r in spark.read.format("binaryFile").load(str(tmp_path)).select("path").collect()} == {r.path for r in rows.values()}
    assert {n: (r.length, r.sha256, r.md5) for n, r in rows.items()} == {
        n: (len(b), hashlib.sha256(b).hexdigest(), hashlib.md5(b).hexdigest()) for n, b in files.items()}
    # Only the small and the packed ones are read as one cell, so a file may be larger than a cell.
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", 250_000)
    try:
        (tmp_path / "noise.gz").unlink()
        assert S.file_fingerprints(spark, str(tmp_path)).count() == len(files) - 1
        assert {r.length for r in S.file_fingerprints(spark, str(tmp_path)).collect()} >= {300_000}
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")


def test_signatures_are_not_broadcast(spark):
    from tablepact.llm.spelling_variants import near_pairs

    words = spark.createDataFrame([("planet", 9), ("planets", 7), ("plane", 5), ("plamet", 5)], "word string, n long")
    found = near_pairs(words)
    assert plan_of(found).count("SortMergeJoin [sig#") == 2
    assert {(r.a, r.b) for r in found.collect()} >= {("planet", "planets"), ("plamet", "planet"), ("plane", "planet")}


def test_runs_are_written_unsorted(spark, tmp_path):
    from tablepact.sources import tables as S

    before = spark.conf.get(S.RUN_WRITERS)
    rows = [("c", f"r{i % 40}", str(i)) for i in range(2000)]
    S.write_run_output(spark.createDataFrame(rows, "case string, run_id string, v string").repartition(2), str(tmp_path / "runs"))
    assert spark.conf.get(S.RUN_WRITERS) == before
    back = S.read_run_results(spark, str(tmp_path / "runs"))
    assert sorted((r.case, r.run_id, r.v) for r in back.collect()) == sorted(rows)


def test_rows_are_counted_without_reading_cells(spark, sf):
    from tablepact.plans.validate import run_metrics
    from tablepact.workload import fixtures as fx

    wide = run_metrics(fx.run_set(spark, sf), ["SCH-01"])
    assert "cells" not in wide.columns and "RLIKE" not in plan_of(wide)
    assert {r.run_id: r["rows"] for r in wide.collect()} == {r.run_id: r["count"] for r in fx.runs(spark, sf).groupBy("run_id").count().collect()}
