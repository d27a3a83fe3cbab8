"""The CSV scanner against Python's csv module, with files cut into many splits."""

import csv
import io
import random

import pytest

from tablepact.sources.csv_scan import csv_headers, scan_raw_strings


@pytest.fixture
def tiny_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "512", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def rows_of(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.orderBy("_ord").collect()]


def test_quoted_line_breaks_over_splits(spark, tmp_path, tiny_splits):
    rng = random.Random(3)
    cells = ["", "a", "b c", 'say "x"', "two\nlines", "many\n\n\nlines" * 30, "comma, inside", '"', '""', "\n", "é\x01\x02a", "1"]
    rows = [[str(i), rng.choice(cells), rng.choice(cells)] for i in range(150)]
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=rng.choice(["\n", "\r\n"]))
    writer.writerow(["k", "a\nname", "c"])
    writer.writerows(rows)
    (tmp_path / "in.csv").write_text("﻿" + out.getvalue(), encoding="utf-8", newline="")
    df = scan_raw_strings(spark, str(tmp_path / "in.csv"), corrupt="bad")
    assert df.columns == ["_ord", "k", "a\nname", "c", "bad"] and df.rdd.getNumPartitions() >= 1
    assert rows_of(df, "k", "a\nname", "c", "bad") == [(*r, None) for r in rows]


def test_layouts_ragged_rows_and_blank_lines(spark, tmp_path, tiny_splits):
    (tmp_path / "1.csv").write_text('k,a\n\n1,x\n2\n3,y,z\n"4","q"\n')
    (tmp_path / "2.csv").write_text('\r\na,k,b\r\nx,1,"l\r\nm"\r\ny,2,\r\n')
    (tmp_path / "3.csv").write_text("")
    (tmp_path / "4.csv").write_text('k\n5\n"open\nto the end\n')
    df = scan_raw_strings(spark, str(tmp_path), corrupt="bad")
    assert rows_of(df, "k", "a", "b", "bad") == [
        ("1", "x", None, None), ("2", "", None, "2"), ("3", "y", None, "3,y,z"), ("4", "q", None, None),
        ("1", "x", "l\r\nm", None), ("2", "y", "", None), ("5", None, None, None), ("open\nto the end", None, None, '"open\nto the end')]
    heads = {r["file"][-5:]: r["header"] for r in csv_headers(spark, str(tmp_path)).collect()}
    assert heads == {"1.csv": ["k", "a"], "2.csv": ["a", "k", "b"], "4.csv": ["k"]}
    assert rows_of(scan_raw_strings(spark, str(tmp_path), header=["b", "none"]), "b", "none")[4] == ("l\r\nm", None)


def test_nothing_to_scan(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "head").mkdir()
    (tmp_path / "head" / "only.csv").write_text("k,a\n")
    assert scan_raw_strings(spark, str(tmp_path / "empty.csv")).count() == 0
    only = scan_raw_strings(spark, str(tmp_path / "head"), corrupt="bad")
    assert only.count() == 0 and only.columns == ["_ord", "k", "a", "bad"]


def test_lines_are_ordered_again_only_where_cells_run_over_them(spark, tmp_path):
    (tmp_path / "in.csv").write_text('k,a\n1,"x, y"\n2,z\n')
    df = scan_raw_strings(spark, str(tmp_path / "in.csv"))
    assert rows_of(df, "k", "a") == [("1", "x, y"), ("2", "z")]
    assert scan_raw_strings(spark, str(tmp_path / "in.csv"), sep=";").columns == ["_ord", "k,a"]
