"""Sources and sinks (IO*): errors on missing/empty input, records, state."""

import os
import tempfile

import pytest

from ledgerline.sources import files as IO


def test_csv_missing_and_empty(spark):
    with pytest.raises(IO.DataFileError):
        IO.load_csv(spark, "/nonexistent/file.csv")
    d = tempfile.mkdtemp(prefix="ll-csv-")
    p = os.path.join(d, "empty.csv")
    with open(p, "w") as f:
        f.write("Date,Asset,Price\n")
    with pytest.raises(ValueError):
        IO.load_csv(spark, p, ["Date", "Asset", "Price"])


def test_records_to_frame_lists_and_singles(spark):
    df = spark.createDataFrame([('[{"date": "2024-01-01", "asset": "A", "price": 100.0},'
                                 ' {"date": "2024-01-02", "asset": "A", "price": 101.0}]',),
                                ('{"date": "2024-01-03", "asset": "B", "price": 5.5}',)], "body string")
    rows = IO.records_to_frame(df, "body").collect()
    assert [(r.asset, r.price) for r in rows] == [("A", 100.0), ("A", 101.0), ("B", 5.5)]


def test_state_roundtrip_and_missing(spark):
    root = tempfile.mkdtemp(prefix="ll-state-")
    t = spark.createDataFrame([("A", 1.0)], "asset string, iqr_q1 double")
    IO.save_state({"Fences": t}, root)
    assert IO.load_state(spark, root, ["Fences"])["Fences"].first().iqr_q1 == 1.0
    with pytest.raises(IO.DataFileError):
        IO.load_state(spark, root, ["nope"])
    status, df = IO.load_metrics(spark, os.path.join(root, "missing.json"))
    assert status == "missing" and df.count() == 0


def test_json_safe_and_ragged_union(spark):
    df = spark.createDataFrame([(float("nan"), "x")], "v double, s string")
    assert IO.to_json_records(df).first().record == '{"s":"x"}'
    a = spark.createDataFrame([(1, "a")], "id int, x string")
    b = spark.createDataFrame([(2, 3.0)], "id int, y double")
    u = IO.ragged_union([a, b], ["y"])
    assert u.columns == ["y", "id", "x"] and u.count() == 2
