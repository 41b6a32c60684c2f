"""Cleaning (C*) on the fixtures of FIXTURES.md A/C."""

import math

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import cleaning as C


def fx1(spark):
    rows = [("2024-01-01", "Stock A", 100.0), ("2024-01-02", "Stock A", 101.0),
            ("2024-01-03", "Bond A", 90.0), (None, "Stock A", 102.0), ("2024-01-05", None, 103.0)]
    return spark.createDataFrame(rows, "Date string, Asset string, Price double")


def test_fx1_clean_prices_keeps_three_rows(spark):
    out = C.clean_prices(fx1(spark))
    assert out.columns[:3] == ["date", "asset", "price"]
    assert out.count() == 3
    assert dict(out.dtypes)["date"] == "date"


def test_fx2_bad_prices(spark):
    df = spark.createDataFrame([("2024-01-01", "A", "100.0"), ("2024-01-02", "A", "-50.0"),
                                ("2024-01-03", "A", "invalid")], "Date string, Asset string, Price string")
    out = C.clean_prices(df).collect()
    assert [r.price for r in out] == [100.0]


def test_fx3_missing_column_raises(spark):
    df = spark.createDataFrame([("2024-01-01", "A")], "Date string, Asset string")
    with pytest.raises(C.MissingColumnError):
        C.clean_prices(df)


def test_fx4_empty_raises(spark):
    df = spark.createDataFrame([], "date string, asset string, price string")
    with pytest.raises(C.EmptyDataError):
        C.clean_portfolio(df)


def test_fx19_text_numbers(spark):
    df = spark.createDataFrame([("NaN",), ("Infinity",), ("",), (" 12.5 ",), ("-3",)], "price string")
    vals = [r.price for r in C.coerce_numeric(df).collect()]
    assert vals[:3] == [None, None, None]
    assert vals[3] == 12.5 and vals[4] == -3.0


def test_fx20_mode_tie_smallest_and_all_null(spark):
    df = spark.createDataFrame([("b", None), ("a", None), ("b", None), ("a", None), (None, None)],
                               "cat string, empty string")
    out = C.impute_categorical(df, "mode", ["cat", "empty"]).collect()
    assert {r.cat for r in out} == {"a", "b"}
    assert out[4].cat == "a"
    assert all(r.empty == C.UNKNOWN for r in out)


def test_fx23_asset_types_first_match_wins(spark):
    df = spark.createDataFrame([("Equity Fund",), ("Gold ETF",), ("Bitcoin",), ("Unknown X",),
                                ("Treasury Bond",)], "asset_name string")
    got = [r.asset_type for r in C.with_asset_type(df).collect()]
    assert got == ["stock", "fund", "crypto", "stock", "bond"]


def test_portfolio_value_counts_rows_before_removal(spark):
    df = spark.createDataFrame([("2024-01-01", "A", "10"), ("2024-01-01", "B", "-4"),
                                ("2024-01-01", "A", "10")], "date string, asset string, price string")
    out = C.clean_portfolio(df).collect()
    assert len(out) == 1                      # duplicate and negative removed
    assert out[0].portfolio_value == 16.0     # ... after the portfolio value was taken


def test_winsorize_skips_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (100.0, 5.0)], "x double, c double")
    out = C.winsorize_iqr(df, ["x", "c"]).collect()
    assert out[3].x < 100.0 and all(r.c == 5.0 for r in out)


def test_validate_records_split(spark):
    df = spark.createDataFrame([("2024-01-01", " A ", "1"), ("", "A", "1"), ("2024-01-01", "", "1"),
                                ("2024-01-01", "A", "-1"), ("2024-01-01", "A", "x")],
                               "date string, asset string, price string")
    valid, rejects = C.validate_records(df)
    assert valid.count() == 1 and valid.first().asset == "A"
    reasons = sorted(r.reject_reason for r in rejects.collect())
    assert reasons == ["asset must not be empty", "date must not be empty", "price must be >= 0",
                       "price must be a number"]


def test_fill_feature_nulls_median_then_zero(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (3.0, None), (float("inf"), None)],
                               "a double, b double")
    out = C.fill_feature_nulls(df, ["a", "b"]).collect()
    assert [r.a for r in out] == [1.0, 2.0, 3.0, 2.0]
    assert all(r.b == 0.0 for r in out)
    assert not any(math.isnan(r.a) for r in out)


def test_slug(spark):
    df = spark.createDataFrame([(" Gold/Silver-ETF x\\y ",)], "asset string")
    assert C.with_asset_slug(df).first().asset_slug == "gold_silver_etf_x_y"
    assert F is not None


def test_clean_prices_keeps_names_and_wants_rows(spark):
    import pytest

    from ledgerline.operators.cleaning import EmptyDataError, clean_prices
    rows = [("2024-01-01", " A", "1"), ("2024-01-01", "A", "2"), ("2024-01-02", "A ", "-3"), ("2024-01-02", "", "4")]
    df = spark.createDataFrame(rows, "Date string, Asset string, Price string")
    assert sorted((r.asset, r.price) for r in clean_prices(df).collect()) == [("", 4.0), (" A", 1.0), ("A", 2.0)]
    with pytest.raises(EmptyDataError):
        clean_prices(df.limit(0))
    assert clean_prices(df.limit(0), check_empty=False).count() == 0
