"""Byte bound of the size-checked broadcast, six-digit MSE, and the status of failing models."""

import pytest
from pyspark.sql import functions as F

from ledgerline.functions.broadcast import broadcast_if_small
from ledgerline.operators import forecast as FC
from ledgerline.operators import metrics as M


def _hinted(df):
    return "strategy=broadcast" in df._jdf.queryExecution().analyzed().toString()


def test_broadcast_needs_few_bytes_and_leaves_nothing_persisted(spark):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    wide = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("s"))
    assert _hinted(broadcast_if_small(wide))
    big = broadcast_if_small(wide, max_bytes=50_000)
    assert not _hinted(big) and big.count() == 100
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_broadcast_of_an_empty_table(spark):
    assert broadcast_if_small(spark.range(0)).count() == 0


def test_small_errors_keep_six_digits(spark):
    df = spark.createDataFrame([(1.0, 1.01), (2.0, 2.01)], "actual_price double, predicted_price double")
    assert M.metric_set(df).first()["mse"] == pytest.approx(1e-4)


def test_a_failing_model_is_reported(spark, monkeypatch):
    def one(df, name, horizon):
        if name != "arima":
            raise ValueError("no rows")
        return df.withColumn("model_name", F.lit(name))

    monkeypatch.setattr(FC, "_forecast_one", one)
    with pytest.warns(UserWarning, match="no rows"):
        out, status = FC.forecast(spark.range(2).toDF("asset"), return_status=True)
    got = {r["model_name"]: (r["status"], r["error"]) for r in status.collect()}
    assert out.count() == 2 and set(got) == set(FC.MODEL_NAMES)
    assert got.pop("arima") == ("available", None) and set(got.values()) == {("failed", "no rows")}
    with pytest.raises(ValueError):
        FC.forecast(spark.range(2).toDF("asset"), "lstm")
