"""Forecast invariants, streaming equivalence, and the driver contract."""

import datetime as dt
import os
import tempfile

import numpy as np
from pyspark.sql import functions as F

from ledgerline.operators import forecast as FC


def series(spark, n=120):
    rng = np.random.default_rng(5)
    rows = []
    for a, base in (("A", 100.0), ("B", 50.0)):
        y = base
        for i in range(n):
            y = max(1.0, y + rng.normal(0, 1))
            rows.append((dt.date(2024, 1, 1) + dt.timedelta(days=i), a, float(y), len(rows)))
    return spark.createDataFrame(rows, "date date, asset string, price double, row_id long")


def test_ar_and_seasonal_forecasts(spark):
    df = series(spark)
    ar = FC.ar_forecast(df, FC.fit_ar(df), horizon=10)
    assert ar.count() == 20 and ar.filter(F.col("forecasted_price") < 0).count() == 0
    se = FC.seasonal_forecast(FC.fit_seasonal(df), horizon=10)
    r = se.collect()
    assert len(r) == 20 and all(x.forecast_lower_bound <= x.forecasted_price <= x.forecast_upper_bound for x in r)


def test_recursive_forecast_linear_model(spark):
    df = series(spark)
    feats_df = FC.model_features(df)
    feats = FC.feature_columns(feats_df)
    model = FC.fit_regressor(feats_df, feats, "linear")
    out = FC.recursive_forecast(df, model, feats, horizon=6, checkpoint_every=3)
    rows = out.collect()
    assert len(rows) == 12 and all(r.forecasted_price >= 0 for r in rows)
    assert {r.step for r in rows} == set(range(1, 7))


def test_sequence_model(spark):
    model, reg = FC.fit_sequence_model(series(spark))
    out = FC.sequence_forecast(model, reg, horizon=5)
    assert out.count() == 10


def test_unknown_model_raises(spark):
    try:
        FC.forecast(series(spark), "nope")
    except ValueError:
        return
    raise AssertionError("expected ValueError")


def test_entry_and_registry(spark):
    import __spark_entry__ as E
    out = E.entry(spark)
    assert out.count() > 0 and "anomaly_count" in out.columns
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    # the training-data queries are there exactly when their package is
    import importlib.util
    there = importlib.util.find_spec("ledgerline.llm") is not None
    assert len([n for n in q if n.startswith("op")]) == (13 if there else 0) and ("pipeline" in q) == there


def test_stream_scoring_equals_batch(spark):
    from ledgerline.streaming import scoring as ST
    df = series(spark)
    params = ST.frozen_parameters(df)
    src = tempfile.mkdtemp(prefix="ll-src-")
    df.repartition(4).write.mode("overwrite").parquet(os.path.join(src, "in"))
    sink, ck = tempfile.mkdtemp(prefix="ll-sink-"), tempfile.mkdtemp(prefix="ll-ck-")
    q = ST.run_scoring(spark, os.path.join(src, "in"), df.schema, params, sink, ck, max_files_per_trigger=1)
    q.awaitTermination()
    streamed = spark.read.parquet(sink).select("row_id", "is_anomaly").orderBy("row_id").collect()
    batch = ST.score_stream(df, params).select("row_id", "is_anomaly").orderBy("row_id").collect()
    assert [tuple(r) for r in streamed] == [tuple(r) for r in batch]


def test_fx7_forecast_summary(spark):
    from ledgerline.operators.profile import forecast_summary
    rows = [(dt.date(2024, 1, 16) + dt.timedelta(days=i), "Stock A", 115 + i, "XGBoost") for i in range(5)]
    fx7 = spark.createDataFrame(rows, "date date, asset string, forecasted_price long, model_name string")
    s = forecast_summary(fx7).first()
    assert (s.forecast_rows, s.average_forecast, s.models_used, s.assets_forecasted) == (5, 117.0, ["XGBoost"], ["Stock A"])
    alias = forecast_summary(fx7.withColumnRenamed("forecasted_price", "predicted_price")).first()
    assert alias.average_forecast == 117.0
    empty = forecast_summary(fx7.limit(0)).first()
    assert (empty.forecast_rows, empty.average_forecast, empty.models_used) == (0, 0.0, [])
