"""The versioned model store: equal results after a reload in another session, and no half-written version."""

import datetime as dt
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import anomaly as A
from ledgerline.operators import forecast as FC
from ledgerline.operators import trees as T
from ledgerline.session import scratch_path
from ledgerline.sources.files import DataFileError
from ledgerline.sources.model_store import ModelStore, load_boosted, load_detector, save_boosted, save_detector


@pytest.fixture
def root(spark):
    return scratch_path(spark, f"store-{uuid.uuid4().hex}")


def prices(spark, n=200):
    rng = np.random.default_rng(3)
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), a, float(100 + rng.normal(0, 5)), 1000 * k + i) for k, a in enumerate("AB") for i in range(n)]
    return spark.createDataFrame(rows, "date date, asset string, price double, row_id long")


def test_detector_reloads_in_another_session(spark, root):
    df = prices(spark)
    history, new = df.filter(F.col("date") < "2024-06-01"), df.filter(F.col("date") >= "2024-06-01")
    state = A.fit_state(history, n_trees=15)
    version = save_detector(ModelStore(spark, root), state)
    other = spark.newSession()
    saved = load_detector(ModelStore(other, root))
    assert ModelStore(other, root).current() == version and set(saved) == {"fences", "moments", "fills", "forest"}
    a = A.score_new_data(new, state, mode="frozen").orderBy("row_id").collect()
    b = A.score_new_data(other.createDataFrame(new.collect(), new.schema), saved, mode="frozen").orderBy("row_id").collect()
    assert [tuple(r) for r in a] == [tuple(r) for r in b] and any(r.is_anomaly_isolation_forest for r in b)


def test_boosted_and_linear_models_reload(spark, root):
    df = FC.model_features(prices(spark))
    feats = FC.feature_columns(df)
    model = T.fit_boosted(df, feats, p=T.Boosting(trees=12, depth=3))
    store = ModelStore(spark, root)
    save_boosted(store, model)
    again = load_boosted(store)
    x = np.array([[float(r[c]) for c in feats] for r in df.collect()])
    assert (again.predict(x) == model.predict(x)).all() and again.importances() == model.importances()
    linear = FC.fit_regressor(df, feats[:3], "linear")
    store.save({}, {"price": linear}, {"features": feats[:3]})
    got = store.load()
    assert got["models"]["price"].coefficients == linear.coefficients and got["values"]["features"] == feats[:3]
    assert len(store.versions()) == 2


def test_half_written_versions_are_never_read(spark, root):
    store = ModelStore(spark, root)
    with pytest.raises(DataFileError):
        store.load()
    good = store.save({"t": spark.range(3)})
    broken = spark.range(5).withColumn("x", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        store.save({"t": spark.range(9), "u": broken})
    assert store.current() == good and store.versions() == [good] and store.load()["tables"]["t"].count() == 3

    def refuse(loaded):
        assert loaded["tables"]["t"].count() == 4
        raise ValueError("not good enough")
    with pytest.raises(ValueError):
        store.save({"t": spark.range(4)}, check=refuse)
    assert store.current() == good and len(store.versions()) == 2      # whole, but not current
    newest = store.save({"t": spark.range(6)})
    assert store.load()["tables"]["t"].count() == 6 and store.load(good)["tables"]["t"].count() == 3
    store.save({"t": spark.range(7)})
    assert good in store.prune(2) and newest in store.versions() and store.load()["tables"]["t"].count() == 7
