from datetime import date, timedelta

import pytest
from helpers import rows
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millpond.operators import features, forecast, tables
from millpond.session import new_folder

START = date(2017, 1, 1)


@pytest.fixture(scope="module")
def panel(spark):
    """Two long series with a weekly pattern and one that is too short to train."""
    data = []
    for store, days in ((1, 80), (2, 60), (3, 5)):
        for i in range(days):
            data.append((store, "EGGS", START + timedelta(days=i), 100.0 * store + 10 * (i % 7), i % 2, 50.0, 0))
    frame = spark.createDataFrame(data, "store_nbr INT, family STRING, ds DATE, y DOUBLE, onpromotion INT, oil_price DOUBLE, is_holiday INT")
    return forecast.lag_features(frame).cache()


def test_panel_folds_repeated_days(spark):
    df = spark.createDataFrame([(1, "A", START, 2.0, 1), (1, "A", START, 3.0, 0)], "store_nbr INT, family STRING, date DATE, sales DOUBLE, onpromotion INT")
    assert rows(forecast.panel(df, extras=["onpromotion"])) == [(1, "A", START, 5.0, 1)]


def test_training_window(spark):
    df = spark.createDataFrame([(4, date(2016, 1, 1)), (4, date(2017, 3, 1)), (3, date(2018, 2, 1)), (5, date(2018, 3, 1))], "store_nbr INT, date DATE")
    assert rows(forecast.training_window(df, 12, "2017-01-01", 4)) == [(4, date(2017, 3, 1)), (5, date(2018, 3, 1))]


def test_holiday_flags_and_star_join(spark):
    holiday = "date DATE, type STRING, locale STRING, locale_name STRING, description STRING, transferred BOOLEAN"
    entries = [
        (START, "Holiday", "National", "ALL", "n", True),
        (START, "Holiday", "Local", "Quito", "l", False),
        (START, "Holiday", "Local", "Quito", "l2", True),
        (START, "Holiday", "Regional", "Azuay", "r", None),
    ]
    train = spark.createDataFrame([(1, START, 1, "A", 1.0, 0), (2, START, 2, "A", 1.0, 0)], "id BIGINT, date DATE, store_nbr INT, family STRING, sales DOUBLE, onpromotion INT")
    stores = spark.createDataFrame([(1, "Quito", "Pichincha", "A", 1), (2, "Cuenca", "Azuay", "B", 2)], "store_nbr INT, city STRING, state STRING, type STRING, cluster INT")
    oil = spark.createDataFrame([(START, 50.0)], "date DATE, dcoilwtico DOUBLE")
    got = features.model_input(train, stores, oil, spark.createDataFrame(entries, holiday))
    flags = rows(got.select("id", "national_holiday", "regional_holiday", "local_holiday", "is_holiday", "oil_price"))
    assert flags == [(1, 0, 0, 1, 1, 50.0), (2, 0, 1, 0, 1, 50.0)]


def test_one_hot_equals_the_vector_route(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate("AABBBCDA")], "id INT, type STRING")
    mine = features.one_hot(df, features.labels(df, ["type"]))
    indexed = StringIndexer(inputCol="type", outputCol="n").fit(df)
    vectors = OneHotEncoder(inputCol="n", outputCol="v").fit(indexed.transform(df)).transform(indexed.transform(df))
    found = indexed.labels[:-1]
    theirs = vectors.withColumn("a", vector_to_array("v")).select("id", *[F.col("a")[i].alias(f"type_{t}") for i, t in enumerate(found)])
    assert mine.columns == theirs.columns and rows(mine) == rows(theirs)


def test_labels_are_counted_per_column(spark):
    pairs = [(f"a{i}", f"b{j}") for i in range(60) for j in range(60)] + [("a7", None)]
    found = features.labels(spark.createDataFrame(pairs, "x string, y string"), ["x", "y"])
    assert found["x"][0] == "a7" and sorted(found["x"]) == sorted({p[0] for p in pairs})
    assert found["y"] == sorted({p[1] for p in pairs if p[1]})


def test_labels_are_ranked_by_sales_and_unknown_stores_have_none(spark):
    stores = spark.createDataFrame([(1, "A", 3), (2, "B", 3), (3, "C", 4), (4, None, 9)], "store_nbr INT, type STRING, cluster INT")
    sold = spark.createDataFrame([(2,), (2,), (2,), (1,), (3,), (99,), (4,)], "store_nbr INT")
    known = features.sales_labels(sold, stores, ["type", "cluster"])
    assert known == {"type": ["B", "A", "C"], "cluster": ["3", "4", "9"]}
    indexed = features.frequency_index(stores, known)
    assert [tuple(r)[3:] for r in indexed.orderBy("store_nbr").collect()] == [(1.0, 0.0), (0.0, 0.0), (2.0, 1.0), (None, 2.0)]


def test_backtest_windows_do_not_overlap_training(panel):
    held = forecast.backtest_splits(panel, 7, 2)
    counts = held.filter("store_nbr = 1").groupBy("cutoff").count().orderBy("cutoff").collect()
    assert [tuple(r) for r in counts] == [(START + timedelta(days=65), 7), (START + timedelta(days=72), 7)]
    train = forecast.training_rows(panel, 7, 2).filter("store_nbr = 1")
    assert train.agg(F.max("ds")).first()[0] == START + timedelta(days=65)
    assert train.count() + 14 == panel.filter("store_nbr = 1").count()


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([(1, "A", START, 2.0, 1.0), (1, "A", START, 4.0, 5.0), (1, "A", START, 0.0, 1.0)], "store_nbr INT, family STRING, cutoff DATE, y DOUBLE, prediction DOUBLE")
    got = forecast.metrics(df).first()
    assert got.rmse == 1.0 and got.mape == pytest.approx((0.5 + 0.25) / 2)
    means = {r.metric: r.value for r in forecast.mean_metrics(forecast.metrics(df)).collect()}
    assert means["rmse"] == 1.0


def test_direct_targets_read_ahead(panel):
    got = forecast.direct_targets(panel.filter("store_nbr = 3").select("store_nbr", "family", "ds", "y"), 3)
    first = rows(got.filter(F.col("ds") == START).select("step", "target"))
    assert first == [(1, 310.0), (2, 320.0), (3, 330.0)]
    assert got.count() == 4 + 3 + 2


def test_known_columns_are_those_of_the_target_day(panel):
    ahead = forecast.direct_targets(panel, 3, known=["onpromotion", "month"]).filter("store_nbr = 3")
    got = [tuple(r) for r in ahead.orderBy("ds", "step").select("step", "onpromotion", "target").collect()]
    promoted, sold = [i % 2 for i in range(5)], [300.0 + 10 * (i % 7) for i in range(5)]
    assert got == [(k, promoted[i + k], sold[i + k]) for i in range(5) for k in (1, 2, 3) if i + k < 5]


def test_sales_after_the_cutoff_change_no_feature_of_the_held_out_week(spark, panel):
    """What a model sees of the held-out rows is the same whatever was sold in them."""
    plain = panel.select("store_nbr", "family", "ds", "y", *forecast.EXOGENOUS).filter("store_nbr = 1")
    late = F.when(F.col("ds") > START + timedelta(days=72), F.lit(1e6)).otherwise(F.col("y"))
    seen = [
        rows(forecast.backtest_splits(forecast.lag_features(f)).select("ds", *forecast.HELD_OUT_FEATURES))
        for f in (plain, plain.withColumn("y", late))
    ]
    assert len(seen[0]) == 7 and seen[0] == seen[1]


def test_future_frame(panel):
    got = forecast.future_frame(panel, 7, {"oil_price": 50}).filter("store_nbr = 3")
    assert [str(r.ds) for r in got.orderBy("ds").collect()] == [str(START + timedelta(days=4 + k)) for k in range(1, 8)]
    assert {r.oil_price for r in got.collect()} == {50}


def test_per_series_models_and_their_failures(panel):
    got = {r.model_name: r for r in forecast.fit_per_series(panel).collect()}
    assert got["1_EGGS_model"].status and got["2_EGGS_model"].status
    assert got["1_EGGS_model"].rmse < 20
    assert not got["3_EGGS_model"].status and got["3_EGGS_model"].rmse == 0.0
    assert "before the cutoff" in got["3_EGGS_model"].message


def test_stored_coefficients_give_the_reported_error(panel):
    models = forecast.fit_per_series(panel)
    scored = forecast.score_per_series(models, forecast.backtest_splits(panel, 7, 1))
    errors = {f"{r.store_nbr}_{r.family}_model": r.rmse for r in forecast.metrics(scored).collect()}
    logged = {r.model_name: r.rmse for r in models.filter("status").collect()}
    assert {k for k, v in errors.items() if v is not None} == logged.keys()
    assert errors["3_EGGS_model"] is None  # rows of a failed series stay, without a prediction
    for name, value in logged.items():
        assert errors[name] == pytest.approx(value)


def test_a_series_message_goes_to_the_log(spark, panel):
    folder = new_folder(spark, "ml")
    db = "ml_" + folder.rsplit("-", 1)[1]
    tables.create_database(spark, db, folder)
    tables.create(spark, f"{db}.prediction_log", forecast.ML["prediction_log"].ddl)
    forecast.write_log(forecast.fit_per_series(panel), f"{db}.prediction_log")
    log = spark.table(f"{db}.prediction_log")
    assert log.columns == ["model_name", "status", "rmse", "error_msg", "prediction_date"]
    assert log.filter("NOT status AND error_msg <> ''").count() == 1
    assert log.filter("prediction_date IS NULL").count() == 0


def test_forest_learns_saves_and_loads(spark, panel):
    rows_ = forecast.direct_targets(panel, 7)
    names = [*forecast.FEATURES, "step"]
    folder = new_folder(spark, "models")
    with pytest.raises(LookupError):
        forecast.load_latest(spark, folder, "m")
    weak = forecast.fit_forest(rows_, names, "target", trees=1, max_depth=1)
    strong = forecast.fit_forest(rows_, names, "target", trees=15)
    assert forecast.save(spark, weak, folder, "m") == 1 and forecast.save(spark, strong, folder, "m") == 2
    loaded = forecast.load_latest(spark, folder, "m")
    constants = {"onpromotion": 0, "oil_price": 50, "is_holiday": 0}
    got = forecast.predict(loaded, panel, 7, constants, as_of="2024-01-01")
    assert rows(got) == rows(forecast.predict(strong, panel, 7, constants, as_of="2024-01-01"))
    one = got.filter("series_id = '1_EGGS'").orderBy("ds").collect()
    assert len(one) == 7 and all(90 < r.prediction < 200 for r in one)
    assert one[0].features == '{"onpromotion":0,"oil_price":50,"is_holiday":0}'


def test_boosted_trees_backtest(panel):
    scores = {r.metric: r.value for r in forecast.backtest(panel.filter("store_nbr < 3"), 7, 1, fit=forecast.fit_gbt, rounds=3).collect()}
    assert scores["rmse"] < 60


def test_ridge_equals_brute_force(panel):
    """The stored weights minimise squared error plus the penalty, found independently."""
    import numpy as np

    names = ["onpromotion", "week", "lag8"]
    row = forecast.fit_per_series(panel.filter("store_nbr = 1"), names, strength=2.0).first()
    pdf = panel.filter("store_nbr = 1").select("ds", "y", *names).toPandas().sort_values("ds")
    x, y = pdf[names].astype(float).to_numpy()[:-7], pdf["y"].to_numpy()[:-7]
    x = np.where(np.isnan(x), np.nanmean(x, axis=0), x)
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    # the penalty as extra rows of an ordinary least-squares problem
    rows_ = np.vstack([np.column_stack([np.ones(len(z)), z]), np.column_stack([np.zeros(3), np.sqrt(2.0) * np.eye(3)])])
    weights = np.linalg.lstsq(rows_, np.concatenate([y, np.zeros(3)]), rcond=None)[0]
    assert row.coefficients[:4] == pytest.approx(weights.tolist())
