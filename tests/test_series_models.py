"""Direct models per series, their store and their forecasts."""

from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from millpond.operators import forecast, series_models
from millpond.session import new_folder

START = date(2017, 1, 1)
CONSTANTS = {"onpromotion": 0, "oil_price": 50.0, "is_holiday": 0}


@pytest.fixture(scope="module")
def panel(spark):
    """Two long series, one too short for 21 steps, one with gaps and a null."""
    random_ = np.random.default_rng(3)
    data = []
    for store, days in ((1, 90), (2, 70), (3, 20), (4, 60)):
        for i in range(days):
            gap = 2 if store == 4 else 1
            y = None if (store, i) == (4, 5) else float(np.round(100 * store + 10 * (i % 7) + random_.normal(), 2))
            data.append((store, "EGGS", START + timedelta(days=i * gap), y, int(random_.integers(2)), float(random_.normal()), i % 3 == 0))
    rows = [(*r[:6], int(r[6])) for r in data]
    frame = spark.createDataFrame(rows, "store_nbr INT, family STRING, ds DATE, y DOUBLE, onpromotion INT, oil_price DOUBLE, is_holiday INT")
    return frame.cache()


@pytest.fixture(scope="module")
def models(panel):
    frame = series_models.direct_frame(series_models.by_series(panel))
    return {r.store_nbr: r for r in series_models.fit_direct(frame).collect()}


def plain_features(rows, t):
    """Features of position t of a sorted series, by hand."""
    y = [r.y for r in rows]
    lag = [y[t - k] if t >= k else None for k in forecast.LAGS]
    last = y[t - 4 : t] if t >= 4 else []
    roll = [np.mean(last), min(last), max(last)] if len(last) == 4 and None not in last else [None] * 3
    r = rows[t]
    return [*lag, *roll, r.ds.isocalendar()[1], r.ds.month, r.onpromotion, r.oil_price, r.is_holiday]


def plain_ridge(x, y):
    x = np.array(x, float)
    means = np.nan_to_num(np.nanmean(x, 0))
    x = np.where(np.isnan(x), means, x)
    scales = x.std(0)
    scales[scales == 0] = 1
    z, p = (x - means) / scales, x.shape[1]
    # the penalty as extra rows of an ordinary least-squares problem
    design = np.vstack([np.column_stack([np.ones(len(z)), z]), np.column_stack([np.zeros(p), np.eye(p)])])
    w = np.linalg.lstsq(design, np.concatenate([y, np.zeros(p)]), rcond=None)[0]
    return lambda row: w[0] + ((np.where(np.isnan(row), means, row) - means) / scales) @ w[1:]


@pytest.mark.parametrize("store", [1, 2, 4])
def test_every_step_equals_a_plain_ridge(panel, models, store):
    rows = panel.filter(F.col("store_nbr") == store).orderBy("ds").collect()
    n, got = len(rows), models[store]
    x = [plain_features(rows, t) for t in range(n)]
    whole = [t for t in range(n - 20) if None not in [r.y for r in rows[t : t + 21]]]
    assert got.status and got.n_rows == len(whole) and got.trained_to == rows[-1].ds and len(got.weights) == 21
    probe = np.array(x[n - 1], float)
    for step in (1, 2, 13, 21):
        expected = plain_ridge([x[t] for t in whole], np.array([rows[t + step - 1].y for t in whole]))(probe)
        inputs = (np.where(np.isnan(probe), got.means, probe) - got.means) / np.array(got.scales)
        assert got.intercepts[step - 1] + inputs @ got.weights[step - 1] == pytest.approx(expected, rel=1e-9)


def test_the_error_is_that_of_held_out_days_alone(panel, models):
    rows = panel.filter("store_nbr = 1").orderBy("ds").collect()
    cut, x = len(rows) - 7, [plain_features(rows, t) for t in range(len(rows))]
    inside = range(cut - 6)
    errors = [
        plain_ridge([x[t] for t in inside], np.array([rows[t + k].y for t in inside]))(np.array(x[cut], float)) - rows[cut + k].y
        for k in range(7)
    ]
    assert models[1].rmse == pytest.approx(float(np.sqrt(np.mean(np.square(errors)))), rel=1e-9)


def test_a_series_that_fails_keeps_its_message(models):
    failed = models[3]
    assert not failed.status and failed.rmse is None and failed.weights is None and "complete rows" in failed.message


def test_the_first_day_ahead_sees_what_a_next_row_would(spark, panel):
    """Its features are those of a row appended for that day."""
    ahead = series_models.first_day_ahead(panel, CONSTANTS)
    added = ahead.select("store_nbr", "family", "ds", F.lit(None).cast("double").alias("y"), *CONSTANTS)
    full = forecast.lag_features(panel.unionByName(added)).join(ahead.select("store_nbr", "ds"), ["store_nbr", "ds"])
    columns = ["store_nbr", "ds", *forecast.FEATURES]
    assert sorted(map(tuple, ahead.select(columns).collect())) == sorted(map(tuple, full.select(columns).collect()))


def test_store_keeps_the_newest_successful_model(spark, panel):
    folder = new_folder(spark, "series-store")
    with pytest.raises(LookupError):
        series_models.latest(spark, folder)
    fit = lambda rows: series_models.fit_direct(series_models.direct_frame(rows, 5))
    assert series_models.publish(fit(panel), folder) == 1
    assert series_models.publish(fit(panel.filter("store_nbr = 1")), folder) == 2
    assert series_models.publish(fit(panel.filter("store_nbr = 2 AND ds < '2017-01-10'")), folder) == 3  # fails
    died = panel.select("store_nbr").limit(1)
    died.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{folder}/version=4")
    found = series_models.latest(spark, folder)
    assert {r.store_nbr: r.version for r in found.collect()} == {1: 2, 2: 1, 3: 1, 4: 1}
    assert series_models.publish(fit(panel.filter("store_nbr = 4")), folder) == 4
    assert {r.store_nbr: r.version for r in series_models.latest(spark, folder).collect()}[4] == 4


def test_forecasts_apply_each_series_own_model(spark, panel, models):
    folder = new_folder(spark, "series-store")
    frame = series_models.direct_frame(panel)
    series_models.publish(series_models.fit_direct(frame), folder)
    ahead = series_models.first_day_ahead(panel, CONSTANTS)
    got = series_models.forecast_series(series_models.latest(spark, folder), ahead, as_of="2024-01-01")
    rows = {(r.series_id, r.step): r for r in got.collect()}
    assert len(rows) == 4 * 21
    inputs = {r.store_nbr: np.array([r[c] for c in forecast.FEATURES], float) for r in ahead.collect()}
    for (series, step), r in rows.items():
        store = int(series.split("_")[0])
        if store == 3:
            assert r.prediction is None and r.version is None
            continue
        m, x = models[store], inputs[store]
        scaled = (np.where(np.isnan(x), m.means, x) - m.means) / np.array(m.scales)
        assert r.prediction == pytest.approx(m.intercepts[step - 1] + scaled @ m.weights[step - 1])
        assert r.ds == m.trained_to + timedelta(days=step) and r.version == 1
    assert rows["1_EGGS", 1].features == '{"onpromotion":0,"oil_price":50.0,"is_holiday":0}'


def test_windows_and_models_share_one_shuffle_of_the_panel(panel):
    plan = series_models.fit_direct(series_models.direct_frame(series_models.by_series(panel)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") - plan.count("ReusedExchange") == 1 and "FlatMapGroupsInArrow" in plan
