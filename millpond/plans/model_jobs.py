"""Model input, features, forecasts."""

from __future__ import annotations

from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millpond.operators import features, forecast, tables
from millpond.operators.forecast import FEATURES, HELD_OUT_FEATURES, HORIZON, KNOWN_AHEAD, LAGS
from millpond.plans.aggregates import ROLL_WINDOW, ROLLING
from millpond.plans.registry import query, sql
from millpond.session import materialise, new_folder
from millpond.sources import retail

FLAG = "MAX(CASE WHEN transferred THEN 0 ELSE 1 END)"
NATIONAL = f"SELECT date, {FLAG} AS flag FROM fx_holidays_events WHERE locale = 'National' GROUP BY date"
REGIONAL = f"SELECT date, locale_name AS place, {FLAG} AS flag FROM fx_holidays_events WHERE locale = 'Regional' GROUP BY 1, 2"
LOCAL = f"SELECT date, locale_name AS place, {FLAG} AS flag FROM fx_holidays_events WHERE locale = 'Local' GROUP BY 1, 2"
MODEL_INPUT = """SELECT t.id, t.date, t.store_nbr, t.family, t.sales, t.onpromotion, s.city, s.state, s.type, s.cluster,
o.dcoilwtico AS oil_price, COALESCE(n.flag, 0) AS national_holiday, COALESCE(r.flag, 0) AS regional_holiday,
COALESCE(l.flag, 0) AS local_holiday, GREATEST(COALESCE(n.flag, 0), COALESCE(r.flag, 0), COALESCE(l.flag, 0)) AS is_holiday
FROM fx_train t LEFT JOIN fx_stores s ON t.store_nbr = s.store_nbr LEFT JOIN fx_oil o ON t.date = o.date
LEFT JOIN n ON t.date = n.date LEFT JOIN r ON t.date = r.date AND s.state = r.place
LEFT JOIN l ON t.date = l.date AND s.city = l.place"""
INPUT_TABLES = ("train", "stores", "oil", "holidays_events")
INPUT_CTES = {"n": NATIONAL, "r": REGIONAL, "l": LOCAL}


def model_input(spark, d):
    return features.model_input(
        retail.train(spark, d), retail.stores(spark, d), retail.oil(spark, d), retail.holidays(spark, d)
    )


def feature_frame(spark, d):
    return forecast.lag_features(forecast.panel(model_input(spark, d), extras=forecast.EXOGENOUS))


@query(
    "m1_holiday_flags",
    sql(
        f"""SELECT 'national_holiday' AS level, date, NULL AS place, flag FROM ({NATIONAL}) a UNION ALL
        SELECT 'regional_holiday', date, place, flag FROM ({REGIONAL}) b UNION ALL
        SELECT 'local_holiday', date, place, flag FROM ({LOCAL}) c""",
        "holidays_events",
    ),
)
def m1(spark, d):
    parts = []
    for name, table in features.holiday_flags(retail.holidays(spark, d)).items():
        place = [c for c in table.columns if c in ("state", "city")]
        parts.append(
            table.select(
                F.lit(name).alias("level"),
                "date",
                (F.col(place[0]) if place else F.lit(None).cast("string")).alias("place"),
                F.col(name).alias("flag"),
            )
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("m2_model_input", sql(MODEL_INPUT, *INPUT_TABLES, **INPUT_CTES))
def m2(spark, d):
    return model_input(spark, d)


def _index_sql(column: str) -> str:
    return f"""SELECT CAST({column} AS VARCHAR) AS label, CAST(ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC,
    CAST({column} AS VARCHAR)) - 1 AS DOUBLE) AS idx FROM fx_stores GROUP BY 1"""


@query(
    "m3_frequency_index",
    sql(
        """SELECT s.store_nbr, s.type, s.cluster, a.idx AS type_numeric, b.idx AS cluster_numeric FROM fx_stores s
        JOIN a ON s.type = a.label JOIN b ON CAST(s.cluster AS VARCHAR) = b.label""",
        "stores",
        a=_index_sql("type"),
        b=_index_sql("cluster"),
    ),
)
def m3(spark, d):
    stores = retail.stores(spark, d).select("store_nbr", "type", "cluster")
    indexer = StringIndexer(inputCols=["type", "cluster"], outputCols=["type_numeric", "cluster_numeric"])
    return indexer.fit(stores).transform(stores)


def _sales_index_sql(column: str) -> str:
    return f"""SELECT CAST({column} AS VARCHAR) AS label, CAST(ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC,
    CAST({column} AS VARCHAR)) - 1 AS DOUBLE) AS idx FROM fx_train t JOIN fx_stores s ON t.store_nbr = s.store_nbr GROUP BY 1"""


SALES_INDEX = {"a": _sales_index_sql("type"), "b": _sales_index_sql("cluster")}


@query(
    "m3_sales_frequency_index",
    sql(
        """SELECT s.store_nbr, s.type, s.cluster, a.idx AS type_numeric, b.idx AS cluster_numeric FROM fx_stores s
        LEFT JOIN a ON s.type = a.label LEFT JOIN b ON CAST(s.cluster AS VARCHAR) = b.label""",
        "train",
        "stores",
        **SALES_INDEX,
    ),
)
def m3_sales(spark, d):
    """Labels ranked by the sales rows that carry them."""
    stores = retail.stores(spark, d)
    known = features.sales_labels(retail.train(spark, d), stores, ["type", "cluster"])
    return features.frequency_index(stores.select("store_nbr", "type", "cluster"), known)


@query(
    "m2_modeling_input",
    sql(
        """SELECT mi.* EXCLUDE (type, cluster), CONCAT_WS(',',
        CASE WHEN b.idx < (SELECT MAX(idx) FROM b) THEN 'cluster_' || b.label END,
        CASE WHEN a.idx < (SELECT MAX(idx) FROM a) THEN 'type_' || a.label END) AS indicators,
        CAST((SELECT COUNT(*) FROM a) + (SELECT COUNT(*) FROM b) - 2 AS INT) AS width
        FROM mi LEFT JOIN a ON mi.type = a.label LEFT JOIN b ON CAST(mi.cluster AS VARCHAR) = b.label""",
        *INPUT_TABLES,
        **INPUT_CTES,
        **SALES_INDEX,
        mi=MODEL_INPUT,
    ),
)
def m2_stored(spark, d):
    """The table ``modeling_input``, written twice (the second write replaces the first) and read back."""
    name = f"{_run_database(spark)}.modeling_input"
    dims = retail.stores(spark, d), retail.oil(spark, d), retail.holidays(spark, d)
    features.write_modeling_input(retail.train_v1(spark, d), *dims, name)
    features.write_modeling_input(retail.train(spark, d), *dims, name)
    stored = spark.table(name)
    hot = sorted(c for c in stored.columns if c.startswith(("type_", "cluster_")))
    names = F.concat_ws(",", *[F.when(F.col(c) == 1.0, c) for c in hot])
    rest = [c for c in stored.columns if c not in hot]
    return stored.select(*rest, names.alias("indicators"), F.lit(len(hot)).alias("width"))


TYPES = [c for c in "ABCDE"]
CLUSTERS = [str(i) for i in range(1, 18)]


@query(
    "m4_indicator_columns",
    sql(
        "SELECT store_nbr, city, state, "
        + ", ".join(f"CAST(type = '{t}' AS DOUBLE) AS type_{t}" for t in TYPES)
        + ", "
        + ", ".join(f"CAST(cluster = {c} AS DOUBLE) AS cluster_{c}" for c in CLUSTERS)
        + " FROM fx_stores",
        "stores",
    ),
)
def m4_all(spark, d):
    stores = retail.stores(spark, d)
    hot = features.one_hot(stores, features.labels(stores, ["type", "cluster"]), drop_last=False)
    wanted = [f"type_{t}" for t in TYPES] + [f"cluster_{c}" for c in CLUSTERS]
    missing = [F.lit(0.0).alias(c) for c in wanted if c not in hot.columns]
    return hot.select("*", *missing)


LONG = sql(
    """SELECT s.store_nbr, 'type_' || a.label AS name, CAST(s.type = a.label AS DOUBLE) AS value FROM fx_stores s, a
    WHERE a.idx < (SELECT MAX(idx) FROM a) UNION ALL
    SELECT s.store_nbr, 'cluster_' || b.label, CAST(CAST(s.cluster AS VARCHAR) = b.label AS DOUBLE) FROM fx_stores s, b
    WHERE b.idx < (SELECT MAX(idx) FROM b)""",
    "stores",
    a=_index_sql("type"),
    b=_index_sql("cluster"),
)


def _long(df):
    names = [c for c in df.columns if c.startswith(("type_", "cluster_"))]
    return df.unpivot(["store_nbr"], names, "name", "value")


@query("m4_one_hot_drop_last", LONG)
def m4(spark, d):
    stores = retail.stores(spark, d)
    return _long(features.one_hot(stores, features.labels(stores, ["type", "cluster"])))


@query("m4_one_hot_vectors", LONG)
def m4_vectors(spark, d):
    """The same columns by way of index, vector and array."""
    stores = retail.stores(spark, d).select("store_nbr", "type", "cluster")
    names = ["type", "cluster"]
    indexed = StringIndexer(inputCols=names, outputCols=[f"{n}_numeric" for n in names]).fit(stores)
    rows = indexed.transform(stores)
    encoder = OneHotEncoder(inputCols=[f"{n}_numeric" for n in names], outputCols=[f"{n}_vec" for n in names])
    rows = encoder.fit(rows).transform(rows)
    arrays = rows.select("store_nbr", *[vector_to_array(f"{n}_vec").alias(n) for n in names])
    columns = [
        F.col(n)[i].alias(f"{n}_{label}")
        for n, found in zip(names, indexed.labelsArray)
        for i, label in enumerate(found[:-1])
    ]
    return _long(arrays.select("store_nbr", *columns))


@query(
    "m5_training_window",
    sql(
        """SELECT id, date, store_nbr, family, sales FROM fx_train WHERE date >= CAST((SELECT MAX(date) FROM fx_train)
        - INTERVAL 12 MONTH AS DATE) AND date >= DATE '2001-01-01' AND store_nbr >= 4""",
        "train",
    ),
)
def m5(spark, d):
    rows = retail.train(spark, d).drop("onpromotion")
    return forecast.training_window(rows, 12, "2001-01-01", 4)


LAG_COLUMNS = ", ".join(f"LAG(sales, {k}) OVER v AS lag{k}" for k in LAGS)


@query(
    "m6_features",
    sql(
        f"""SELECT store_nbr, family, date AS ds, sales AS y, onpromotion, oil_price, is_holiday, {LAG_COLUMNS}, {ROLLING},
        CAST(WEEKOFYEAR(date) AS INT) AS week, CAST(MONTH(date) AS INT) AS month FROM mi {ROLL_WINDOW},
        v AS (PARTITION BY store_nbr, family ORDER BY date)""",
        *INPUT_TABLES,
        **INPUT_CTES,
        mi=MODEL_INPUT,
    ),
)
def m6(spark, d):
    mean = "rolling_mean_lag1_window4"
    return feature_frame(spark, d).withColumn(mean, F.round(mean, 4))


@query(
    "m7_mean_imputation",
    sql(
        """SELECT date, ROUND(COALESCE(dcoilwtico, (SELECT AVG(dcoilwtico) FROM fx_oil)), 6) AS filled FROM fx_oil""",
        "oil",
    ),
)
def m7(spark, d):
    oil = retail.oil(spark, d)
    filled = Imputer(inputCols=["dcoilwtico"], outputCols=["filled"], strategy="mean").fit(oil).transform(oil)
    return filled.select("date", F.round("filled", 6).alias("filled"))


SERIES_ENDS = "SELECT *, MAX(date) OVER (PARTITION BY store_nbr, family) AS last_ds FROM fx_train"
#: The last week of every series; what a second engine can say of a forecast is stated beside it.
HELD_OUT = "SELECT store_nbr, family, date AS ds, sales AS y, {facts} FROM ends WHERE DATEDIFF('day', date, last_ds) < 7"
#: Two rows before the cutoff train a series' model.
TRAINED = "COUNT(*) FILTER (WHERE date <= last_ds - 7) >= 2"
TOO_SHORT = "CONCAT(COUNT(*) FILTER (WHERE date <= last_ds - 7), ' rows before the cutoff, 2 needed')"


def finite(name):
    return F.coalesce(F.col(name).between(-1e300, 1e300), F.lit(False))


@query(
    "m8_random_forest",
    sql(HELD_OUT.format(facts="TRUE AS predicted, TRUE AS within"), "train", ends=SERIES_ENDS),
)
def m8(spark, d):
    """Forest on the rows before the last week of every series, scored on that week.

    A forest averages what it was trained on, so no prediction lies outside of that.
    """
    frame = materialise(feature_frame(spark, d), "features", swept=True)
    rows = forecast.training_rows(frame)
    held = forecast.score(forecast.fit_forest(rows, HELD_OUT_FEATURES), forecast.backtest_splits(frame), HELD_OUT_FEATURES)
    least, most = rows.select(F.min("y")).scalar(), rows.select(F.max("y")).scalar()
    within = F.col("prediction").between(least - 1e-6, most + 1e-6)
    return held.select("store_nbr", "family", "ds", "y", finite("prediction").alias("predicted"), within.alias("within"))


@query("m9_gradient_boosting", sql(HELD_OUT.format(facts="TRUE AS predicted"), "train", ends=SERIES_ENDS))
def m9(spark, d):
    frame = materialise(feature_frame(spark, d), "features", swept=True)
    model = forecast.fit_gbt(forecast.training_rows(frame), HELD_OUT_FEATURES)
    held = forecast.score(model, forecast.backtest_splits(frame), HELD_OUT_FEATURES)
    return held.select("store_nbr", "family", "ds", "y", finite("prediction").alias("predicted"))


@query(
    "m10_splits",
    sql(
        """SELECT store_nbr, family, ds, y, last_ds - CAST(7 * (DATEDIFF('day', ds, last_ds) // 7 + 1) AS INT) AS cutoff
        FROM (SELECT store_nbr, family, date AS ds, sales AS y, MAX(date) OVER (PARTITION BY store_nbr, family) AS last_ds
        FROM fx_train) q WHERE DATEDIFF('day', ds, last_ds) < 28""",
        "train",
    ),
)
def m10_splits(spark, d):
    return forecast.backtest_splits(forecast.panel(retail.train(spark, d)), HORIZON, 4)


@query(
    "m10_training_rows",
    sql(
        """SELECT store_nbr, family, ds, y FROM (SELECT store_nbr, family, date AS ds, sales AS y,
        MAX(date) OVER (PARTITION BY store_nbr, family) AS last_ds FROM fx_train) q WHERE ds <= last_ds - 28""",
        "train",
    ),
)
def m10_training(spark, d):
    return forecast.training_rows(forecast.panel(retail.train(spark, d)), HORIZON, 4)


@query(
    "m10_backtest",
    sql("SELECT metric, (SELECT COUNT(*) FROM fx_train) > 0 AS measured FROM (VALUES ('mape'), ('rmse')) v(metric)", "train"),
)
def m10(spark, d):
    """The mean error over all series; tests hold its figures against hand-made ones."""
    found = forecast.backtest(feature_frame(spark, d), HORIZON, 1)
    return found.select("metric", (finite("value") & (F.col("value") > 0)).alias("measured"))


def series_log(spark, d):
    return forecast.fit_per_series(feature_frame(spark, d))


def _logged_facts(log, message):
    """What both engines can say of a training log: names, outcomes, messages, and that a trained series has an error."""
    measured = F.when(F.col("status"), finite("rmse") & (F.col("rmse") >= 0)).otherwise(F.col("rmse") == 0)
    return log.select("model_name", "status", message, measured.alias("measured"))


LOG_FACTS = f"""SELECT CONCAT(store_nbr, '_', family, '_model') AS model_name, {TRAINED} AS status,
CASE WHEN {TRAINED} THEN '' ELSE {TOO_SHORT} END AS {{message}}, TRUE AS measured FROM ends GROUP BY store_nbr, family"""


@query("m11_model_per_series", sql(LOG_FACTS.format(message="message"), "train", ends=SERIES_ENDS))
def m11(spark, d):
    return _logged_facts(series_log(spark, d), "message")


@query(
    "m11_series_status",
    sql(
        """SELECT CONCAT(store_nbr, '_', family, '_model') AS model_name, COUNT(*) FILTER (WHERE date <= last_ds - 7) >= 2 AS status
        FROM (SELECT *, MAX(date) OVER (PARTITION BY store_nbr, family) AS last_ds FROM fx_train) q GROUP BY 1""",
        "train",
    ),
)
def m11_status(spark, d):
    return series_log(spark, d).select("model_name", "status")


@query(
    "m11_score_per_series",
    sql(
        HELD_OUT.format(facts="trained AS predicted"),
        "train",
        e=SERIES_ENDS,
        ends="SELECT *, COUNT(*) FILTER (WHERE date <= last_ds - 7) OVER (PARTITION BY store_nbr, family) >= 2 AS trained FROM e",
    ),
)
def m11_score(spark, d):
    """The stored coefficients applied to the held-out week as a SQL expression."""
    frame = materialise(feature_frame(spark, d), "features")
    scored = forecast.score_per_series(forecast.fit_per_series(frame), forecast.backtest_splits(frame))
    return scored.select("store_nbr", "family", "ds", "y", finite("prediction").alias("predicted"))


@query(
    "m12_direct_targets",
    sql(
        """SELECT store_nbr, family, step, COUNT(*) AS n, CAST(SUM(CAST(target AS DECIMAL(14,2))) AS DOUBLE) AS total FROM (
        SELECT a.store_nbr, a.family, CAST(b.rn - a.rn AS INT) AS step, b.sales AS target FROM r a JOIN r b
        ON a.store_nbr = b.store_nbr AND a.family = b.family AND b.rn - a.rn BETWEEN 1 AND 21) x GROUP BY 1, 2, 3""",
        "train",
        r="SELECT *, ROW_NUMBER() OVER (PARTITION BY store_nbr, family ORDER BY date) AS rn FROM fx_train",
    ),
)
def m12(spark, d):
    rows = forecast.direct_targets(forecast.panel(retail.train(spark, d)), 21)
    return rows.groupBy("store_nbr", "family", "step").agg(
        F.count("*").alias("n"), F.sum(F.col("target").cast("decimal(14,2)")).cast("double").alias("total")
    )


CONSTANTS = {"onpromotion": 0, "oil_price": 50, "is_holiday": 0}


@query(
    "m13_future_frame",
    sql(
        """SELECT store_nbr, family, CAST(last_ds + CAST(step AS INT) AS DATE) AS ds, CAST(step AS INT) AS step, 0 AS onpromotion,
        50 AS oil_price, 0 AS is_holiday FROM (SELECT store_nbr, family, MAX(date) AS last_ds FROM fx_train GROUP BY 1, 2) l,
        RANGE(1, 8) t(step)""",
        "train",
    ),
)
def m13(spark, d):
    return forecast.future_frame(forecast.panel(retail.train(spark, d)), HORIZON, CONSTANTS)


def _direct_model(frame, trees=100):
    rows = forecast.direct_targets(frame, HORIZON, known=KNOWN_AHEAD)
    return forecast.fit_forest(rows, [*FEATURES, "step"], label="target", trees=trees)


def _run_database(spark):
    folder = new_folder(spark, "ml")
    db = "ml_" + folder.rsplit("-", 1)[1]
    tables.create_database(spark, db, folder)
    return db


@query(
    "m14_batch_scoring",
    sql(
        """SELECT CAST(last_ds + CAST(step AS INT) AS DATE) AS ds, CONCAT(store_nbr, '_', family) AS series_id,
        '{"onpromotion":0,"oil_price":50,"is_holiday":0}' AS features, TRUE AS predicted
        FROM (SELECT store_nbr, family, MAX(date) AS last_ds FROM fx_train GROUP BY 1, 2) l, RANGE(1, 8) t(step)""",
        "train",
    ),
)
def m14(spark, d):
    """Direct forecasts for the next week of every series, appended to prediction_results."""
    frame = materialise(feature_frame(spark, d), "features", swept=True)
    results = forecast.predict(_direct_model(frame), frame, HORIZON, CONSTANTS)
    name = f"{_run_database(spark)}.prediction_results"
    tables.create(spark, name, forecast.ML["prediction_results"].ddl)
    forecast.write_results(results, name)
    return spark.table(name).select("ds", "series_id", "features", finite("prediction").alias("predicted"))


@query("m15_training_log", sql(LOG_FACTS.format(message="error_msg"), "train", ends=SERIES_ENDS))
def m15(spark, d):
    name = f"{_run_database(spark)}.prediction_log"
    tables.create(spark, name, forecast.ML["prediction_log"].ddl)
    forecast.write_log(forecast.fit_per_series(feature_frame(spark, d)), name)
    return _logged_facts(spark.table(name), "error_msg")


@query(
    "m16_saved_model",
    sql(f"SELECT store_nbr, family, ds, predicted FROM ({HELD_OUT.format(facts='TRUE AS predicted')}) h", "train", ends=SERIES_ENDS),
)
def m16(spark, d):
    """Two versions are saved; the newest one is loaded and scores the held-out week."""
    frame = materialise(feature_frame(spark, d), "features")
    train, folder = forecast.training_rows(frame), new_folder(spark, "models")
    for trees in (5, 20):
        forecast.save(spark, forecast.fit_forest(train, HELD_OUT_FEATURES, trees=trees), folder, "all_series_model")
    model = forecast.load_latest(spark, folder, "all_series_model")
    held = forecast.score(model, forecast.backtest_splits(frame), HELD_OUT_FEATURES)
    return held.select("store_nbr", "family", "ds", finite("prediction").alias("predicted"))
