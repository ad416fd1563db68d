"""Direct models per series: training, the versioned store, batch scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from millpond.operators import forecast, series_models, tables
from millpond.operators.series_models import STEPS
from millpond.plans.model_jobs import CONSTANTS, model_input
from millpond.plans.registry import query, sql
from millpond.session import materialise, new_folder

#: What a series needs: rows before its last week for a backtest of 7 steps, and rows that have all 21 targets.
SERIES_FACTS = """SELECT store_nbr, family, COUNT(*) AS n, MAX(last_ds) AS last_ds,
COUNT(*) FILTER (WHERE date <= last_ds - 7) - 6 >= 2 AND COUNT(*) - 20 >= 2 AS status
FROM (SELECT *, MAX(date) OVER (PARTITION BY store_nbr, family) AS last_ds FROM {rows}) q GROUP BY 1, 2"""
#: The store after three trainings: all series a month ago, even stores now, too few rows of every fifth store.
NEWEST = """SELECT store_nbr, family, CASE WHEN store_nbr % 2 = 0 AND status THEN 2 ELSE 1 END AS version FROM now
WHERE store_nbr % 2 = 0 AND status UNION
SELECT store_nbr, family, 1 FROM month_ago a WHERE status AND NOT EXISTS (
SELECT 1 FROM now n WHERE n.store_nbr = a.store_nbr AND n.family = a.family AND n.store_nbr % 2 = 0 AND n.status)"""
STORE_CTES = {
    "earlier": "SELECT * FROM fx_train WHERE date <= (SELECT MAX(date) FROM fx_train) - 30",
    "now": SERIES_FACTS.format(rows="fx_train"),
    "month_ago": SERIES_FACTS.format(rows="earlier"),
    "newest": NEWEST,
}


def panel(spark, d):
    rows = forecast.panel(model_input(spark, d), extras=forecast.EXOGENOUS)
    return materialise(series_models.by_series(rows), "panel")


def trained(rows):
    return series_models.fit_direct(series_models.direct_frame(series_models.by_series(rows)))


@query(
    "m12_direct_models",
    sql(
        """SELECT CONCAT(store_nbr, '_', family, '_model') AS model_name, CAST(step AS INT) AS step,
        CAST(last_ds + CAST(step AS INT) AS DATE) AS ds, status, CAST(CASE WHEN status THEN n - 20 END AS INT) AS n_rows,
        status AS has_weights FROM now, RANGE(1, 22) t(step)""",
        "train",
        now=STORE_CTES["now"],
    ),
)
def m12_models(spark, d):
    """One weight vector per series and step, fitted on all rows after the backtest."""
    steps = F.explode(F.sequence(F.lit(1), F.lit(STEPS))).alias("step")
    return trained(panel(spark, d)).select(
        "model_name",
        steps,
        "status",
        "n_rows",
        "trained_to",
        "weights",
    ).select(
        "model_name",
        "step",
        F.date_add("trained_to", F.col("step")).alias("ds"),
        "status",
        "n_rows",
        (F.size(F.coalesce(F.get("weights", F.col("step") - 1), F.array())) == len(forecast.FEATURES)).alias("has_weights"),
    )


def stored(spark, rows):
    """A store of three versions."""
    folder = new_folder(spark, "series-models")
    newest = rows.select(F.max("ds")).scalar()
    for part in (
        rows.filter(F.col("ds") <= F.date_sub(newest, 30)),
        rows.filter("store_nbr % 2 = 0"),
        rows.filter((F.col("store_nbr") % 5 == 0) & (F.col("ds") > F.date_sub(newest, 15))),
    ):
        series_models.publish(trained(part), folder)
    return folder


@query(
    "m16_series_store",
    sql(
        """SELECT CONCAT(v.store_nbr, '_', v.family, '_model') AS model_name, v.version,
        CASE WHEN v.version = 2 THEN n.last_ds ELSE a.last_ds END AS trained_to,
        CAST(CASE WHEN v.version = 2 THEN n.n ELSE a.n END - 20 AS INT) AS n_rows, 21 AS steps
        FROM newest v JOIN now n ON v.store_nbr = n.store_nbr AND v.family = n.family
        LEFT JOIN month_ago a ON v.store_nbr = a.store_nbr AND v.family = a.family""",
        "train",
        **STORE_CTES,
    ),
)
def m16_store(spark, d):
    """The newest successful model of every series, over versions that hold different series."""
    models = series_models.latest(spark, stored(spark, panel(spark, d)))
    return models.select("model_name", "version", "trained_to", "n_rows", F.size("weights").alias("steps"))


@query(
    "m14_series_forecast",
    sql(
        """SELECT CAST(n.last_ds + CAST(step AS INT) AS DATE) AS ds, CONCAT(n.store_nbr, '_', n.family) AS series_id,
        '{"onpromotion":0,"oil_price":50,"is_holiday":0}' AS features, v.version IS NOT NULL AS predicted
        FROM now n LEFT JOIN newest v ON n.store_nbr = v.store_nbr AND n.family = v.family, RANGE(1, 22) t(step)""",
        "train",
        **STORE_CTES,
    ),
)
def m14_series(spark, d):
    """The next 21 days of every series by its own newest model, appended to prediction_results."""
    rows = panel(spark, d)
    models = series_models.latest(spark, stored(spark, rows))
    results = series_models.forecast_series(models, series_models.first_day_ahead(rows, CONSTANTS))
    folder = new_folder(spark, "ml")
    db = "ml_" + folder.rsplit("-", 1)[1]
    tables.create_database(spark, db, folder)
    name = f"{db}.prediction_results"
    tables.create(spark, name, forecast.ML["prediction_results"].ddl)
    forecast.write_results(results, name)
    return spark.table(name).select("ds", "series_id", "features", F.col("prediction").isNotNull().alias("predicted"))
