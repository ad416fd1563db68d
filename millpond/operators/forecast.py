"""Sales forecasting: training frames, models, backtests and scoring."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from millpond.functions.series import lags, rolling
from millpond.operators import trees as trees_of_bins
from millpond.operators.tables import append, conform
from millpond.schemas import ML
from millpond.session import materialise

SERIES = ("store_nbr", "family")

# The lags, window and horizon forecasts are built on.
LAGS = (8, 9, 10, 11, 12)
ROLL = 4
HORIZON = 7
EXOGENOUS = ("onpromotion", "oil_price", "is_holiday")
FEATURES = (
    *(f"lag{k}" for k in LAGS),
    *(f"rolling_{f}_lag1_window{ROLL}" for f in ("mean", "min", "max")),
    "week",
    "month",
    *EXOGENOUS,
)

#: What a day's features may hold when it is forecast from a whole horizon before: no value of the horizon itself.
HELD_OUT_FEATURES = (*(f"lag{k}" for k in LAGS if k >= HORIZON), "week", "month", *EXOGENOUS)
#: Columns that are known for a day to come; a direct model reads them from the target's day.
KNOWN_AHEAD = ("week", "month", *EXOGENOUS)


def training_window(
    df: DataFrame, months: int = 12, since: str | None = None, min_store: int | None = None
) -> DataFrame:
    """Rows of the last months before the newest date, from ``since`` on.

    The newest date is a scalar subquery: one aggregate, no window over
    everything and no join.
    """
    newest = df.select(F.max("date")).scalar()
    rows = df.filter(F.col("date") >= F.add_months(newest, -months))
    if since is not None:
        rows = rows.filter(F.col("date") >= F.lit(since).cast("date"))
    if min_store is not None:
        rows = rows.filter(F.col("store_nbr") >= min_store)
    return rows


def panel(df: DataFrame, keys: Sequence[str] = SERIES, extras: Sequence[str] = ()) -> DataFrame:
    """One row per series and day, which bounds a series by the calendar.

    Duplicate rows fold in a map-side combine before any per-series step, so a
    series that holds a large share of the input still has one row per day.
    """
    return df.groupBy(*keys, F.col("date").cast("date").alias("ds")).agg(
        F.sum(F.col("sales").cast("decimal(14,2)")).cast("double").alias("y"),
        *[F.max(c).alias(c) for c in extras],
    )


def lag_features(frame: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """Lags, rolling statistics and calendar parts for a panel."""
    return frame.select(
        "*",
        *lags("y", LAGS, keys, "ds"),
        *rolling("y", ROLL, keys, "ds"),
        F.weekofyear("ds").alias("week"),
        F.month("ds").alias("month"),
    )


def direct_targets(
    frame: DataFrame, horizon: int, keys: Sequence[str] = SERIES, known: Sequence[str] = ()
) -> DataFrame:
    """One row per (row, step) with the value ``step`` rows ahead as ``target``.

    The ``known`` columns are those of the row ahead, as they are when a model scores
    days to come. The rows ahead are read in one window pass and unfolded from an
    array; no row meets another in a join.
    """
    series = Window.partitionBy(*keys).orderBy("ds")
    seen = F.struct(F.col("y").alias("target"), *known)
    ahead = F.array(*[F.lead(seen, k).over(series) for k in range(1, horizon + 1)])
    unfolded = frame.withColumn("_ahead", ahead).select("*", F.posexplode("_ahead").alias("_at", "_then"))
    columns = [F.col(f"_then.{c}").alias(c) if c in known else F.col(c) for c in frame.columns]
    return unfolded.filter(F.col("_then.target").isNotNull()).select(
        *columns, (F.col("_at") + 1).alias("step"), F.col("_then.target").alias("target")
    )


def future_frame(
    frame: DataFrame, horizon: int, constants: Mapping[str, float], keys: Sequence[str] = SERIES
) -> DataFrame:
    """The next ``horizon`` days of every series with constant future features."""
    last = frame.groupBy(*keys).agg(F.max("ds").alias("last_ds"))
    steps = last.select(*keys, "last_ds", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
    return steps.select(
        *keys,
        F.date_add("last_ds", F.col("step")).alias("ds"),
        "step",
        *[F.lit(v).alias(c) for c, v in constants.items()],
    )


# -- backtest ---------------------------------------------------------------
def _series_end(keys: Sequence[str]) -> Column:
    """The last day of a row's series; shares the partitioning of the lag windows."""
    return F.max("ds").over(Window.partitionBy(*keys))


def backtest_splits(
    frame: DataFrame, horizon: int = HORIZON, windows: int = 1, keys: Sequence[str] = SERIES
) -> DataFrame:
    """Held-out rows with their cutoff: cutoff k lies k·horizon days before a series' end.

    Each row belongs to at most one window, found by arithmetic on its distance
    to the end of the series.
    """
    back = F.floor(F.datediff("_end", "ds") / F.lit(horizon)).cast("int")
    ended = frame.withColumn("_end", _series_end(keys))
    held = ended.withColumn("_k", back + 1).filter(F.col("_k") <= windows)
    return held.withColumn("cutoff", F.date_sub("_end", F.col("_k") * horizon)).drop("_end", "_k")


def training_rows(
    frame: DataFrame, horizon: int = HORIZON, windows: int = 1, keys: Sequence[str] = SERIES
) -> DataFrame:
    """Rows before the earliest cutoff; one fit serves every window."""
    first_cutoff = F.date_sub("_end", F.lit(horizon * windows))
    return frame.withColumn("_end", _series_end(keys)).filter(F.col("ds") <= first_cutoff).drop("_end")


def metrics(scored: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """RMSE and MAPE per series and cutoff."""
    error = F.col("y") - F.col("prediction")
    return scored.groupBy(*keys, "cutoff").agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.when(F.col("y") != 0, F.abs(error / F.col("y")))).alias("mape"),
    )


def mean_metrics(per_cutoff: DataFrame) -> DataFrame:
    """One row per metric: its mean over all series and cutoffs."""
    means = per_cutoff.agg(F.avg("rmse").alias("rmse"), F.avg("mape").alias("mape"))
    rows = [F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in ("mape", "rmse")]
    return means.select(F.explode(F.array(*rows)).alias("m")).select("m.*")


# -- one model for all series -------------------------------------------------
def _fit(frame: DataFrame, regressor, features: Sequence[str], label: str) -> PipelineModel:
    """Mean imputation and a regressor that weighs rows; equal rows are one with their number as weight."""
    inputs = [F.col(c).cast("double").alias(c) for c in features]
    rows = frame.filter(F.col(label).isNotNull()).select(*inputs, F.col(label).cast("double").alias(label))
    rows = materialise(rows, "training-rows", swept=True)  # the imputer scans it first
    filled = [f"{c}_filled" for c in features]
    imputer = Imputer(inputCols=list(features), outputCols=filled, strategy="mean").fit(rows)
    folded = imputer.transform(rows).groupBy(*filled, label).agg(F.count(F.lit(1)).cast("double").alias("_weight"))
    folded = materialise(folded, "folded-rows", swept=True)  # split finder and every tree level scan it
    assembler = VectorAssembler(inputCols=filled, outputCol="features_vec")
    regressor = regressor.setFeaturesCol("features_vec").setLabelCol(label).setPredictionCol("prediction")
    return PipelineModel([imputer, assembler, regressor.setWeightCol("_weight").fit(assembler.transform(folded))])


def fit_forest(
    frame: DataFrame,
    features: Sequence[str] = FEATURES,
    label: str = "y",
    trees: int = 100,
    seed: int = 0,
    max_depth: int = 5,
) -> PipelineModel:
    """Mean imputation and a random forest, trained across the cluster."""
    return trees_of_bins.fit_forest(frame, features, label, trees, seed, max_depth)


def fit_gbt(
    frame: DataFrame,
    features: Sequence[str] = FEATURES,
    label: str = "y",
    rounds: int = 100,
    seed: int = 0,
    max_depth: int = 5,
) -> PipelineModel:
    """The gradient-boosted alternative."""
    return _fit(frame, GBTRegressor(maxIter=rounds, seed=seed, maxDepth=max_depth), features, label)


def score(model: PipelineModel, frame: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    typed = frame.withColumns({c: F.col(c).cast("double") for c in features})
    return model.transform(typed).drop("features_vec", *[f"{c}_filled" for c in features])


def backtest(
    frame: DataFrame,
    horizon: int = HORIZON,
    windows: int = 1,
    trees: int = 100,
    features: Sequence[str] = HELD_OUT_FEATURES,
    fit=fit_forest,
    **options,
) -> DataFrame:
    """Fit once on the rows before every cutoff, score the held-out windows.

    The features must reach back at least ``horizon`` rows: a nearer lag would show a
    held-out day the days before it in its own window.
    """
    if fit is fit_forest:
        options.setdefault("trees", trees)
    frame = materialise(frame, "panel", swept=True)
    model = fit(training_rows(frame, horizon, windows), features, **options)
    scored = score(model, backtest_splits(frame, horizon, windows), features)
    return mean_metrics(metrics(scored))


def last_rows(frame: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """The newest row of every series."""
    rest = [c for c in frame.columns if c not in keys]
    return frame.groupBy(*keys).agg(F.max_by(F.struct(*rest), "ds").alias("_r")).select(*keys, "_r.*")


def predict(
    model: PipelineModel,
    frame: DataFrame,
    horizon: int,
    constants: Mapping[str, float],
    features: Sequence[str] = FEATURES,
    as_of: str | None = None,
) -> DataFrame:
    """``prediction_results`` rows for the next days of every series.

    The model was fitted on ``direct_targets``: the newest features of a series
    plus the step number, and ``KNOWN_AHEAD`` of the day to come.
    """
    step_frame = future_frame(frame, horizon, constants).withColumns(
        {"week": F.weekofyear("ds"), "month": F.month("ds")}
    )
    newest = last_rows(frame).drop("ds", "week", "month", *constants)
    scored = score(model, step_frame.join(newest, list(SERIES)), [*features, "step"])
    bag = F.to_json(F.struct(*[F.lit(v).alias(c) for c, v in constants.items()]))
    when = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return scored.select(
        "ds",
        F.concat_ws("_", *SERIES).alias("series_id"),
        "prediction",
        bag.alias("features"),
        when.alias("prediction_date"),
    )


# -- one model per series -----------------------------------------------------
LOG_DDL = "model_name string, status boolean, rmse double, message string, coefficients array<double>"


def _solve_series(x: np.ndarray, y: np.ndarray, train: np.ndarray, strength: float) -> tuple[float, list[float]]:
    """Ridge regression on imputed, scaled columns; the error on the rows held out."""
    if train.sum() < 2:
        raise ValueError(f"{int(train.sum())} rows before the cutoff, 2 needed")
    known = ~np.isnan(x)
    seen = known & train[:, None]
    means = np.where(seen, x, 0.0).sum(axis=0) / np.maximum(seen.sum(axis=0), 1)
    x = np.where(known, x, means)
    scales = x[train].std(axis=0)
    scales[scales == 0] = 1.0
    design = np.column_stack([np.ones(len(x)), (x - means) / scales])
    penalty = strength * np.eye(design.shape[1])
    penalty[0, 0] = 0.0
    fitted = design[train]
    weights = np.linalg.solve(fitted.T @ fitted + penalty, fitted.T @ y[train])
    error = y[~train] - design[~train] @ weights
    return float(np.sqrt(np.nanmean(error**2))), [*weights, *means, *scales]


def fit_per_series(
    frame: DataFrame,
    features: Sequence[str] = HELD_OUT_FEATURES,
    horizon: int = HORIZON,
    strength: float = 1.0,
    keys: Sequence[str] = SERIES,
) -> DataFrame:
    """One small linear model per series; a series that fails is a row with its message.

    The features come from Spark windows; the grouped task only solves one
    least-squares system per series. Since a panel has one row per day, a group
    is never longer than the calendar. ``coefficients`` holds the weights, the
    imputation means and the scales, so scoring needs no Python.
    """
    names = list(features)

    def train(key: tuple, rows: pa.Table) -> pa.Table:
        name = "_".join(str(k.as_py()) for k in key) + "_model"
        try:
            day = rows["day"].to_numpy()
            y = rows["y"].to_numpy()
            x = np.column_stack([rows[c].to_numpy() for c in names])
            before = (day <= day.max() - horizon) & ~np.isnan(y)
            rmse, coefficients = _solve_series(x, y, before, strength)
            row = {"status": True, "rmse": rmse, "message": "", "coefficients": coefficients}
        except Exception as e:  # noqa: BLE001 - one series must not stop the others
            row = {"status": False, "rmse": 0.0, "message": str(e), "coefficients": []}
        return pa.Table.from_pylist([{"model_name": name, **row}], schema=to_arrow_schema(log_schema))

    log_schema = StructType.fromDDL(LOG_DDL)
    slim = frame.select(
        *keys,
        F.unix_date("ds").alias("day"),
        F.col("y").cast("double"),
        *[F.col(c).cast("double") for c in names],
    )
    # a fixed partition number: few bytes but much work per row, which the
    # adaptive planner would otherwise gather into a handful of tasks
    spread = slim.repartition(int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
    return spread.groupBy(*keys).applyInArrow(train, LOG_DDL)


def score_per_series(
    models: DataFrame,
    frame: DataFrame,
    features: Sequence[str] = HELD_OUT_FEATURES,
    keys: Sequence[str] = SERIES,
) -> DataFrame:
    """Rows with the prediction of their own series' model, as one SQL expression; null where it has none."""
    n = len(features)
    inputs = F.array(*[F.col(c).cast("double") for c in features])
    weights = F.slice("coefficients", 2, n)
    means = F.slice("coefficients", n + 2, n)
    scales = F.slice("coefficients", 2 * n + 2, n)
    centred = F.zip_with(F.zip_with(inputs, means, lambda x, m: F.coalesce(x, m) - m), scales, lambda d, s: d / s)
    dot = F.aggregate(F.zip_with(centred, weights, lambda a, w: a * w), F.lit(0.0), lambda acc, v: acc + v)
    named = frame.withColumn("model_name", F.concat(F.concat_ws("_", *keys), F.lit("_model")))
    joined = named.join(models.filter("status").select("model_name", "coefficients"), "model_name", "left")
    return joined.withColumn("prediction", F.element_at("coefficients", 1) + dot).drop("coefficients", "model_name")


def write_log(log: DataFrame, name: str) -> None:
    """Append training outcomes to a ``prediction_log`` table."""
    spec = ML["prediction_log"]
    append(conform(log.withColumnRenamed("message", "error_msg"), spec.schema, spec.defaults), name)


def write_results(results: DataFrame, name: str) -> None:
    """Append predictions to a ``prediction_results`` table."""
    spec = ML["prediction_results"]
    append(conform(results, spec.schema, spec.defaults), name)


# -- saved models -------------------------------------------------------------
def _versions(spark: SparkSession, root: str) -> list[int]:
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    found = (re.fullmatch(r"version=(\d+)", s.getPath().getName()) for s in fs.listStatus(path))
    return sorted(int(m.group(1)) for m in found if m)


def save(spark: SparkSession, model: PipelineModel, folder: str, name: str) -> int:
    """Save as the next version of a model name."""
    root = f"{folder}/{name}"
    version = max(_versions(spark, root), default=0) + 1
    model.write().save(f"{root}/version={version}")
    return version


def load_latest(spark: SparkSession, folder: str, name: str) -> PipelineModel:
    versions = _versions(spark, f"{folder}/{name}")
    if not versions:
        raise LookupError(f"no saved model named {name}")
    return PipelineModel.load(f"{folder}/{name}/version={versions[-1]}")
