"""One direct multi-step model per series: backtest, refit on all rows, a versioned store, scoring by a join.

A row's features are those known when its day begins; its targets are the sales of that day and of
the days that follow. So the features of the first day ahead forecast every step, and no forecast
feeds another one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from millpond.functions.series import lags, rolling
from millpond.operators.forecast import EXOGENOUS, FEATURES, HORIZON, LAGS, ROLL, SERIES, lag_features

STEPS = 21

OUTCOME = "model_name string, status boolean, rmse double, message string, trained_to date, n_rows int"
COEFFICIENTS = "intercepts array<double>, weights array<array<double>>, means array<double>, scales array<double>"


def by_series(panel: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """The panel dealt by series into as many partitions as the session shuffles into.

    A fixed number: a series is few bytes but much work, and the adaptive planner would gather many
    into a handful of tasks. Windows and grouped functions by the same keys keep this partitioning.
    """
    return panel.repartition(int(panel.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def direct_frame(panel: DataFrame, steps: int = STEPS, keys: Sequence[str] = SERIES) -> DataFrame:
    """Lag features of every row and, as ``targets``, the values of that row and the ``steps - 1`` after it."""
    series = Window.partitionBy(*keys).orderBy("ds")
    ahead = F.array(*[F.lead("y", k).over(series) for k in range(steps)])
    return lag_features(panel.withColumn("targets", ahead), keys)


def first_day_ahead(panel: DataFrame, constants: Mapping[str, float], keys: Sequence[str] = SERIES) -> DataFrame:
    """One row per series: the features of the day after its last one, ``constants`` as what is known of it.

    The lags of a day to come are the values of rows already there, one row nearer than for the last
    row itself; they are read in the window pass that finds the last row.
    """
    series = Window.partitionBy(*keys).orderBy("ds")
    nearer = [lag.alias(f"lag{k}") for k, lag in zip(LAGS, lags("y", [k - 1 for k in LAGS], keys, "ds"))]
    recent = series.rowsBetween(1 - ROLL, 0)
    full = F.count("y").over(recent) == ROLL
    window = [
        F.when(full, fn("y").over(recent)).alias(f"rolling_{label}_lag1_window{ROLL}")
        for label, fn in (("mean", F.avg), ("min", F.min), ("max", F.max))
    ]
    rows = panel.select(*keys, "ds", *nearer, *window, F.lead("ds").over(series).isNull().alias("_last"))
    return rows.filter("_last").select(
        *keys,
        F.date_add("ds", 1).alias("ds"),
        *[f"lag{k}" for k in LAGS],
        *[f"rolling_{label}_lag1_window{ROLL}" for label in ("mean", "min", "max")],
        F.weekofyear(F.date_add("ds", 1)).alias("week"),
        F.month(F.date_add("ds", 1)).alias("month"),
        *[F.lit(v).alias(c) for c, v in constants.items()],
    )


def _ridge(x: np.ndarray, y: np.ndarray, strength: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights of all targets (first row: intercepts), imputation means and scales; one factorisation serves all."""
    if len(x) < 2:
        raise ValueError(f"{len(x)} complete rows, 2 needed")
    known = ~np.isnan(x)
    means = np.where(known, x, 0.0).sum(0) / np.maximum(known.sum(0), 1)
    filled = np.where(known, x, means)
    scales = filled.std(0)
    scales[scales == 0] = 1.0
    design = np.column_stack([np.ones(len(x)), (filled - means) / scales])
    penalty = strength * np.eye(design.shape[1])
    penalty[0, 0] = 0.0
    return np.linalg.solve(design.T @ design + penalty, design.T @ y), means, scales


def _applied(x: np.ndarray, model: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    weights, means, scales = model
    return weights[0] + ((np.where(np.isnan(x), means, x) - means) / scales) @ weights[1:]


def _train(x: np.ndarray, y: np.ndarray, day: np.ndarray, horizon: int, strength: float):
    """The error of the first ``horizon`` steps over the last ``horizon`` days, and the model refitted on all rows."""
    cut = int((day <= day[-1] - horizon).sum())
    inside = np.arange(len(x)) + horizon <= cut
    held = y[cut, :horizon]
    trial = _ridge(x[inside], y[inside, :horizon], strength)
    rmse = float(np.sqrt(np.nanmean((_applied(x[cut : cut + 1], trial)[0] - held) ** 2)))
    whole = ~np.isnan(y).any(1)
    return rmse, int(whole.sum()), _ridge(x[whole], y[whole], strength)


def fit_direct(
    frame: DataFrame,
    features: Sequence[str] = FEATURES,
    horizon: int = HORIZON,
    strength: float = 1.0,
    keys: Sequence[str] = SERIES,
) -> DataFrame:
    """One row per series: keys, ``OUTCOME`` and ``COEFFICIENTS`` (one weight vector per step of ``direct_frame``).

    The backtest fits the first ``horizon`` steps on rows whose targets end before the held-out days
    and forecasts these from the first of them; then all steps are fitted on every row that has all
    its targets. A series that fails is a row with its message, null error and no coefficients. Groups are no
    longer than the calendar, since a panel has one row per series and day.
    """
    names = list(features)
    fields = [f"{k} {t}" for k, t in frame.select(*keys).dtypes]
    schema = StructType.fromDDL(", ".join([*fields, OUTCOME, COEFFICIENTS]))
    arrow = to_arrow_schema(schema)

    def train(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("ds")
        out = dict(zip(keys, (k.as_py() for k in key)))
        out |= {"model_name": "_".join(str(v) for v in out.values()) + "_model", "trained_to": rows["ds"][-1].as_py()}
        try:
            day = rows["ds"].cast(pa.int32()).to_numpy()
            x = np.column_stack([rows[c].to_numpy() for c in names])
            targets = rows["targets"].combine_chunks()
            y = targets.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1).astype(float)
            rmse, n, (weights, means, scales) = _train(x, y, day, horizon, strength)
            out |= {"status": True, "rmse": rmse, "message": "", "n_rows": n, "intercepts": weights[0].tolist()}
            out |= {"weights": weights[1:].T.tolist(), "means": means.tolist(), "scales": scales.tolist()}
        except Exception as e:  # noqa: BLE001 - one series must not stop the others
            out |= {"status": False, "message": str(e)}
        return pa.Table.from_pylist([out], schema=arrow)

    typed = [F.col(c).cast("double").alias(c) for c in names]
    slim = frame.select(*keys, "ds", F.col("targets").cast("array<double>").alias("targets"), *typed)
    return slim.groupBy(*keys).applyInArrow(train, schema)


# -- the store ----------------------------------------------------------------
def _finished(spark: SparkSession, folder: str) -> list[int]:
    """Versions whose write ended; one that died has no success marker and is never read."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/version=*/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in found or [])


def publish(models: DataFrame, folder: str, features: Sequence[str] = FEATURES) -> int:
    """Write trained series as the next version of the store; returns its number.

    A version may hold any part of the series, failed ones included. What a write that died has
    left under the same number is replaced.
    """
    version = max(_finished(models.sparkSession, folder), default=0) + 1
    named = models.withColumn("features", F.array(*[F.lit(f) for f in features]))
    named.write.mode("overwrite").parquet(f"{folder}/version={version}")
    return version


def latest(spark: SparkSession, folder: str, keys: Sequence[str] = SERIES) -> DataFrame:
    """The newest successful model of every series that has one, with its ``version``.

    A training that failed never replaces an older model. One aggregate over the store; what was
    trained in one version meets map-side. Only finished versions are listed and read.
    """
    versions = _finished(spark, folder)
    if not versions:
        raise LookupError(f"no finished version in {folder}")
    stored = spark.read.option("basePath", folder).parquet(*[f"{folder}/version={v}" for v in versions]).filter("status")
    rest = [c for c in stored.columns if c not in keys]
    newest = stored.groupBy(*keys).agg(F.max_by(F.struct(*rest), "version").alias("m"))
    return newest.select(*keys, "m.*")


def forecast_series(
    models: DataFrame,
    ahead: DataFrame,
    steps: int = STEPS,
    features: Sequence[str] = FEATURES,
    constants: Sequence[str] = EXOGENOUS,
    keys: Sequence[str] = SERIES,
    as_of: str | None = None,
) -> DataFrame:
    """``prediction_results`` rows, with step and version, for the next days of every series in ``ahead``.

    A left join by series of one feature row to one model, then one expression per step: no Python.
    A series without a model, or with one of fewer steps, keeps its days with a null prediction.
    """
    inputs = F.array(*[F.col(f"a.{c}").cast("double") for c in features])
    filled = F.zip_with(inputs, F.col("m.means"), lambda x, m: F.coalesce(x, m) - m)
    scaled = F.zip_with(filled, F.col("m.scales"), lambda d, s: d / s)
    joined = ahead.alias("a").join(models.alias("m"), list(keys), "left")
    ready = joined.select(*keys, "a.ds", "m.version", "m.intercepts", "m.weights", scaled.alias("x"), *[f"a.{c}" for c in constants])
    unfolded = ready.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(steps))))
    at = F.col("step") - 1
    products = F.zip_with("x", F.get("weights", at), lambda a, w: a * w)
    dot = F.aggregate(products, F.get("intercepts", at), lambda acc, v: acc + v)
    when = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return unfolded.select(
        F.date_add("ds", at).alias("ds"),
        F.concat_ws("_", *keys).alias("series_id"),
        dot.alias("prediction"),
        F.to_json(F.struct(*constants)).alias("features"),
        when.alias("prediction_date"),
        "step",
        "version",
    )
