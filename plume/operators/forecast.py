"""Forecast with change points and an interval (M1).

Per network, hourly counts are explained by a trend that may bend and jump at
fixed change points, and by daily and weekly cycles: a linear model whose
columns are Spark expressions (:func:`design`) and whose bends and jumps are
penalised, so that they are used only where the history needs them. A network
has ``24 * history_days`` hours however many posts it has; these few rows are
fitted in one group each. The interval adds the quantiles of the residuals to
the forecast.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import as_of_lit, to_ntz

HOUR_S = 3600
# Fixed parameters (ours).
CHANGE_POINTS = 20
CHANGE_SHARE = 0.9  # of the history; later changes can't be told from noise
DAILY, WEEKLY = 3, 3  # pairs of sine and cosine
PENALTY = 5.0  # on bends (a post an hour and day) and jumps (posts an hour)
INTERVAL = (0.1, 0.9)


def hourly_grid(df: DataFrame, as_of, history_days: int, horizon_hours: int, ts: str = "created_at") -> DataFrame:
    """(source, hour, posts): every hour of the history, 0 where there are none, and of the horizon, null there. The hours
    of each network are joined with its counts."""
    now = F.date_trunc("hour", as_of_lit(as_of))
    low = now - F.make_dt_interval(days=F.lit(history_days))
    recent = df.where((F.col(ts) >= low) & (F.col(ts) < now))
    counts = recent.groupBy("source", F.date_trunc("hour", F.col(ts)).alias("hour")).agg(F.count(F.lit(1)).alias("posts"))
    last = now + F.make_dt_interval(hours=F.lit(horizon_hours - 1))
    hours = counts.select("source").distinct().select("source", F.explode(F.sequence(low, last, F.expr("INTERVAL 1 HOUR"))).alias("hour"))
    known = F.when(F.col("hour") < now, F.coalesce("posts", F.lit(0))).cast("double")
    return hours.join(counts, ["source", "hour"], "left").select("source", "hour", known.alias("posts"))


def design(grid: DataFrame, as_of, history_days: int) -> tuple[DataFrame, list[str], list[str]]:
    """Adds the model's columns; returns the frame, all of them, and those that are penalised. ``x`` is days since the
    start of the history."""
    now = F.date_trunc("hour", as_of_lit(as_of))
    low = F.unix_seconds(now - F.make_dt_interval(days=F.lit(history_days)))
    x = (F.unix_seconds("hour") - low) / (24 * HOUR_S)
    columns: dict[str, Column] = {"level": F.lit(1.0), "x": x}
    for j in range(1, CHANGE_POINTS + 1):
        at = history_days * CHANGE_SHARE * j / (CHANGE_POINTS + 1)
        columns[f"bend{j}"] = F.greatest(x - at, F.lit(0.0))
        columns[f"jump{j}"] = F.when(x >= at, 1.0).otherwise(0.0)
    for name, days, pairs in (("day", 1, DAILY), ("week", 7, WEEKLY)):
        for k in range(1, pairs + 1):
            angle = x * (2 * np.pi * k / days)
            columns[f"{name}_sin{k}"], columns[f"{name}_cos{k}"] = F.sin(angle), F.cos(angle)
    penalised = [c for c in columns if c.startswith(("bend", "jump"))]
    return grid.select("*", *[c.alias(n) for n, c in columns.items()]), list(columns), penalised


def solve(matrix: np.ndarray, y: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    """Penalised least squares."""
    return np.linalg.solve(matrix.T @ matrix + np.diag(penalty), matrix.T @ y)


def forecast_trend(df: DataFrame, as_of, history_days: int = 30, horizon_hours: int = 168, ts: str = "created_at") -> DataFrame:
    """(source, hour, forecast, lo, hi): the next hours of each network that had posts in the history; never below 0."""
    frame, columns, penalised = design(hourly_grid(df, as_of, history_days, horizon_hours, ts), as_of, history_days)
    penalty = np.array([PENALTY if c in penalised else 1e-9 for c in columns])

    def fit(hours: pd.DataFrame) -> pd.DataFrame:
        matrix, y = hours[columns].to_numpy(float), hours["posts"].to_numpy(float)
        past = ~np.isnan(y)
        model = matrix @ solve(matrix[past], y[past], penalty)
        low, high = np.quantile(y[past] - model[past], INTERVAL)
        out = hours.loc[~past, ["source", "hour"]].copy()
        for name, shift in (("forecast", 0.0), ("lo", low), ("hi", high)):
            out[name] = np.maximum(model[~past] + shift, 0.0)
        return out

    out = frame.groupBy("source").applyInPandas(fit, "source string, hour timestamp, forecast double, lo double, hi double")
    return out.select("source", to_ntz("hour").alias("hour"), *[F.round(c, 4).alias(c) for c in ("forecast", "lo", "hi")])


def forecast_design(df: DataFrame, as_of, history_days: int = 30, horizon_hours: int = 168, ts: str = "created_at") -> DataFrame:
    """The model's rows as they are fitted, rounded to six places."""
    frame, columns, _ = design(hourly_grid(df, as_of, history_days, horizon_hours, ts), as_of, history_days)
    return frame.select("source", to_ntz("hour").alias("hour"), "posts", *[(F.round(c, 6) + 0.0).alias(c) for c in columns])  # no negative zeros
