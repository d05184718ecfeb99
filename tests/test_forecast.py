"""Forecast with change points and interval (M1)."""

import datetime as dt

import numpy as np
import pytest

from plume.operators import forecast as FC

NOW = dt.datetime(2024, 3, 1)
AS_OF = "2024-03-01 00:30:00"


def history(rate, days=30, seed=1, source="a"):
    """(source, created_at) with ``rate(hours since start)`` posts an hour on average."""
    rng = np.random.default_rng(seed)
    low = NOW - dt.timedelta(days=days)
    return [(source, low + dt.timedelta(hours=h, seconds=int(s))) for h in range(24 * days)
            for s in rng.integers(0, 3600, rng.poisson(rate(h)))]


def forecast(spark, rows, **more):
    df = spark.createDataFrame(rows, "source string, created_at timestamp")
    out = {}
    for r in FC.forecast_trend(df, AS_OF, **more).orderBy("hour").collect():
        out.setdefault(r["source"], []).append(r)
    return out


def test_a_level_shift_is_followed(spark):
    rows = history(lambda h: 40 if h < 24 * 18 else 10)
    out = forecast(spark, rows)["a"]
    assert len(out) == 168 and out[0]["hour"] == NOW and out[-1]["hour"] == NOW + dt.timedelta(hours=167)
    mean = np.mean([r["forecast"] for r in out[:72]])
    assert 7 < mean < 14  # the mean of the whole history is 28, its straight line falls below 0
    assert all(0 <= r["lo"] <= r["forecast"] <= r["hi"] for r in out)


def test_cycles_and_networks_are_apart(spark):
    day = lambda h: 30 + 20 * np.sin(2 * np.pi * h / 24)
    rows = history(day, source="a") + history(lambda h: 5 + 0.01 * h, seed=2, source="b")
    out = forecast(spark, rows)
    got = np.array([r["forecast"] for r in out["a"]])
    assert np.abs(got - [day(h) for h in range(168)]).mean() < 4
    assert 11 < np.mean([r["forecast"] for r in out["b"]]) < 16  # the trend goes on


def test_the_interval_holds_its_share(spark):
    rate = lambda h: 30 + 10 * np.sin(2 * np.pi * h / 24)
    out = forecast(spark, history(rate))["a"]
    rng = np.random.default_rng(9)
    inside = [r["lo"] <= n <= r["hi"] for h, r in enumerate(out) for n in rng.poisson(rate(h), 20)]
    assert 0.7 < np.mean(inside) < 0.9  # between the quantiles 0.1 and 0.9


def test_penalties_hold_unneeded_changes_down():
    matrix = np.hstack([np.ones((50, 1)), (np.arange(50) >= 25)[:, None].astype(float)])
    y = np.concatenate([np.zeros(25), np.ones(25)])
    free, held = (FC.solve(matrix, y, np.array([1e-9, p]))[1] for p in (1e-9, 100.0))
    assert abs(free - 1) < 1e-6 and 0 < held < 0.2


@pytest.mark.parametrize("rows", [[], [("a", None)], [("a", NOW + dt.timedelta(days=3))]])
def test_no_history_gives_no_forecast(spark, rows):
    assert forecast(spark, rows) == {}


def test_a_single_post(spark):
    out = forecast(spark, [("a", NOW - dt.timedelta(days=2)), (None, NOW - dt.timedelta(days=1))])
    assert len(out["a"]) == 168 and all(0 <= r["forecast"] < 1 for r in out["a"])
