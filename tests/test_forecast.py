from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from signalgrid.operators import additive, forecast

UNTIL = "2024-01-08"
FACTS = (
    "hex_id string, cell_id string, event_date date, event_hour int,"
    "user_density_count bigint, avg_rsrp double"
)
START = dt.datetime(2024, 1, 1)


def facts(spark, series, hours, users, rsrp):
    rows = []
    for i in hours:
        t = START + dt.timedelta(hours=i)
        rows.append((*series, t.date(), t.hour, int(users(i)), float(rsrp(i))))
    return spark.createDataFrame(rows, FACTS)


def daily(i):
    return math.sin(2 * math.pi * (i % 24) / 24)


@pytest.fixture(scope="module")
def steady(spark):
    """A trend of 1/8 dB an hour and a daily swing, without noise."""
    return facts(
        spark, ("1:1", "A"), range(168), lambda i: 50 + i + round(10 * daily(i)),
        lambda i: -100 + i / 8 + 5 * daily(i),
    )


def test_history_window(spark, steady):
    later = facts(spark, ("1:1", "A"), range(168, 180), lambda i: 1, lambda i: -90)
    earlier = facts(spark, ("1:1", "A"), range(-30, 0), lambda i: 1, lambda i: -90)
    broken = steady.limit(1).withColumn("avg_rsrp", F.lit(None).cast("double"))
    training = forecast.history(
        steady.union(later).union(earlier).union(broken), UNTIL
    )
    assert training.count() == 168
    assert training.agg(F.min("record_time")).first()[0] == START


def test_seasonal_recovers_a_known_signal(steady):
    ahead = forecast.seasonal(forecast.history(steady, UNTIL), UNTIL).orderBy("forecast_time")
    rows = ahead.collect()
    assert [r.forecast_time for r in rows] == [
        START + dt.timedelta(hours=168 + k) for k in range(24)
    ]
    for k, r in enumerate(rows):
        i = 168 + k
        # The trend takes up a part of the daily swing, and gives it back as hour effect.
        assert r.forecast_rsrp == pytest.approx(min(-100 + i / 8 + 5 * daily(i), -40), abs=0.8)
        assert abs(r.forecast_density - (50 + i + round(10 * daily(i)))) <= 3
        assert r.forecast_rsrp_lower <= r.forecast_rsrp <= r.forecast_rsrp_upper
        assert (r.forecast_date, r.forecast_hour) == (r.forecast_time.date(), r.forecast_time.hour)


def test_seasonal_equals_least_squares_by_hand(spark):
    rng = np.random.default_rng(3)
    noise = rng.normal(0, 4, 168)
    skip = {5, 40, 41, 99}
    hours = [i for i in range(160) if i not in skip]
    df = facts(spark, ("1:1", "A"), hours, lambda i: 20, lambda i: -95 + noise[i])
    got = forecast.seasonal(forecast.history(df, UNTIL), UNTIL).orderBy("forecast_time").collect()
    t = np.array(hours, float)
    y = np.array([-95 + noise[i] for i in hours])
    slope, base = np.polyfit(t, y, 1)
    left = y - base - slope * t
    effect = {h: left[(t % 24) == h].mean() for h in range(24)}
    rest = left - np.array([effect[int(i) % 24] for i in t])
    for k, row in enumerate(got):
        i = 160 + k
        want = base + slope * i + effect[i % 24]
        assert row.forecast_rsrp == pytest.approx(want, abs=2e-6)
        assert row.forecast_rsrp_upper - want == pytest.approx(1.2816 * rest.std(ddof=1), abs=4e-6)


@pytest.mark.parametrize("model", [forecast.seasonal, forecast.fourier, forecast.changepoints])
def test_short_series_give_nothing(spark, model):
    short = facts(spark, ("1:1", "S"), range(23), lambda i: 5, lambda i: -90)
    enough = facts(spark, ("1:1", "E"), range(24), lambda i: 5, lambda i: -90)
    training = forecast.history(short.union(enough), UNTIL)
    ahead = model(training, UNTIL)
    rows = ahead.collect()
    assert {r.cell_id for r in rows} == {"E"} and len(rows) == 24
    assert min(r.forecast_time for r in rows) == START + dt.timedelta(hours=24)
    assert {r.forecast_density for r in rows} == {5}
    nothing = training.limit(0)
    empty = model(nothing, UNTIL)
    assert empty.count() == 0 and empty.columns == ahead.columns


@pytest.mark.parametrize("model", [forecast.fourier, forecast.changepoints])
def test_fourier_recovers_a_known_signal(steady, model):
    rows = model(forecast.history(steady, UNTIL), UNTIL).orderBy("forecast_time").collect()
    assert len(rows) == 24
    for k, r in enumerate(rows):
        i = 168 + k
        assert r.forecast_rsrp == pytest.approx(-100 + i / 8 + 5 * daily(i), abs=0.5)
        assert r.forecast_rsrp_lower <= r.forecast_rsrp <= r.forecast_rsrp_upper
    assert dict(model(forecast.history(steady, UNTIL), UNTIL).dtypes) == dict(
        forecast.seasonal(forecast.history(steady, UNTIL), UNTIL).dtypes
    )


def test_a_bent_trend_is_followed_and_a_straight_one_stays_straight(spark):
    rng = np.random.default_rng(5)
    noise = rng.normal(0, 0.3, 200)
    bent = lambda i: -110 + 0.05 * i + 0.3 * max(0, i - 80) + 3 * daily(i) + noise[i]
    straight = lambda i: -110 + 0.1 * i + 3 * daily(i) + noise[i]
    both = facts(spark, ("1:1", "B"), range(168), lambda i: 9, bent).union(
        facts(spark, ("1:1", "S"), range(168), lambda i: 9, straight)
    )
    training = forecast.history(both, UNTIL)

    def error(model, cell, signal):
        rows = model(training, UNTIL).where(F.col("cell_id") == cell).orderBy("forecast_time").collect()
        return np.mean([abs(r.forecast_rsrp - signal(168 + k)) for k, r in enumerate(rows)])

    assert error(forecast.changepoints, "B", bent) < 0.25 * error(forecast.fourier, "B", bent)
    assert error(forecast.changepoints, "S", straight) < 1.0


def test_sums_and_rounds_equal_a_fit_over_the_rows(spark):
    rng = np.random.default_rng(7)
    hours = sorted(rng.choice(168, 90, replace=False).tolist())
    level = rng.normal(-95, 5, 168)
    df = facts(spark, ("1:1", "A"), hours, lambda i: 20, lambda i: level[i])
    rows = forecast.changepoints(forecast.history(df.repartition(5), UNTIL), UNTIL).orderBy("forecast_time").collect()
    t = np.array(hours, float)
    x, y = additive.design(t, 168.0, additive.CHANGES), np.array([level[i] for i in hours])
    z, centred = (y - y.mean()) / y.std(), x - x.mean(axis=0)
    penalty = np.zeros(x.shape[1])
    penalty[1 : 1 + additive.CHANGES] = additive.CHANGE_PENALTY * len(y)
    weights = np.zeros(x.shape[1])
    for _ in range(additive.ROUNDS):
        for j in range(len(weights)):
            rest = z - centred @ weights + centred[:, j] * weights[j]
            left = centred[:, j] @ rest
            weights[j] = np.sign(left) * max(abs(left) - penalty[j], 0) / (centred[:, j] @ centred[:, j] + additive.RIDGE)
    ahead = additive.design(hours[-1] + np.arange(1.0, 25.0), 168.0, additive.CHANGES) - x.mean(axis=0)
    want = y.mean() + y.std() * ahead @ weights
    spread = 1.2816 * y.std() * np.sqrt(((z - centred @ weights) ** 2).sum() / (len(y) - 1))
    assert [r.forecast_rsrp for r in rows] == pytest.approx(np.clip(want, -140, -40).tolist(), abs=1e-8)
    assert rows[0].forecast_rsrp_upper == pytest.approx(want[0] + spread, abs=1e-8)
    assert {r.forecast_density for r in rows} == {20}


def test_rounds_reach_the_least_of_the_penalised_squares():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 5))
    y = x @ np.array([1.0, 0.0, 0.5, 0.0, -2.0]) + rng.normal(0, 0.1, 200)
    penalty = np.array([0.0, 30.0, 30.0, 30.0, 0.0])
    weights = additive.descend((x.T @ x)[None], (x.T @ y)[None], penalty[None], 200)[0]
    slope = x.T @ (y - x @ weights) - additive.RIDGE * weights
    assert weights[1] == weights[3] == 0 and (np.abs(slope) <= penalty + 1e-8).all()
    assert slope[[0, 4]] == pytest.approx([0, 0], abs=1e-8) and slope[2] == pytest.approx(30 * np.sign(weights[2]))


@pytest.mark.parametrize("model", [forecast.fourier, forecast.changepoints])
def test_history_is_reduced_before_one_shuffle(steady, model):
    plan = model(forecast.history(steady, UNTIL), UNTIL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "InPandas" not in plan
    assert plan.index("MapInArrow") < plan.index("Exchange") < plan.rindex("HashAggregate")


def test_clipping(spark):
    falling = facts(spark, ("1:1", "A"), range(168), lambda i: 168 - i, lambda i: -60 + i / 7)
    rows = forecast.seasonal(forecast.history(falling, UNTIL), UNTIL).collect()
    assert min(r.forecast_density for r in rows) == 0 == min(r.forecast_lower for r in rows)
    assert max(r.forecast_rsrp_upper for r in rows) <= -35
    assert all(-140 <= r.forecast_rsrp <= -40 for r in rows)


def test_coarser_series_combine_hours(spark):
    both = facts(spark, ("1:1", "A"), range(48), lambda i: 1, lambda i: -90).union(
        facts(spark, ("2:1", "A"), range(48), lambda i: 3, lambda i: -100)
    )
    training = forecast.history(both, UNTIL, series=["cell_id"])
    assert training.count() == 48
    assert set(training.select("user_density_count", "avg_rsrp").collect()) == {(4, -97.5)}


def test_metrics(spark):
    actual = facts(spark, ("1:1", "A"), range(4), lambda i: [0, 10, 20, 99][i], lambda i: -90)
    predicted = spark.createDataFrame(
        [("1:1", "A", dt.date(2024, 1, 1), h, d, r) for h, d, r in
         ((0, 2, -92.0), (1, 12, -90.0), (2, 15, -89.0), (7, 1, -1.0))],
        "hex_id string, cell_id string, forecast_date date, forecast_hour int,"
        "forecast_density int, forecast_rsrp double",
    )
    row = forecast.metrics(actual, predicted, "2024-01-01").first()
    assert row.total_matched_records == 3
    assert row.mae_density == 3.0 and row.rmse_density == round(math.sqrt(33 / 3), 2)
    assert row.mape_density == 15.0  # (0 + 20 + 25) / 3: a load of 0 counts as no error
    assert row.mae_rsrp == 1.0 and row.rmse_rsrp == round(math.sqrt(5 / 3), 2)


def test_worst(spark):
    rows = [("h", f"c{i:03d}", float(i % 7)) for i in range(150)]
    scores = spark.createDataFrame(rows, "hex_id string, cell_id string, mape_density double")
    got = [tuple(r) for r in forecast.worst(scores).collect()]
    assert got == sorted(rows, key=lambda r: (-r[2], r[0], r[1]))[:100]
