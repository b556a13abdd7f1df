"""Thresholds, label codes and session settings.

Every number below is a default; each operator takes the object as an argument.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

LOCAL_ZONE = "Asia/Ho_Chi_Minh"


# Signal, load and alert limits of the monitored network.
@dataclass(frozen=True)
class Thresholds:
    weak_rsrp: float = -110.0  # a weak sample, and a poor hour in the day trend
    hole_rsrp: float = -100.0  # below this an hour counts as bad
    good_rsrp: float = -90.0
    dense_users: int = 50
    critical_hours: int = 3  # bad hours in a row that make an area critical
    risk_drop_db: float = 10.0  # forecast minus its lower bound
    optimise_drop_db: float = 15.0
    risk_load_share: float = 0.5  # forecast load against its upper bound
    alert_horizon_hours: int = 12
    heatmap_days: int = 28
    gate_percent: float = 80.0


# Limits a measurement must meet to be kept.
@dataclass(frozen=True)
class Limits:
    lat: tuple[float, float] = (8.5, 23.4)
    lng: tuple[float, float] = (102.1, 109.5)
    rsrp: tuple[float, float] = (-140.0, -44.0)
    rsrq: tuple[float, float] = (-20.0, -3.0)
    max_distance_km: float = 50.0
    sigmas: float = 3.0
    # Added to a cell's limit; a millimetre frees verdicts from the order a mean is summed in.
    tolerance_km: float = 0.0


# Label codes.
CRITICAL = "critical"
NEEDS_OPTIMISATION = "needs_optimisation"
WATCH = "watch"
GOOD = "good"
NORMAL = "normal"
NO_FORECAST = "no_forecast"
DEGRADATION_RISK = "degradation_risk"
CONTINUED_HOLE = "continued_hole"
SAFE = "safe"
CURRENT_HOLE = "current_hole"
SUDDEN_DEGRADATION = "sudden_degradation"

SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot cell in a lookup that is too big to broadcast: split its partition, even
    # where that costs one more exchange below the next aggregate.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Groups per task that percentile_approx holds as objects before it sorts. A group's
    # summary may take some 240 KB, so this bounds them to about 250 MB.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "1024",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators are written for."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark
