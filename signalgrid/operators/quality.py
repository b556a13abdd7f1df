"""Quality rules, row verdicts and batch reports.

Many batches are scored at once: ``by`` names the batch columns, ``()`` takes all rows as
one batch.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from signalgrid.operators.enrich import with_distance
from signalgrid.operators.lookups import first_per_key, flag_first
from signalgrid.schemas import BATCH, COPY_KEYS, EVENT_HOUR
from signalgrid.settings import Limits, Thresholds

HELPERS = ("mean_distance_km", "sd_distance_km", "is_first_copy", "is_clean")


# ---- rules ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """One expectation on a batch.

    ``passing`` and ``counted`` are SQL expressions over the frame of :func:`copies`: how
    many measurements of a copy group pass, and how many the rule looks at. ``mostly`` is
    the smallest share that passes the batch.
    """

    name: str
    column: str
    mostly: float
    passing: str
    counted: str


def _on_values(name: str, column: str, mostly: float, test: str) -> Rule:
    known = f"IF({column} IS NOT NULL, copies, 0)"
    return Rule(name, column, mostly, f"IF({test}, copies, 0)", known)


def not_null(column: str, mostly: float) -> Rule:
    return Rule("not_null", column, mostly, f"IF({column} IS NOT NULL, copies, 0)", "copies")


def length_at_least(column: str, size: int, mostly: float) -> Rule:
    return _on_values("length", column, mostly, f"length({column}) >= {size}")


def between(column: str, edges: tuple[float, float], mostly: float) -> Rule:
    return _on_values(
        "between", column, mostly, f"{column} BETWEEN {edges[0]}D AND {edges[1]}D"
    )


def not_equal(column: str, value: float, mostly: float) -> Rule:
    return _on_values("not_in_set", column, mostly, f"{column} <> {value}D")


def in_batch_hour(mostly: float) -> Rule:
    """The event hour is the hour of the batch; rows without event time do not count."""
    return Rule("in_set", "date_hour", mostly, "on_time", "on_time + late")


def unique_together(columns: Sequence[str], mostly: float) -> Rule:
    """All copies of a repeated row count as bad; rows with no value at all do not count."""
    known = f"coalesce({', '.join(f'CAST({c} AS STRING)' for c in columns)}) IS NOT NULL"
    return Rule(
        "unique",
        "compound_key",
        mostly,
        f"IF(copies = 1 AND {known}, 1, 0)",
        f"IF({known}, copies, 0)",
    )


def default_rules(limits: Limits = Limits()) -> list[Rule]:
    # The smallest passing share of each rule.
    return [
        not_null("lat", 0.95),
        not_null("lng", 0.95),
        not_null("cell_code", 1.0),
        length_at_least("cell_code", 1, 1.0),
        between("p_cell_rsrp", limits.rsrp, 0.98),
        between("p_cell_rsrq", limits.rsrq, 0.98),
        between("lat", limits.lat, 0.95),
        between("lng", limits.lng, 0.95),
        not_equal("lat", 0.0, 0.95),
        in_batch_hour(1.0),
        unique_together(COPY_KEYS, 0.98),
    ]


def is_on_time() -> Column:
    """Whether a row belongs to the hour it arrived in."""
    date, hour = EVENT_HOUR
    arrived_date, arrived_hour = BATCH
    return (F.col(date) == F.col(arrived_date)) & (F.col(hour) == F.col(arrived_hour))


def not_late() -> Column:
    """On time; a row whose hour is not known counts as on time."""
    return F.coalesce(is_on_time(), F.lit(True))


def copies(df: DataFrame, by: Sequence[str] = BATCH) -> DataFrame:
    """One row per distinct measurement of a batch with its number of copies.

    All rules and counts are sums over this frame, so a batch is shuffled once however many
    rules there are, and a hot group of copies is counted before the shuffle.
    """
    on_time = is_on_time()
    return df.groupBy(*by, *COPY_KEYS).agg(
        F.count(F.lit(1)).alias("copies"),
        F.count_if(on_time).alias("on_time"),
        F.count_if(~on_time).alias("late"),
    )


def _rule_sums(rules: Sequence[Rule]) -> list[Column]:
    sums = []
    for i, rule in enumerate(rules):
        sums.append(F.sum(F.expr(rule.passing)).cast("bigint").alias(f"_passing_{i}"))
        sums.append(F.sum(F.expr(rule.counted)).cast("bigint").alias(f"_counted_{i}"))
    return sums


def _observed(i: int) -> Column:
    counted = F.col(f"_counted_{i}")
    return F.when(counted > 0, F.col(f"_passing_{i}") / counted)


def _passed(i: int, rule: Rule) -> Column:
    # Nothing to look at means nothing is wrong.
    return F.coalesce(_observed(i) >= F.lit(rule.mostly), F.lit(True))


def scorecard(
    df: DataFrame, rules: Sequence[Rule] | None = None, by: Sequence[str] = BATCH
) -> DataFrame:
    """One row per batch and rule: observed share, required share, verdict."""
    rules = rules or default_rules()
    sums = copies(df, by).groupBy(*by).agg(*_rule_sums(rules))
    lines = F.array(
        *(
            F.struct(
                F.lit(rule.name).alias("rule"),
                F.lit(rule.column).alias("rule_column"),
                _observed(i).alias("observed"),
                F.lit(rule.mostly).alias("mostly"),
                _passed(i, rule).alias("passed"),
            )
            for i, rule in enumerate(rules)
        )
    )
    return sums.select(*by, F.explode(lines).alias("_line")).select(*by, "_line.*")


# ---- row verdicts -----------------------------------------------------------------------


def dedup(df: DataFrame, keys: Sequence[str] = COPY_KEYS, order: Sequence[str] = ()) -> DataFrame:
    """Keep the first of the copies of each measurement."""
    return first_per_key(df, keys, order)


def within_country(limits: Limits = Limits()) -> Column:
    return F.coalesce(
        F.col("lat").between(*limits.lat) & F.col("lng").between(*limits.lng), F.lit(False)
    )


def plausible_distance(scope: str = "valid", limits: Limits = Limits()) -> Column:
    """The distance where it counts for statistics, else null."""
    if scope not in ("valid", "all"):
        raise ValueError(f"unknown scope {scope!r}")
    d = F.col("distance_to_cell_km")
    if scope == "all":
        return d
    # A condition inside the aggregates, not a filter: a filter would be pushed below
    # the distance and compute it twice.
    return F.when(within_country(limits) & (d <= limits.max_distance_km), d)


def distance_stats(
    located: DataFrame,
    by: Sequence[str] = BATCH,
    scope: str = "valid",
    limits: Limits = Limits(),
) -> DataFrame:
    """Mean and sample deviation of the distance per batch and cell.

    ``scope="all"`` uses every row, also those with a sentinel distance or bad position;
    ``"valid"`` only rows inside the country and the distance limit.
    """
    d = plausible_distance(scope, limits)
    return located.groupBy(*by, "cell_id").agg(
        F.avg(d).alias("mean_distance_km"), F.stddev_samp(d).alias("sd_distance_km")
    )


def with_stats(
    located: DataFrame, stats: DataFrame, by: Sequence[str] = BATCH, broadcast: bool = False
) -> DataFrame:
    """Attach the statistics of its cell to each row.

    An aggregate joined back, not a window: a hot cell is neither sorted nor sent to one
    task. ``broadcast`` is for callers that know the statistics are few (one batch has at
    most one row per cell); otherwise sizes decide and hot cells are split at run time.
    """
    wide = F.broadcast(stats) if broadcast else stats
    keys = [*by, "cell_id"]
    # Batches without a date, and rows without a cell, still meet their own statistics.
    renamed = wide.withColumnsRenamed({k: f"_{k}" for k in keys})
    match = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return located.join(renamed, match, "left").drop(*(f"_{k}" for k in keys))


def far_limit(limits: Limits = Limits()) -> Column:
    """The largest plausible distance for a row's cell; one-row cells have no deviation."""
    return (
        F.col("mean_distance_km")
        + limits.sigmas * F.coalesce(F.col("sd_distance_km"), F.lit(0.0))
        + limits.tolerance_km
    )


def outliers(
    measurements: DataFrame,
    cells: DataFrame,
    by: Sequence[str] = BATCH,
    scope: str = "valid",
    limits: Limits = Limits(),
) -> DataFrame:
    """All rows with their cell's distance statistics and an ``is_outlier`` flag."""
    located = with_distance(measurements, cells)
    scored = with_stats(located, distance_stats(located, by, scope, limits), by)
    flag = F.coalesce(F.col("distance_to_cell_km") > far_limit(limits), F.lit(False))
    return scored.withColumn("is_outlier", flag)


def plausible(limits: Limits = Limits()) -> Column:
    """Everything a row must meet but for being the first copy; unknown counts as no."""
    distance = F.col("distance_to_cell_km")
    return F.coalesce(
        within_country(limits)
        & (F.col("lat") != 0.0)
        & F.col("p_cell_rsrp").between(*limits.rsrp)
        & F.col("p_cell_rsrq").between(*limits.rsrq)
        & (distance <= limits.max_distance_km)
        & (distance <= far_limit(limits)),
        F.lit(False),
    )


def classify(
    measurements: DataFrame,
    cells: DataFrame,
    by: Sequence[str] = BATCH,
    order: Sequence[str] = (),
    scope: str = "valid",
    limits: Limits = Limits(),
    broadcast_stats: bool = False,
    known: DataFrame | None = None,
) -> DataFrame:
    """All rows with ``distance_to_cell_km``, ``is_first_copy`` and ``is_clean``.

    ``known`` are further measurements of the same batches, for the distance statistics only:
    the rows an hour already has, when a few more are judged.
    """
    # First copies are settled by input partition, so before any join deals the rows anew.
    flagged = with_distance(flag_first(measurements, [*by, *COPY_KEYS], order), cells)
    needed = [*by, "cell_code", "lat", "lng"]
    basis = measurements.select(*needed)
    if known is not None:
        basis = basis.unionByName(known.select(*needed))
    stats = distance_stats(with_distance(basis, cells), by, scope, limits)
    scored = with_stats(flagged, stats, by, broadcast_stats)
    return scored.withColumn("is_clean", plausible(limits) & F.col("is_first_copy"))


def split(classified: DataFrame, drop: Sequence[str] = BATCH) -> tuple[DataFrame, DataFrame]:
    """Clean and quarantined rows without helper columns; together they are all rows."""
    helpers = [*HELPERS, "cell_id", *drop]
    return (
        classified.where(F.col("is_clean")).drop(*helpers),
        classified.where(~F.col("is_clean")).drop(*helpers),
    )


def stamp(df: DataFrame) -> DataFrame:
    return df.withColumn("processed_at", F.current_timestamp())


# ---- batch report -----------------------------------------------------------------------


def report(
    measurements: DataFrame,
    cells: DataFrame,
    by: Sequence[str] = BATCH,
    rules: Sequence[Rule] | None = None,
    scope: str = "valid",
    limits: Limits = Limits(),
    late_apart: bool = False,
    broadcast_stats: bool = False,
) -> DataFrame:
    """One row per batch: row counts, rule score, verdict.

    Copies share their six values and with them their verdict, so a batch has as many clean
    rows as plausible distinct measurements and the rows themselves are not needed again.
    With ``late_apart`` late rows are set aside before the verdict: clean and dirty rows
    then add up to the on-time rows instead of all rows.
    """
    rules = rules or default_rules(limits)
    judged = F.col("copies") - F.col("late") if late_apart else F.col("copies")
    rows = measurements.where(not_late()) if late_apart else measurements
    # The statistics take a second, narrow scan that shuffles one row per batch and cell.
    # Taken from the copies they would repeat the one wide shuffle of this plan.
    stats = distance_stats(with_distance(rows, cells), by, scope, limits)
    scored = with_stats(
        with_distance(copies(measurements, by), cells), stats, by, broadcast_stats
    )
    raw, late = F.sum("copies"), F.sum("late")
    clean = F.count_if(plausible(limits) & (judged > 0))
    counts = scored.groupBy(*by).agg(
        raw.alias("total_raw_records"),
        late.alias("late_count"),
        (raw - late).alias("on_time_count"),
        (raw - F.count(F.lit(1))).alias("duplicate_count"),
        clean.alias("clean_count"),
        (F.sum(judged) - clean).alias("dirty_count"),
        *_rule_sums(rules),
    )
    failed = sum((F.when(_passed(i, r), 0).otherwise(1) for i, r in enumerate(rules)), F.lit(0))
    total = len(rules)
    return counts.select(
        *by,
        "total_raw_records",
        "late_count",
        "on_time_count",
        "duplicate_count",
        "clean_count",
        "dirty_count",
        ((total - failed) * 100.0 / total).alias("success_rate"),
        F.lit(total).cast("bigint").alias("total_rules"),
        failed.cast("bigint").alias("failed_rules"),
        (failed == 0).alias("is_passed"),
    )


def failing(reports: DataFrame, threshold: float = Thresholds.gate_percent) -> DataFrame:
    """The batches that do not reach the gate."""
    return reports.where(F.col("success_rate") < threshold)


def partition_inventory(df: DataFrame, by: Sequence[str] = BATCH) -> DataFrame:
    """Rows per batch in one pass."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"))


def audit(reports: DataFrame, date: str, batch: Sequence[str] = BATCH) -> DataFrame:
    """The reports of one day by hour."""
    day, hour = batch
    return reports.where(F.col(day) == F.lit(date).cast("date")).orderBy(hour)
