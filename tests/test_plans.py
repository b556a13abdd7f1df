"""Physical plans: what reaches the scan, what shuffles, what is broadcast."""

from __future__ import annotations

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from signalgrid.operators import facts, late, lookups, quality, serving
from signalgrid.plans.derived import GRID, Tables
from signalgrid.plans.registry import QUERIES
from signalgrid.sources import tables as tb

SF = "/root/testdata/sf0.001"
STREAMS = {"stream_fact_hourly", "stream_dedup", "stream_late_repair", "landing_stream"}
# Queries that write a table and read it again.
WRITERS = {
    "replace_partitions", "csv_measurements", "csv_cells", "compacted_write", "truncate_table",
    "register_table", "upsert_stored_cells", "forecast_store", "p10_daily_from_hours",
    "compacted_by_size", "csv_rejected", "distance_stats_merged", "fact_by_delta",
    "next_hour_bucketed", "serving_filter_clustered",
}


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def tree(df) -> str:
    return plan(df).split("\n\n\n")[0]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Measurements and facts as partitioned tables."""
    t = Tables(spark, SF)
    root = tmp_path_factory.mktemp("stored")
    tb.write_table(t.measurements, f"{root}/mdt", ["event_date", "event_hour"])
    tb.write_table(t.cells, f"{root}/cells")
    read = {name: tb.read_table(spark, f"{root}/{name}") for name in ("mdt", "cells")}
    tb.write_table(
        facts.hourly(read["mdt"], read["cells"], GRID), f"{root}/fact", ["event_date", "event_hour"]
    )
    return read | {"fact": tb.read_table(spark, f"{root}/fact")}


def test_fact_is_one_shuffle_without_python(stored):
    df = facts.hourly(stored["mdt"], stored["cells"], GRID)
    text = plan(df)
    assert "Python" not in text and "Pandas" not in text
    assert "BroadcastHashJoin" in text
    assert len(re.findall(r"\bExchange\b \(", tree(df))) == 1
    columns = re.search(r"Location.*?/mdt.*?ReadSchema: struct<(.*?)>", text, re.S).group(1)
    assert {c.split(":")[0] for c in columns.split(",")} == {
        "lat", "lng", "cell_code", "p_cell_rsrp",
    }


def test_partitions_are_pruned(stored):
    hour = tb.read_partition(stored["mdt"], event_date="2024-01-24", event_hour=3)
    text = plan(facts.hourly(hour, stored["cells"], GRID))
    filters = re.search(r"PartitionFilters: \[(.*)\]", text).group(1)
    assert "event_date" in filters and "event_hour" in filters
    day = plan(serving.health_status(stored["fact"], "2024-01-24"))
    assert "event_date" in re.search(r"PartitionFilters: \[(.*)\]", day).group(1)


def test_late_merge_prunes_at_run_time(stored):
    rows = stored["mdt"].where("event_id < 3")
    text = plan(late.in_partitions(stored["mdt"], late.affected_partitions(rows)))
    assert "dynamicpruning" in text


def test_filters_reach_the_file(stored):
    text = plan(serving.serving_filter(stored["fact"], cell_id="CCLICK", below_rsrp=-120.0))
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    assert "EqualTo(cell_id,CCLICK)" in pushed and "LessThan(avg_rsrp,-120.0)" in pushed


def test_big_lookup_is_shuffled(stored):
    small = facts.hourly(stored["mdt"], lookups.sized(stored["cells"]), GRID)
    big = facts.hourly(stored["mdt"], lookups.sized(stored["cells"], 1), GRID)
    assert "SortMergeJoin" in plan(big) and "BroadcastHashJoin" not in plan(big)
    assert "SortMergeJoin" not in plan(small)
    assert big.exceptAll(small).count() + small.exceptAll(big).count() == 0


def test_scorecard_shuffles_rows_once(stored):
    text = tree(quality.scorecard(stored["mdt"]))
    assert len(re.findall(r"\bExchange\b \(", text)) == 2  # copies, then batches


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    if name not in ("forecast_fourier", "forecast_changepoints"):
        assert "Python" not in text and "InPandas" not in text


def test_no_job_runs_while_a_plan_is_built(spark):
    context = spark.sparkContext
    for name in sorted(set(QUERIES) - STREAMS - WRITERS):
        context.setJobGroup(f"building {name}", name)
        QUERIES[name](spark, SF)
        assert not context.statusTracker().getJobIdsForGroup(f"building {name}"), name
    context.setLocalProperty("spark.jobGroup.id", None)


def test_copies_of_one_measurement_are_spread_however_the_cells_are_joined(spark):
    """First copies are settled by input partition, before the join by cell."""
    t = Tables(spark, SF)
    one = t.measurements.limit(1)
    many = one.crossJoin(spark.range(20_000, numPartitions=16).drop("id"))
    for hint in ("broadcast", "merge"):
        rated = quality.classify(many, t.cells.hint(hint))
        assert rated.where("is_first_copy").count() == 1 and rated.count() == 20_000
        # In the plan, printed from the top, the windows stand below the join with the cells.
        nodes = re.findall(r"\b(Window|SortMergeJoin|BroadcastHashJoin)\b", tree(rated))
        assert nodes[-1] == "Window" or nodes.index("Window") > 0, nodes


def test_hex_conditions_stop_at_the_grid(spark):
    """A condition on the hexagon does not pull the arithmetic into a filter."""
    t = Tables(spark, SF)
    text = plan(t.facts.where(F.col("hex_id").isNotNull()))
    conditions = re.findall(r"Condition : (.*)", text)
    assert all("ROUND" not in c.upper() for c in conditions)
