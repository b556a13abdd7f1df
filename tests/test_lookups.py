from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from signalgrid.operators.lookups import (
    first_per_key,
    fits,
    flag_first,
    lookup_join,
    maybe_copied,
    newest_per_key,
    sized,
)


def skewed_rows(n=3000, seed=5):
    """A third of all rows share one key; some rows are equal in every column."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = None if i % 11 == 0 else "hot" if rng.random() < 0.33 else f"k{rng.randrange(600)}"
        rows.append((key, rng.choice([1.5, None]), rng.randrange(50), rng.choice("xyz")))
    return rows + rows[: n // 10]


SCHEMA = "k string, lat double, ts int, other string"


def rank(value):
    return (value is not None, value if value is not None else 0)


@pytest.mark.parametrize("partitions, bits", [(1, 1 << 16), (7, 1 << 16), (7, 64)])
def test_flag_first_against_brute_force(spark, partitions, bits):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    flagged = flag_first(df, ["k", "lat"], ["ts"], bits=bits).collect()
    assert Counter((r.k, r.lat, r.ts, r.other) for r in flagged) == Counter(rows)
    groups = defaultdict(list)
    for row in rows:
        groups[row[:2]].append(row)
    firsts = Counter((r.k, r.lat, r.ts, r.other) for r in flagged if r.is_first_copy)
    assert firsts == Counter(min(g, key=lambda r: r[2:]) for g in groups.values())


def test_flag_first_spreads_a_hot_key(spark):
    """All rows share one key; the tasks after each shuffle still get about equal shares."""
    df = spark.range(0, 80000, 1, 64).select(F.lit("hot").alias("k"), "id")
    flagged = flag_first(df, ["k"], ["id"])
    firsts = flagged.where("is_first_copy").collect()
    assert [r.id for r in firsts] == [0]
    shares = flagged.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(r["count"] for r in shares) == 80000
    assert max(r["count"] for r in shares) < 80000 / 2


def test_rows_that_have_no_copy_are_never_shuffled(spark):
    wide = spark.range(0, 50_000, 1, 8).select(
        (F.col("id") % 49_000).alias("k"), "id", F.lpad(F.col("id").cast("string"), 200, "x").alias("text")
    )
    through = {row.k for row in wide.where(maybe_copied(wide, ["k"])).collect()}
    assert set(range(1000)) <= through and len(through) < 1100
    flagged = flag_first(wide, ["k"], ["id"])
    assert flagged.count() == 50_000
    assert flagged.where("is_first_copy").count() == 49_000 and flagged.where("is_first_copy AND id >= 49000").isEmpty()
    tree = flagged._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    # Wide rows are dealt out below the bitmap's filter only: those that passed, once by key and
    # input partition and once by key.
    nodes = re.split(r"\n\n\(\d+\) ", tree)
    dealt = [node for node in nodes if node.startswith("Exchange") and "text" in node.split("Arguments")[0]]
    assert 1 <= len(dealt) <= 2
    main = tree.split("===== Subqueries =====")[0]
    assert main.index("Union") < main.index("Window") < main.index("Exchange")
    narrow = tree.split("===== Subqueries =====")[1]
    assert "Exchange" in narrow and "text#" not in narrow


def test_one_per_key(spark):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    order = lambda r: (r[2], rank(r[1]), r[3])
    newest = {tuple(r) for r in newest_per_key(df, ["k"], ["ts"]).collect()}
    assert newest == {max(g, key=order) for g in groups.values()}
    first = {tuple(r) for r in first_per_key(df, ["k"], ["ts"]).collect()}
    assert first == {min(g, key=order) for g in groups.values()}
    assert newest_per_key(df.select("k"), ["k"]).count() == len(groups)


def test_lookup_join_with_and_without_broadcast(spark):
    left = spark.createDataFrame(skewed_rows(), SCHEMA)
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("unused", 3)], "k string, v int")
    assert fits(right, 3) and not fits(right, 2)
    small = lookup_join(left, sized(right, 3), ["k"])
    large = lookup_join(left, sized(right, 2), ["k"])
    assert Counter(map(tuple, small.collect())) == Counter(map(tuple, large.collect()))
    assert small.count() == left.count()
