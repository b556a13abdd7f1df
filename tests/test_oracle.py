"""Every registered query against its SQL on an independent engine, value by value."""

from __future__ import annotations

import datetime as dt
import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_points
from signalgrid.plans.oracle import STATEMENTS
from signalgrid.plans.registry import QUERIES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    connection.execute(
        f"CREATE VIEW events AS SELECT * FROM read_parquet('{FOLDER}/events.parquet')"
    )
    return connection


def comparable(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return (type(value).__name__, str(value))
    if isinstance(value, float):
        if math.isnan(value):
            return ("float", "nan")
        return ("float", repr(value + 0.0))
    if isinstance(value, int):
        return ("int", str(value))
    assert not isinstance(value, dt.date), "dates leave as text"
    raise AssertionError(f"unexpected type {type(value)}")


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [tuple(comparable(row[i]) for i in order) for row in rows]


def test_names():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(QUERIES) == set(STATEMENTS)


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_matches_sql(name, spark, oracle):
    df = QUERIES[name](spark, FOLDER)
    got = table(df.columns, df.collect())
    cursor = oracle.execute(STATEMENTS[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    want = table(names, cursor.fetchall())
    assert len(got) == len(want)
    assert len(want) > 0
    extra, missing = Counter(got) - Counter(want), Counter(want) - Counter(got)
    if extra or missing:
        lines = [sorted(df.columns), sum(extra.values())]
        lines += [("got", *sorted(extra)[:3]), ("want", *sorted(missing)[:3])]
        pytest.fail("\n".join(map(str, lines)), pytrace=False)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
