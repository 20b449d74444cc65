"""Every query against its SQL twin."""

from __future__ import annotations

import math
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

from freshet.plans.oracle import ORACLE_SQL
from freshet.plans.queries import QUERIES


@pytest.fixture(scope="module")
def db(medium):
    con = duckdb.connect()
    for file in sorted(Path(medium).glob("*.parquet")):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return (value is not None, value)


def _rows(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(_plain(r[i]) for i in order) for r in rows], key=repr)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, db, medium, name):
    frame = QUERIES[name](spark, medium)
    got = frame.collect()
    cursor = db.execute(ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    assert sorted(frame.columns) == sorted(names)
    assert not any(isinstance(v, Decimal) for r in expected for v in r), "twin returns decimals"
    assert len(got) == len(expected)
    ours, theirs = _rows(got, frame.columns), _rows(expected, names)
    different = [(a, b) for a, b in zip(ours, theirs) if a != b]
    assert not different, different[:3]
    assert expected, "an empty result proves nothing"
