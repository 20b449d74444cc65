"""Queries against their SQL twins."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from freshet.llm.oracle import ORACLE_SQL
from freshet.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows_as_sql(spark, medium, name):
    db = duckdb.connect()
    for file in sorted(Path(medium).glob("*.parquet")):
        db.execute(f"create view {file.stem} as select * from '{file}'")
    frame = QUERIES[name](spark, medium)
    cursor = db.execute(ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(frame.columns)
    expected = sorted(map(str, cursor.fetchall()))
    assert expected and sorted(str(tuple(r)) for r in frame.select(names).collect()) == expected
