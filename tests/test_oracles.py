"""Every people-flow query against its SQL, on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from tidewalk.plans import registry


def same_rows(spark, sf_dir: str, query, sql: str) -> None:
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.execute(f"create view {f.split('.')[0]} as select * from '{sf_dir}/{f}'")
    got, want = query(spark, sf_dir).toPandas(), con.sql(sql).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)

    def rows(frame):
        return sorted(map(repr, frame[columns].astype(object).where(frame[columns].notna(), None).itertuples(index=False, name=None)))

    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query(spark, sf_dir, name):
    same_rows(spark, sf_dir, registry.QUERIES[name], registry.ORACLES[name])


def test_tracks_without_sql(spark, sf_dir):
    assert registry.QUERIES["byte_track"](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
