"""Every registered query against its SQL on whole tables."""

import math
from pathlib import Path

import duckdb
import pytest

from wattfolio.checks.oracle import ORACLE
from wattfolio.checks.queries import QUERIES


@pytest.fixture(scope="session")
def duck(data):
    con = duckdb.connect()
    for file in Path(data).glob("*.parquet"):
        con.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def cell(x):
    if isinstance(x, float):
        return "null" if math.isnan(x) else repr(x + 0.0)
    return "null" if x is None else str(x)


def rows(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in records)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def compare(spark, duck, data, name):
    df = QUERIES[name](spark, data)
    relation = duck.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(relation.columns)
    got = rows(df.columns, df.collect())
    want = rows(relation.columns, relation.fetchall())
    assert len(got) > 0
    assert len(got) == len(want)
    different = [(g, w) for g, w in zip(got, want) if g != w]
    assert different[:3] == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, data, name):
    compare(spark, duck, data, name)


ZONED = [
    "calendar_keys", "weekly_sum", "rolling_median_dense", "storage_report", "weekly_generation_report",
    "gas_balance_report", "month_vs_average", "freshness_gate", "consumption_tables",
    "source_gas_flow_csv", "source_generation_xml", "source_grid_sheets", "source_storage_pages",
]


@pytest.mark.parametrize("name", ZONED)
def test_results_do_not_depend_on_the_session_zone(spark, duck, data, name):
    """A zone with clock changes at midnight."""
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        compare(spark, duck, data, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
