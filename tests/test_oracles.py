"""Every registered query against its DuckDB text on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry_point
from tools.compare import TABLES, canon
from wattmirror.checks import registry

SF_DIR = "/root/testdata/sf0.001"
registry.load_all()
QUERIES, ORACLES = registry.TYPED_QUERIES, registry.TYPED_ORACLES


@pytest.fixture(scope="module")
def con():
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return db


def compare(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    if name in ORACLES:
        cursor = con.execute(ORACLES[name])
        columns = [d[0] for d in cursor.description]
        assert got == canon(columns, cursor.fetchall())
    else:
        assert got[1]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, con, name):
    compare(spark, con, name)


SPLIT = ["vw_03_energy", "cat_03_validate_periods", "cat_04_overlapping_periods", "syn_07_cadence_decision",
         "st_01_transitions", "st_04_held_for", "st_06_suppress_active", "st_08_asof_state",
         "st_16_hold_over_intervals", "st_17_departures", "fl_05_allocate_stars"]


@pytest.mark.parametrize("name", SPLIT)
def test_query_equals_oracle_when_keys_are_split(spark, con, tiny_spans, name):
    compare(spark, con, name)


@pytest.mark.parametrize("name", sorted(registry.DATE_COLUMNS))
def test_days_are_dates(spark, name):
    kinds = dict(QUERIES[name](spark, SF_DIR).dtypes)
    assert {c: kinds[c] for c in registry.DATE_COLUMNS[name]} == dict.fromkeys(registry.DATE_COLUMNS[name], "date")


def test_everything_is_registered():
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLES) <= set(entry_point.oracle_sql())


def test_entry_runs(spark):
    assert entry_point.entry(spark).count() > 0
