"""Registered queries: a Spark callable and, where SQL can state it, an oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattmirror.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

# Calendar days are compared as text, because engines hand dates to Python as different types:
# date columns and the queries that return them.
DATES = {
    "local_day":
        "vw_04_energy_daily_spring vw_04_energy_daily_autumn vw_04a_expected_hours vw_04b_allocation_coverage",
    "bucket":
        "ch_12_power_chart_day_autumn ch_13_energy_daily_chart",
    "d0 d1":
        "ch_06_day_bounds",
    "day":
        "vw_07_daily_sleep vw_08_daily_readiness vw_09_daily_activity vw_10_sleep_periods vw_11_daily_stress "
        "vw_12_daily_spo2 vw_13_workouts vw_14_sessions syn_22_lift_daily_sleep syn_22_lift_sleep "
        "syn_22_lift_daily_spo2 syn_22_lift_workout syn_22_lift_session snk_02_device_upsert snk_05_adhoc "
        "st_12_schedule",
    "start_day end_day":
        "vw_15_tags syn_22_lift_enhanced_tag",
    "window_start window_end":
        "syn_20_next_window vw_17_sync_status",
}
DATE_COLUMNS = {name: columns.split() for columns, names in DATES.items() for name in names.split()}

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
# The same with calendar days as the operators return them; tests hold these against each other, types included.
TYPED_QUERIES: dict[str, Query] = {}
TYPED_ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under an operator id, with the DuckDB text it must equal."""
    if name in QUERIES:
        raise ValueError(f"query {name} registered twice")

    def register(fn: Query) -> Query:
        days = DATE_COLUMNS.get(name, [])
        TYPED_QUERIES[name] = lambda spark, sf_dir: fn(prepare(spark), sf_dir)
        QUERIES[name] = lambda spark, sf_dir: fn(prepare(spark), sf_dir).withColumns(
            {c: F.col(c).cast("string") for c in days})
        if sql is not None:
            TYPED_ORACLES[name] = sql.strip()
            text = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in days)
            ORACLES[name] = f"SELECT * REPLACE ({text}) FROM (\n{sql.strip()})" if days else sql.strip()
        return fn

    return register


def with_ctes(*ctes: str, select: str) -> str:
    return "WITH " + ",".join(c.strip() for c in ctes) + "\n" + select.strip()


def load_all() -> tuple[dict[str, Query], dict[str, str]]:
    from wattmirror.checks import (catalog_checks, chart_checks, device_checks, event_checks,  # noqa: F401
                                   flow_checks, mirror_checks, reporting_checks, stream_checks)
    return QUERIES, ORACLES
