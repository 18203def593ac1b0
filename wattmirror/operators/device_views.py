"""Projection views over the device tables, and the capped ad-hoc query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wattmirror.functions.records import project


# View columns as (name, source, type). A source starting with "$." is a path
# into the raw record, anything else a stored column.
def _scores(names: str, type_: str = "int") -> list[tuple[str, str, str]]:
    return [(f"{n}_score", f"$.contributors.{n}", type_) for n in names.split()]


def _same(names: str, type_: str = "int") -> list[tuple[str, str, str]]:
    return [(n, f"$.{n}", type_) for n in names.split()]


def _stored(*names: str) -> list[tuple[str, str, str | None]]:
    return [(n, n, None) for n in names]


VIEWS: dict[str, list[tuple[str, str, str | None]]] = {
    "daily_sleep": [*_stored("day", "score"),
                    *_scores("timing latency rem_sleep deep_sleep efficiency restfulness total_sleep")],
    "daily_readiness": [*_stored("day", "score"),
                        *_scores("hrv_balance sleep_balance previous_night recovery_index activity_balance "
                                 "body_temperature sleep_regularity resting_heart_rate previous_day_activity"),
                        *_same("temperature_deviation temperature_trend_deviation", "double")],
    "daily_activity": [*_stored("day", "score"),
                       *_same("steps active_calories total_calories target_calories"),
                       *_same("average_met_minutes", "double"),
                       *[(f"{n}_seconds", f"$.{n}", "int") for n in
                         "high_activity_time medium_activity_time low_activity_time sedentary_time resting_time".split()],
                       ("equivalent_walking_distance_meters", "$.equivalent_walking_distance", "int"),
                       ("meters_to_target", "$.meters_to_target", "int")],
    "sleep_periods": [*_stored("id", "day"), ("sleep_type", "$.type", "string"),
                      *_stored("bedtime_start", "bedtime_end"),
                      ("time_in_bed_seconds", "$.time_in_bed", "int"),
                      ("total_sleep_duration_seconds", "total_sleep_duration", None),
                      *_same("efficiency average_hrv"), *_same("average_heart_rate", "double"),
                      *_same("lowest_heart_rate"), *_same("average_breath", "double"),
                      *[(f"{n}_seconds", f"$.{n}", "int") for n in
                        "rem_sleep_duration deep_sleep_duration light_sleep_duration awake_time".split()],
                      *_same("restless_periods"), ("readiness_score", "$.readiness.score", "int")],
    "daily_stress": [*_stored("day"), ("day_summary", "$.day_summary", "string"),
                     ("stress_high_seconds", "$.stress_high", "int"),
                     ("recovery_high_seconds", "$.recovery_high", "int")],
    "daily_spo2": [*_stored("day"), ("spo2_percentage_average", "$.spo2_percentage.average", "double"),
                   ("breathing_disturbance_index", "$.breathing_disturbance_index", "int")],
    "workouts": [*_stored("id", "day", "activity"), *_same("intensity source", "string"),
                 ("calories", "$.calories", "double"), ("distance_meters", "$.distance", "double"),
                 *_stored("start_datetime", "end_datetime")],
    "sessions": [*_stored("id", "day", "session_type"), ("mood", "$.mood", "string"),
                 *_stored("start_datetime", "end_datetime")],
    "tags": [*_stored("id", "start_day", "end_day"), *_same("tag_type_code custom_name comment", "string")],
    "heart_rate": _stored("timestamp", "source", "bpm"),
}
ROW_LIMIT, ROW_LIMIT_MAX = 500, 5000


def device_view(table: DataFrame, view: str, lenient: bool = False) -> DataFrame:
    """One of the projection views. Casts are strict; ``lenient`` turns bad values into NULL."""
    return project(table, VIEWS[view], lenient)


def adhoc(spark: SparkSession, sql: str, row_limit: int = ROW_LIMIT, mark: str | None = None) -> DataFrame:
    """A read-only query over the registered views, capped to a row limit of 1..5000.

    ``mark`` names a column that is true on every row if the query has more rows than are returned. To know that, one
    row more than the limit is read.
    """
    head = sql.strip().lstrip("(").strip().upper()
    if not head.startswith(("SELECT", "WITH")):
        raise ValueError("only SELECT and WITH statements are allowed")
    limit = max(1, min(row_limit, ROW_LIMIT_MAX))
    if mark is None:
        return spark.sql(f"SELECT * FROM ({sql}) AS q LIMIT {limit}")
    return spark.sql(f"""SELECT *, count(*) OVER () > {limit} AS `{mark}`
                         FROM (SELECT * FROM ({sql}) AS q LIMIT {limit + 1}) AS r""").limit(limit)
