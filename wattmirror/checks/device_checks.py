"""Device ingest and views against their oracles; records are built per user and day."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from wattmirror.checks import model as m
from wattmirror.checks.registry import check, with_ctes
from wattmirror.operators import device_views as dv
from wattmirror.operators import merge
from wattmirror.plans.pinned import pin
from wattmirror.session import work_dir
from wattmirror.sources import device_pages as dp

TEXTS = {"type": "long_sleep", "day_summary": "normal", "intensity": "easy", "source": "manual",
         "mood": "good", "tag_type_code": "tag_generic", "custom_name": "nap", "comment": "none"}


def _paths():
    """Every record path a view reads, with its type, in a fixed order."""
    found = {}
    for columns in dv.VIEWS.values():
        for _, source, type_ in columns:
            if source.startswith("$.") and source[2:] not in found:
                found[source[2:]] = type_
    return found


def _int_no(path):
    return list(_paths()).index(path) + 2


def _base(spark, sf_dir):
    value = F.col("value").cast("decimal(18,2)")
    return (m.events(spark, sf_dir).select("entity_id", F.to_date("ts").alias("day"), value.alias("v"))
             .groupBy("entity_id", "day").agg(F.count(F.lit(1)).alias("n"), F.min("v").cast("double").alias("mn"),
                                              F.max("v").cast("double").alias("mx")))


BASE_SQL = """
b AS (SELECT user_id AS entity_id, CAST(ts AS DATE) AS day, count(*) AS n, CAST(min(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS mn,
  CAST(max(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS mx FROM events GROUP BY 1, 2)"""


def _leaf(path, type_):
    n, who = F.col("n"), F.col("entity_id")
    if type_ == "string":
        return F.when(n % 3 != 0, F.concat(F.lit(TEXTS[path] + " "), who.cast("string")))
    if type_ == "double":
        return F.when(n % 4 != 0, F.col("mn") + F.lit(_int_no(path)))
    return F.when(n % 5 != 0, (n * _int_no(path) + who) % 100)


def _leaf_sql(path, type_):
    if type_ == "string":
        return f"CASE WHEN n % 3 <> 0 THEN '{TEXTS[path]} ' || entity_id END"
    if type_ == "double":
        return f"CASE WHEN n % 4 <> 0 THEN mn + {_int_no(path)} END"
    return f"CAST(CASE WHEN n % 5 <> 0 THEN (n * {_int_no(path)} + entity_id) % 100 END AS INTEGER)"


def records(spark, sf_dir):
    """One JSON record per user and day holding every field any endpoint has."""
    at = lambda hours: F.date_format(F.col("day").cast("timestamp") + F.make_dt_interval(hours=F.lit(hours)),
                                     "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    fields = {"id": F.concat_ws("-", F.col("entity_id").cast("string"), F.col("day").cast("string")),
              "day": F.col("day").cast("string"), "score": F.col("n") + 50,
              "activity": F.concat(F.lit("walk "), F.col("n").cast("string")),
              "bedtime_start": at(22), "bedtime_end": at(30), "total_sleep_duration": F.col("n") * 60,
              "timestamp": at(12), "bpm": F.col("n") + 60, "start_datetime": at(8), "end_datetime": at(9),
              "start_day": F.col("day").cast("string"),
              "end_day": F.when(F.col("n") % 2 == 0, F.date_add("day", 2).cast("string"))}
    nested = {}
    for path, type_ in _paths().items():
        head, _, leaf = path.partition(".")
        if leaf:
            nested.setdefault(head, []).append(_leaf(path, type_).alias(leaf))
        else:
            fields[head] = _leaf(path, type_)
    fields["type"] = F.coalesce(fields["type"], F.lit("rest"))
    fields["source"] = F.concat(F.lit("s"), F.col("entity_id").cast("string"))
    for head, leaves in nested.items():
        struct = F.struct(*leaves)
        fields[head] = F.when(F.col("n") % 7 != 0, struct) if head == "spo2_percentage" else struct
    return _base(spark, sf_dir).select("entity_id", "day", F.to_json(F.struct(
        *[c.alias(n) for n, c in fields.items()])).alias("data"))


def table(spark, sf_dir, endpoint):
    return dp.lift_fields(records(spark, sf_dir).select("data"), endpoint)


STORED_SQL = {
    "id": "entity_id || '-' || day", "day": "day", "score": "CAST(n + 50 AS INTEGER)",
    "bedtime_start": "CAST(day AS TIMESTAMP) + INTERVAL 22 HOUR", "bedtime_end": "CAST(day AS TIMESTAMP) + INTERVAL 30 HOUR",
    "total_sleep_duration": "CAST(n * 60 AS INTEGER)", "timestamp": "CAST(day AS TIMESTAMP) + INTERVAL 12 HOUR", "source": "'s' || entity_id",
    "bpm": "CAST(n + 60 AS INTEGER)", "activity": "'walk ' || n",
    "start_datetime": "CAST(day AS TIMESTAMP) + INTERVAL 8 HOUR", "end_datetime": "CAST(day AS TIMESTAMP) + INTERVAL 9 HOUR",
    "session_type": f"coalesce({_leaf_sql('type', 'string')}, 'rest')", "start_day": "day",
    "end_day": "CASE WHEN n % 2 = 0 THEN day + 2 END"}


def _sql_of(source, type_):
    if not source.startswith("$."):
        return STORED_SQL[source]
    path = source[2:]
    if path == "type":
        return STORED_SQL["session_type"]
    if path == "source":
        return STORED_SQL["source"]
    if path.startswith("spo2_percentage."):
        return f"CASE WHEN n % 7 <> 0 THEN {_leaf_sql(path, type_)} END"
    return _leaf_sql(path, type_)


def _view_sql(view):
    cols = ", ".join(f"{_sql_of(source, type_)} AS \"{name}\"" for name, source, type_ in dv.VIEWS[view])
    return with_ctes(BASE_SQL, select=f"SELECT {cols} FROM b")


VIEW_ENDPOINT = {"daily_sleep": "daily_sleep", "daily_readiness": "daily_readiness", "daily_activity": "daily_activity",
                 "sleep_periods": "sleep", "daily_stress": "daily_stress", "daily_spo2": "daily_spo2",
                 "workouts": "workout", "sessions": "session", "tags": "enhanced_tag", "heart_rate": "heartrate"}


def _register_views():
    for number, view in enumerate(dv.VIEWS, start=7):
        def query(spark, sf_dir, view=view):
            return dv.device_view(table(spark, sf_dir, VIEW_ENDPOINT[view]), view)
        check(f"vw_{number:02d}_{view}", _view_sql(view))(query)


_register_views()


LIFTED_SQL = {name: ", ".join(
    f"CASE WHEN n % 7 <> 0 THEN {_leaf_sql('spo2_percentage.average', 'double')} END AS spo2_percentage"
    if col == "spo2_percentage" else f"{_leaf_sql('calories', 'double')} AS calories"
    if col == "calories" else f'{STORED_SQL[col]} AS "{col}"' for col, _, _ in lifted)
    for name, (_, lifted) in dp.ENDPOINTS.items()}


def _register_lifts():
    for endpoint in ("daily_sleep", "sleep", "daily_spo2", "heartrate", "workout", "session", "enhanced_tag"):
        def query(spark, sf_dir, endpoint=endpoint):
            out = table(spark, sf_dir, endpoint)
            return out.drop("data")
        check(f"syn_22_lift_{endpoint}", with_ctes(BASE_SQL, select=f"SELECT {LIFTED_SQL[endpoint]} FROM b"))(query)


_register_lifts()


def land_pages(spark, sf_dir):
    """Write the records as API pages, one envelope per user and week, and return the folder.

    A page holds at most the seven days of its week, whatever the number of events.
    """
    path = f"{work_dir(spark)}/pages-{uuid.uuid4().hex}"
    page = F.concat(F.lit('{"data":['), F.array_join(F.collect_list("data"), ","), F.lit('],"next_token":'),
                    F.when(F.max("entity_id") % 2 == 0, F.lit("null")).otherwise(F.lit('"more"')), F.lit("}"))
    (records(spark, sf_dir).groupBy("entity_id", F.date_trunc("week", "day").alias("w"))
        .agg(page.alias("value")).select("value").write.text(path))
    return path


@check("src_06_unnest_pages", with_ctes(BASE_SQL, select="SELECT entity_id || '-' || day AS id, CAST(n + 50 AS INTEGER) AS score FROM b"))
def pages(spark, sf_dir):
    rows = dp.unnest_pages(dp.read_pages(spark, land_pages(spark, sf_dir)))
    return dp.lift_fields(rows, "daily_sleep").select("id", "score")


@check("snk_02_device_upsert", with_ctes(BASE_SQL, select="""
SELECT entity_id || '-' || day AS id, day, CAST(CASE WHEN day >= DATE '2024-01-15' THEN n + 50 ELSE 0 END AS INTEGER) AS score,
  CASE WHEN day >= DATE '2024-01-15' THEN TIMESTAMP '2024-02-01' ELSE TIMESTAMP '2024-01-15' END AS synced_at FROM b"""))
def device_upsert(spark, sf_dir):
    """A window fetched twice: the later arrival of a record wins over the earlier and the stored one."""
    now = pin(table(spark, sf_dir, "daily_sleep"))
    stale = now.withColumn("score", F.lit(0))
    stored = stale.withColumn("synced_at", F.lit("2024-01-15").cast("timestamp"))
    fetched = now.where("day >= DATE '2024-01-15'").withColumn("page", F.lit(2)).unionByName(
        stale.where("day >= DATE '2024-01-15'").withColumn("page", F.lit(1)))
    out = merge.upsert_latest(stored, fetched, dp.table_key("daily_sleep"), ["page"], F.lit("2024-02-01").cast("timestamp"))
    return out.select("id", "day", "score", "synced_at")


@check("snk_05_adhoc", with_ctes(BASE_SQL, select="""
SELECT day, count(*) AS people, CAST(sum(n + 50) AS BIGINT) AS total_score, count(*) FILTER (WHERE n % 5 <> 0) AS timed
FROM b GROUP BY day"""))
def adhoc(spark, sf_dir):
    dv.device_view(table(spark, sf_dir, "daily_sleep"), "daily_sleep").createOrReplaceTempView("reporting_daily_sleep")
    return dv.adhoc(spark, """WITH d AS (SELECT * FROM reporting_daily_sleep)
        SELECT day, count(*) AS people, CAST(sum(score) AS BIGINT) AS total_score, count(timing_score) AS timed
        FROM d GROUP BY day""")
