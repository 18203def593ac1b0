"""Chart operators against their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattmirror.checks import model as m
from wattmirror.checks import reporting_checks as r
from wattmirror.checks.registry import check, with_ctes
from wattmirror.functions.timecols import bucket_label, instant, local_bin
from wattmirror.operators import charts as ch
from wattmirror.operators import energy as e
from wattmirror.operators import measures

LA = "America/Los_Angeles"
# Both ranges cover the whole shifted history and start and end off the bucket grid.
SPRING = ("2024-02-29 16:30:00", "2024-04-02 03:30:00")
AUTUMN = ("2024-10-18 16:30:00", "2024-11-21 03:30:00")
IDS_SQL = "ids AS (SELECT statistic_id, display_name FROM status WHERE category IN ({cats}) {active})"
LOCAL = "timezone('America/Los_Angeles', timezone('UTC', {x}))"
ORIGIN = "TIMESTAMP '2000-01-01 00:00:00'"


def wall(expr):
    return LOCAL.format(x=expr)


def bounds(span):
    return instant(span[0]), instant(span[1])


def views_sql(shift):
    return f"""
temp AS (
  SELECT s.statistic_id, start_at,
    CASE WHEN unit_of_measurement = '°F' THEN (mean - 32) * 5.0 / 9.0 ELSE mean END AS mean_v,
    CASE WHEN unit_of_measurement = '°F' THEN (min - 32) * 5.0 / 9.0 ELSE min END AS min_v,
    CASE WHEN unit_of_measurement = '°F' THEN (max - 32) * 5.0 / 9.0 ELSE max END AS max_v
  FROM stat s JOIN cat c ON c.statistic_id = s.statistic_id
  WHERE category IN ('environmental_temperature', 'machine_temperature')),
pow AS (
  SELECT s.statistic_id, start_at, mean AS mean_v, min AS min_v, max AS max_v
  FROM stat s JOIN cat c ON c.statistic_id = s.statistic_id WHERE category = 'device_power')"""


def agg_sql(view, span, bucket):
    if bucket == "day":
        return f"""
agg AS (
  SELECT v.statistic_id, CAST({wall('start_at')} AS DATE) AS bucket,
    avg(mean_v) AS mean, min(min_v) AS min, max(max_v) AS max
  FROM {view} v
  WHERE CAST({wall('start_at')} AS DATE) >= CAST({wall(f"TIMESTAMP '{span[0]}'")} AS DATE)
    AND CAST({wall('start_at')} AS DATE) < CAST({wall(f"TIMESTAMP '{span[1]}'")} AS DATE)
  GROUP BY 1, 2)"""
    step = f"INTERVAL {ch.BUCKET_SECONDS[bucket]} SECOND"
    return f"""
agg AS (
  SELECT v.statistic_id, time_bucket({step}, {wall('start_at')}, {ORIGIN}) AS bucket,
    avg(mean_v) AS mean, min(min_v) AS min, max(max_v) AS max
  FROM {view} v WHERE start_at >= TIMESTAMP '{span[0]}' AND start_at < TIMESTAMP '{span[1]}'
  GROUP BY 1, 2)"""


def series_sql(span, bucket):
    if bucket == "day":
        return f"""
series AS (
  SELECT CAST(g AS DATE) AS bucket FROM generate_series(
    CAST({wall(f"TIMESTAMP '{span[0]}'")} AS DATE)::TIMESTAMP,
    (CAST({wall(f"TIMESTAMP '{span[1]}'")} AS DATE) - 1)::TIMESTAMP, INTERVAL 1 DAY) t(g))"""
    step = f"INTERVAL {ch.BUCKET_SECONDS[bucket]} SECOND"
    return f"""
series AS (
  SELECT g AS bucket FROM generate_series(
    time_bucket({step}, {wall(f"TIMESTAMP '{span[0]}'")}, {ORIGIN}),
    time_bucket({step}, {wall(f"(TIMESTAMP '{span[1]}' - INTERVAL 1 MICROSECOND)")}, {ORIGIN}), {step}) t(g))"""


# Wall clock to instant; a repeated hour means its first occurrence.
INSTANT_SQL = f"""(CASE WHEN timezone('{LA}', timezone('{LA}', {{b}}) - INTERVAL 1 HOUR) = {{b}}
  THEN timezone('{LA}', {{b}}) - INTERVAL 1 HOUR ELSE timezone('{LA}', {{b}}) END)"""
OFFSET_SQL = f"CAST(epoch({{b}}) - epoch({INSTANT_SQL}) AS BIGINT)"
LABEL_SQL = f"""strftime({{b}}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN {OFFSET_SQL} < 0 THEN '-' ELSE '+' END ||
  lpad(CAST(abs({OFFSET_SQL}) // 3600 AS VARCHAR), 2, '0') || ':' ||
  lpad(CAST(abs({OFFSET_SQL}) % 3600 // 60 AS VARCHAR), 2, '0')"""


def status_of(spark, sf_dir):
    return r.source_status(spark, sf_dir)


def rounded(df):
    return df.withColumns({c: F.round(c, 6) for c in ("mean", "min", "max")})


FILLED = """SELECT i.statistic_id, s.bucket, round(a.mean, 6) AS mean, round(a.min, 6) AS min,
  round(a.max, 6) AS max, {label} AS label
FROM series s CROSS JOIN ids i LEFT JOIN agg a ON a.statistic_id = i.statistic_id AND a.bucket = s.bucket"""


def chart_sql(view, cats, shift, span, bucket, active="AND is_active"):
    label = "CAST(s.bucket AS VARCHAR)" if bucket == "day" else LABEL_SQL.format(b="s.bucket")
    return with_ctes(m.statistic_sql(shift), m.CATALOG_SQL, m.RUNS_SQL, r.STATUS_SQL, views_sql(shift),
                     IDS_SQL.format(cats=cats, active=active), agg_sql(view, span, bucket),
                     series_sql(span, bucket), select=FILLED.format(label=label))


TEMPS = "'environmental_temperature', 'machine_temperature'"


def temperature_chart(spark, sf_dir, shift, span, bucket):
    stat, cat = m.statistic(spark, sf_dir, shift), m.catalog(spark, sf_dir)
    status = measures.v_source_status(cat, stat, m.runs(spark, sf_dir), instant(m.NOW))
    return ch.chart_measure(measures.v_temperature(stat, cat), status, measures.TEMPERATURE_CATEGORIES,
                            *bounds(span), bucket, include_inactive=True)


def power_chart(spark, sf_dir, shift, span, bucket):
    stat, cat = m.statistic(spark, sf_dir, shift), m.catalog(spark, sf_dir)
    status = measures.v_source_status(cat, stat, m.runs(spark, sf_dir), instant(m.NOW))
    return ch.chart_measure(measures.v_power(stat, cat), status, [measures.POWER_CATEGORY],
                            *bounds(span), bucket)


@check("ch_12_temperature_chart_6hour_spring", chart_sql("temp", TEMPS, r.SPRING, SPRING, "6hour", ""))
def chart_6hour(spark, sf_dir):
    return rounded(temperature_chart(spark, sf_dir, r.SPRING, SPRING, "6hour"))


@check("ch_12_temperature_chart_hour_autumn", chart_sql("temp", TEMPS, r.AUTUMN, AUTUMN, "hour", ""))
def chart_hour(spark, sf_dir):
    return rounded(temperature_chart(spark, sf_dir, r.AUTUMN, AUTUMN, "hour"))


@check("ch_12_power_chart_2hour_spring", chart_sql("pow", "'device_power'", r.SPRING, SPRING, "2hour"))
def chart_2hour(spark, sf_dir):
    return rounded(power_chart(spark, sf_dir, r.SPRING, SPRING, "2hour"))


@check("ch_12_power_chart_day_autumn", chart_sql("pow", "'device_power'", r.AUTUMN, AUTUMN, "day"))
def chart_day(spark, sf_dir):
    return rounded(power_chart(spark, sf_dir, r.AUTUMN, AUTUMN, "day"))


# Requests derived from the orders: two days and a bit after each order date.
REQUESTS_SQL = """
req AS (SELECT o_orderkey AS id, o_orderdate + to_minutes(o_orderkey % 1440) AS s,
               o_orderdate + to_minutes(o_orderkey % 1440) + to_minutes(o_custkey * 7 % 5000) AS e FROM orders)"""


def requests(spark, sf_dir):
    minute = lambda c: F.make_dt_interval(mins=c.cast("int"))
    start = F.col("o_orderdate").cast("timestamp") + minute(F.col("o_orderkey") % 1440)
    return m.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), start.alias("start"),
        (start + minute(F.col("o_custkey") * 7 % 5000)).alias("end"))


COUNT_SQL = ", ".join(
    f"""greatest(0, epoch_us(time_bucket(INTERVAL {s} SECOND, {wall('e - INTERVAL 1 MICROSECOND')}, {ORIGIN}))
     // {s}000000 - epoch_us(time_bucket(INTERVAL {s} SECOND, {wall('s')}, {ORIGIN})) // {s}000000 + 1) AS points_{b}"""
    for b, s in ch.BUCKET_SECONDS.items() if s)


@check("ch_03_bucket_count", with_ctes(REQUESTS_SQL, select=f"""
SELECT id, {COUNT_SQL},
  greatest(0, CAST({wall('e')} AS DATE) - CAST({wall('s')} AS DATE)) AS points_day FROM req"""))
def bucket_count(spark, sf_dir):
    out = requests(spark, sf_dir)
    for bucket in ch.BUCKET_SECONDS:
        out = ch.bucket_count(out, bucket).withColumnRenamed("points", f"points_{bucket}")
    return out.drop("start", "end")


@check("ch_05_resolve_ids", with_ctes(m.statistic_sql(0), m.CATALOG_SQL, m.RUNS_SQL, r.STATUS_SQL, select=f"""
SELECT statistic_id, display_name FROM status WHERE category IN ({TEMPS}, 'home_energy') AND is_active"""))
def resolve(spark, sf_dir):
    return ch.resolve_ids(status_of(spark, sf_dir), measures.TEMPERATURE_CATEGORIES + ["home_energy"])


@check("ch_06_day_bounds", with_ctes(REQUESTS_SQL, select=f"""
SELECT id, CAST({wall('s')} AS DATE) AS d0, CAST({wall('e')} AS DATE) AS d1,
  timezone('UTC', timezone('{LA}', CAST({wall('s')} AS DATE)::TIMESTAMP)) AS lo,
  timezone('UTC', timezone('{LA}', CAST({wall('e')} AS DATE)::TIMESTAMP)) AS hi FROM req"""))
def day_bounds(spark, sf_dir):
    d0, d1, lo, hi = ch.day_bounds(F.col("start"), F.col("end"))
    return requests(spark, sf_dir).select("id", d0.alias("d0"), d1.alias("d1"), lo.alias("lo"), hi.alias("hi"))


def shifted(spark, sf_dir, days):
    return m.events(spark, sf_dir).withColumn("ts", F.timestamp_micros(F.unix_micros("ts") + days * 86_400_000_000))


@check("ch_07_local_bin", f"""
SELECT event_id, time_bucket(INTERVAL 6 HOUR, {wall('t')}, {ORIGIN}) AS bucket_6hour,
  time_bucket(INTERVAL 2 HOUR, {wall('t - INTERVAL 30 YEAR')}, {ORIGIN}) AS bucket_2hour_before_origin
FROM (SELECT event_id, ts + INTERVAL 293 DAY AS t FROM events)""")
def binned(spark, sf_dir):
    old = F.col("ts") - F.expr("INTERVAL 30 YEAR")
    return shifted(spark, sf_dir, r.AUTUMN).select(
        "event_id", local_bin("ts", 21600).alias("bucket_6hour"),
        local_bin(old, 7200).alias("bucket_2hour_before_origin"))


@check("ch_08_agg_measure", with_ctes(m.statistic_sql(r.AUTUMN), m.CATALOG_SQL, views_sql(r.AUTUMN),
                                      agg_sql("temp", AUTUMN, "2hour"), select="""
SELECT statistic_id, bucket, round(mean, 6) AS mean, round(min, 6) AS min, round(max, 6) AS max FROM agg"""))
def aggregate(spark, sf_dir):
    view = measures.v_temperature(m.statistic(spark, sf_dir, r.AUTUMN), m.catalog(spark, sf_dir))
    return rounded(ch.agg_measure(view, *bounds(AUTUMN), "2hour"))


@check("ch_09_bucket_series", with_ctes(m.CATALOG_SQL, series_sql(SPRING, "hour"), select="""
SELECT statistic_id, bucket FROM series CROSS JOIN cat"""))
def series(spark, sf_dir):
    return ch.bucket_series(m.catalog(spark, sf_dir), *bounds(SPRING), "hour")


@check("ch_10_gap_fill", with_ctes(m.statistic_sql(r.SPRING), m.CATALOG_SQL, views_sql(r.SPRING),
                                   agg_sql("pow", SPRING, "hour"), series_sql(SPRING, "hour"), select="""
SELECT c.statistic_id, s.bucket, round(a.mean, 6) AS mean, a.min, a.max
FROM series s CROSS JOIN cat c LEFT JOIN agg a ON a.statistic_id = c.statistic_id AND a.bucket = s.bucket"""))
def filled(spark, sf_dir):
    cat = m.catalog(spark, sf_dir)
    view = measures.v_power(m.statistic(spark, sf_dir, r.SPRING), cat)
    rows = ch.gap_fill(ch.bucket_series(cat, *bounds(SPRING), "hour"),
                       ch.agg_measure(view, *bounds(SPRING), "hour", unit="w"))
    return rows.withColumn("mean", F.round("mean", 6))


@check("ch_11_bucket_label", f"""
SELECT event_id, {LABEL_SQL.format(b='b')} AS label
FROM (SELECT event_id, time_bucket(INTERVAL 1 HOUR, {wall('ts + INTERVAL 293 DAY')}, {ORIGIN}) AS b FROM events)""")
def labels(spark, sf_dir):
    return shifted(spark, sf_dir, r.AUTUMN).select("event_id", bucket_label(local_bin("ts", 3600)).alias("label"))


@check("ch_13_energy_daily_chart", with_ctes(
    *r.energy_ctes(r.AUTUMN), r.DAILY_SQL, series_sql(AUTUMN, "day"), select="""
SELECT c.statistic_id, s.bucket, round(allocated_kwh, 4) AS allocated_kwh, round(unallocated_kwh, 4) AS unallocated_kwh,
  round(unresolved_kwh, 4) AS unresolved_kwh, temporal_coverage, allocation_coverage
FROM series s CROSS JOIN (SELECT * FROM cat WHERE category IN ('home_energy', 'device_energy') AND is_active) c
LEFT JOIN daily d ON d.statistic_id = c.statistic_id AND d.local_day = s.bucket"""))
def energy_chart(spark, sf_dir):
    stat, cat = m.statistic(spark, sf_dir, r.AUTUMN), m.catalog(spark, sf_dir)
    status = measures.v_source_status(cat, stat, m.runs(spark, sf_dir), instant(m.NOW))
    daily = e.v_energy_daily(e.v_energy(stat, cat, m.reviews(stat)))
    return r.flat(ch.chart_energy_daily(daily, status, *bounds(AUTUMN), e.ENERGY_CATEGORIES), *r.DAILY_MONEY)


BILL_RANGE = ("2024-03-05 00:00:00", "2024-03-16 00:00:00")
BILL_SQL = f"""
bill AS (
  SELECT statistic_id, display_name, grain, covered_from, covered_until, covered_hours,
    round(delta_kwh, 4) AS delta_kwh, delta_source, review_decision, quality_flags,
    round(CASE WHEN list_has_all(['ok','seeded_from_state','reviewed_state','grain_transition'], quality_flags)
          THEN delta_kwh END, 4) AS billable_kwh
  FROM energy WHERE grain IN ('billing_period', 'day')
    AND ((covered_from IS NULL AND covered_until >= TIMESTAMP '{BILL_RANGE[0]}' AND covered_until < TIMESTAMP '{BILL_RANGE[1]}')
      OR (covered_from IS NOT NULL AND covered_until > TIMESTAMP '{BILL_RANGE[0]}' AND covered_from < TIMESTAMP '{BILL_RANGE[1]}')))"""


def billing_rows(spark, sf_dir):
    view = e.v_energy_billing(r.energy_view(spark, sf_dir, r.SPRING))
    chosen = ch.resolve_ids(status_of(spark, sf_dir), ["home_energy"], include_inactive=True)
    rows = ch.chart_billing(view, chosen, *bounds(BILL_RANGE))
    return rows.withColumns({c: F.round(c, 4) for c in ("delta_kwh", "billable_kwh")})


@check("ch_14_billing_overlap", with_ctes(*r.energy_ctes(r.SPRING), BILL_SQL, select="""
SELECT * REPLACE (array_to_string(quality_flags, ',') AS quality_flags) FROM bill"""))
def billing(spark, sf_dir):
    return r.flat(billing_rows(spark, sf_dir))


PAGE = 7


@check("ch_15_limit_truncated", with_ctes(*r.energy_ctes(r.SPRING), BILL_SQL, select=f"""
SELECT * REPLACE (array_to_string(quality_flags, ',') AS quality_flags), (SELECT count(*) FROM bill) > {PAGE} AS truncated
FROM bill ORDER BY statistic_id, covered_until LIMIT {PAGE}"""))
def truncated(spark, sf_dir):
    return r.flat(ch.limit_truncated(billing_rows(spark, sf_dir), PAGE))


@check("ch_16_metric_listing", with_ctes(m.statistic_sql(0), m.CATALOG_SQL, m.RUNS_SQL, r.STATUS_SQL, select="""
SELECT statistic_id, display_name, category, is_active, last_value_at, coalesce(stale_for > 7200, true) AS stale
FROM status"""))
def metric_listing(spark, sf_dir):
    return ch.metric_listing(status_of(spark, sf_dir))


@check("ch_17_status_listing", with_ctes(m.statistic_sql(0), m.CATALOG_SQL, m.RUNS_SQL, r.STATUS_SQL, select="""
SELECT statistic_id, display_name, category, is_active, grain_review_required, last_value_at,
  CAST(stale_for AS DOUBLE) AS stale_seconds, rows_imported, last_success_at, last_error FROM status"""))
def status_listing(spark, sf_dir):
    return ch.status_listing(status_of(spark, sf_dir))


def _number(column):
    return f"coalesce(CAST({column} AS VARCHAR), 'null')"


@check("snk_03_chart_json", f"""
SELECT statistic_id, '[' || string_agg('{{"bucket":"' || label || '","mean":' || {_number('mean')} || ',"min":' ||
  {_number('min')} || ',"max":' || {_number('max')} || '}}', ',' ORDER BY bucket) || ']' AS points
FROM ({chart_sql("temp", TEMPS, r.SPRING, SPRING, "6hour", "")}) GROUP BY 1""")
def chart_json(spark, sf_dir):
    return ch.to_chart(rounded(temperature_chart(spark, sf_dir, r.SPRING, SPRING, "6hour")))


@check("snk_03_chart_points", chart_sql("temp", TEMPS, r.SPRING, SPRING, "6hour", "").replace(
    "SELECT i.statistic_id, s.bucket, round(a.mean, 6)",
    "SELECT i.statistic_id, row_number() OVER (PARTITION BY i.statistic_id ORDER BY s.bucket) AS n, round(a.mean, 6)")
    .replace(" AS label", " AS bucket"))
def chart_points(spark, sf_dir):
    """The chart JSON read back, so that every point and null in it is compared."""
    shape = "array<struct<bucket:string,mean:double,min:double,max:double>>"
    shaped = chart_json(spark, sf_dir).select("statistic_id", F.posexplode(F.from_json("points", shape)))
    return shaped.select("statistic_id", (F.col("pos") + 1).cast("bigint").alias("n"), "col.*")


@check("snk_04_billing_periods", with_ctes(*r.energy_ctes(r.SPRING), BILL_SQL, select="""
SELECT statistic_id, grain, strftime(covered_from, '%Y-%m-%dT%H:%M:%S+00:00') AS covered_from,
  strftime(covered_until, '%Y-%m-%dT%H:%M:%S+00:00') AS covered_until, covered_hours, delta_kwh, delta_source,
  review_decision, array_to_string(quality_flags, ',') AS quality_flags, billable_kwh FROM bill"""))
def periods_out(spark, sf_dir):
    """Periods as JSON, read back field by field."""
    shape = ("struct<grain:string,covered_from:string,covered_until:string,covered_hours:double,delta_kwh:double,"
             "delta_source:string,review_decision:string,quality_flags:array<string>,billable_kwh:double>")
    out = ch.to_periods(billing_rows(spark, sf_dir)).drop("covered_until")
    return r.flat(out.select("statistic_id", F.from_json("period", shape).alias("p")).select("statistic_id", "p.*"))
