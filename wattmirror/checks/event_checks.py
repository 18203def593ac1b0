"""Event detections against their oracles; every user is an entity."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from wattmirror.checks import model as m
from wattmirror.checks.registry import check, with_ctes
from wattmirror.operators import events as ev

EV_SQL = """
ev AS (SELECT event_id, user_id AS entity_id, ts, event_type AS state, value, json_extract_string(props, '$.k') AS k FROM events)"""
CH_SQL = """
ch AS (SELECT * FROM (SELECT *, lag(state) OVER w AS from_state FROM ev WINDOW w AS (PARTITION BY entity_id ORDER BY ts, event_id))
  WHERE state IS DISTINCT FROM from_state),
runs AS (SELECT *, lead(ts) OVER w AS changed_at, lag(ts) OVER w AS since FROM ch
  WINDOW w AS (PARTITION BY entity_id ORDER BY ts, event_id))"""
HORIZON = "(SELECT max(ts) FROM events)"
LA = "timezone('America/Los_Angeles', timezone('UTC', {x}))"


def of_ids(df, *more):
    return df.select("entity_id", "event_id", "ts", *more)


@check("st_01_transitions", with_ctes(EV_SQL, CH_SQL, select="""
SELECT entity_id, event_id, ts, from_state, state AS to_state FROM ch
WHERE from_state IN ('click', 'view') AND state IN ('purchase', 'error')"""))
def moved(spark, sf_dir):
    return of_ids(ev.transitions(m.events(spark, sf_dir), ["click", "view"], ["purchase", "error"]), "from_state", "to_state")


@check("st_02_attr_transitions", with_ctes("""
ev AS (SELECT event_id, user_id AS entity_id, ts, json_extract_string(props, '$.k') AS state FROM events)""", CH_SQL, select="""
SELECT entity_id, event_id, ts, from_state, state AS to_state FROM ch WHERE from_state IS NOT NULL AND state IN ('9', '58', '99')"""))
def attrs(spark, sf_dir):
    return of_ids(ev.attr_transitions(m.events(spark, sf_dir), "$.k", ["9", "58", "99"]), "from_state", "to_state")


@check("st_03_crossings", with_ctes(EV_SQL, select="""
SELECT entity_id, event_id, ts, value, previous_value FROM (SELECT *, lag(value) OVER w AS previous_value FROM ev
  WINDOW w AS (PARTITION BY entity_id ORDER BY ts, event_id)) WHERE value > 50 AND NOT previous_value > 50"""))
def crossed(spark, sf_dir):
    return of_ids(ev.crossings(m.events(spark, sf_dir), above=50), "value", "previous_value")


@check("st_04_held_for", with_ctes(EV_SQL, CH_SQL, select=f"""
SELECT entity_id, event_id, ts, state, ts + INTERVAL 6 HOUR AS fires_at FROM runs
WHERE state IN ('click', 'error') AND coalesce(changed_at, {HORIZON}) >= ts + INTERVAL 6 HOUR"""))
def held(spark, sf_dir):
    return of_ids(ev.held_for(m.events(spark, sf_dir), ["click", "error"], timedelta(hours=6)), "state", "fires_at")


@check("st_05_debounce", with_ctes(EV_SQL, select=f"""
SELECT entity_id, event_id, ts FROM (SELECT *, lead(ts) OVER w AS nxt FROM ev WHERE state = 'click'
  WINDOW w AS (PARTITION BY entity_id ORDER BY ts, event_id))
WHERE CASE WHEN nxt IS NULL THEN {HORIZON} >= ts + INTERVAL 2 DAY ELSE nxt > ts + INTERVAL 2 DAY END"""))
def quiet(spark, sf_dir):
    events = m.events(spark, sf_dir)
    return of_ids(ev.debounce(events.where("state = 'click'"), timedelta(days=2), ev.latest_ts(events)))


@check("st_06_suppress_active", """
WITH RECURSIVE acc AS (
  SELECT user_id, min(ts) AS ts FROM events GROUP BY 1
  UNION ALL
  SELECT a.user_id, min(e.ts) FROM acc a JOIN events e ON e.user_id = a.user_id AND e.ts >= a.ts + INTERVAL 12 HOUR
  GROUP BY a.user_id, a.ts)
SELECT a.user_id AS entity_id, min(e.event_id) AS event_id, a.ts FROM acc a JOIN events e ON e.user_id = a.user_id AND e.ts = a.ts
GROUP BY 1, 3""")
def cooled(spark, sf_dir):
    return of_ids(ev.suppress_active(m.events(spark, sf_dir), timedelta(hours=12)))


ASOF = """
SELECT t.entity_id, t.event_id, t.ts, g.state AS guard_state, g.value AS guard_value, g.ts AS guard_since
FROM (SELECT *, entity_id + 1 AS who, ts{delay} AS moment FROM ev WHERE state = 'purchase') t ASOF LEFT JOIN
  (SELECT entity_id, ts, arg_max(state, event_id) AS state, arg_max(value, event_id) AS value FROM ev GROUP BY 1, 2) g
  ON g.entity_id = t.who AND t.moment >= g.ts"""


def asked(spark, sf_dir):
    events = m.events(spark, sf_dir)
    return events.where("state = 'purchase'").withColumn("guard_id", F.col("entity_id") + 1), events


@check("st_08_asof_state", with_ctes(EV_SQL, select=ASOF.format(delay="")))
def asof(spark, sf_dir):
    return of_ids(ev.asof_state(*asked(spark, sf_dir)), "guard_state", "guard_value", "guard_since")


@check("st_09_delayed_recheck", with_ctes(EV_SQL, select=ASOF.format(delay=" + INTERVAL 7 MINUTE")))
def recheck(spark, sf_dir):
    return of_ids(ev.asof_state(*asked(spark, sf_dir), delay=timedelta(minutes=7)),
                  "guard_state", "guard_value", "guard_since")


@check("st_10_dwell_over", with_ctes(EV_SQL, CH_SQL, select="""
SELECT entity_id, event_id, ts, from_state, state, (epoch_us(ts) - epoch_us(since)) / 1000000.0::DOUBLE AS dwell_seconds
FROM runs WHERE state = 'view' AND epoch_us(ts) - epoch_us(since) > 36000 * 1000000::BIGINT"""))
def dwelt(spark, sf_dir):
    return of_ids(ev.dwell_over(m.events(spark, sf_dir), 36000, to="view"), "from_state", "state", "dwell_seconds")


@check("st_11_time_of_day", f"""
SELECT event_id, strftime({LA.format(x='ts')}, '%H:%M:%S') BETWEEN '06:00:00' AND '21:59:59' AS by_day,
  strftime({LA.format(x='ts')}, '%H:%M:%S') >= '22:30:00' OR strftime({LA.format(x='ts')}, '%H:%M:%S') < '05:00:00' AS by_night
FROM events""")
def clock(spark, sf_dir):
    events = m.events(spark, sf_dir)
    day = ev.time_of_day(events, "06:00:00", "22:00:00").select("event_id", F.lit(True).alias("d"))
    night = ev.time_of_day(events, "22:30:00", "05:00:00").select("event_id", F.lit(True).alias("n"))
    return events.join(day, "event_id", "left").join(night, "event_id", "left").select(
        "event_id", F.coalesce("d", F.lit(False)).alias("by_day"), F.coalesce("n", F.lit(False)).alias("by_night"))


@check("st_12_schedule", """
WITH r AS (SELECT user_id AS entity_id, CAST(min(ts) AS DATE) + 293 AS first_day, CAST(max(ts) AS DATE) + 293 AS last_day FROM events GROUP BY 1)
SELECT entity_id, CAST(d AS DATE) AS day, timezone('UTC', timezone('America/Los_Angeles', CAST(d AS TIMESTAMP) + INTERVAL 5 HOUR)) AS fires_at
FROM r, LATERAL (SELECT unnest(generate_series(first_day::TIMESTAMP, last_day::TIMESTAMP, INTERVAL 1 DAY)) AS d)""")
def scheduled(spark, sf_dir):
    ranges = m.events(spark, sf_dir).groupBy("entity_id").agg(
        F.date_add(F.to_date(F.min("ts")), 293).alias("first_day"), F.date_add(F.to_date(F.max("ts")), 293).alias("last_day"))
    return ev.schedule(ranges, "05:00:00").select("entity_id", "day", "fires_at")


@check("st_13_calendar_label", f"""
SELECT o_orderkey AS id, CASE strftime({LA.format(x='t')}, '%m-%d') WHEN '03-17' THEN 'irish_flag_porch' WHEN '03-20' THEN 'spring_yard'
  WHEN '06-20' THEN 'summer_yard' WHEN '09-22' THEN 'autumn_yard' WHEN '12-21' THEN 'winter_yard' ELSE 'yard_ambience' END AS label
FROM (SELECT o_orderkey, o_orderdate + to_minutes(o_orderkey % 1440) AS t FROM orders)""")
def calendar(spark, sf_dir):
    ts = F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(mins=(F.col("o_orderkey") % 1440).cast("int"))
    return ev.calendar_label(m.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), ts.alias("ts"))) \
             .select("id", "label")


@check("st_14_route", with_ctes(EV_SQL, select="""
SELECT event_id, CASE k WHEN '9' THEN 'single' WHEN '99' THEN 'double' ELSE 'long' END AS label FROM ev WHERE k IN ('9', '99', '58')"""))
def routed(spark, sf_dir):
    return ev.route(m.events(spark, sf_dir), "$.k", {"9": "single", "99": "double", "58": "long"}).select("event_id", "label")


@check("st_15_band", with_ctes(EV_SQL, select="""
SELECT event_id, CASE WHEN k::DOUBLE <= 34 THEN 85 WHEN k::DOUBLE <= 67 THEN 42 ELSE 0 END AS level FROM ev
WHERE coalesce(k::DOUBLE, 0) > 0"""))
def banded(spark, sf_dir):
    return ev.band(m.events(spark, sf_dir), F.get_json_object("attrs", "$.k")).select("event_id", "level")


@check("st_16_hold_over_intervals", with_ctes(EV_SQL, CH_SQL, """
iv AS (SELECT entity_id, event_id, ts, least(coalesce(changed_at, ts + INTERVAL 20 HOUR), ts + INTERVAL 20 HOUR) + INTERVAL 9 HOUR AS ends_at
  FROM runs WHERE state IN ('view', 'click')),
mk AS (SELECT *, CASE WHEN max(ends_at) OVER (PARTITION BY entity_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) >= ts
    THEN 0 ELSE 1 END AS fresh FROM iv),
isl AS (SELECT *, sum(fresh) OVER (PARTITION BY entity_id ORDER BY ts, event_id) AS n FROM mk)""", select="""
SELECT entity_id, min(ts) AS starts_at, max(ends_at) AS ends_at, count(*) AS triggers FROM isl GROUP BY entity_id, n"""))
def intervals(spark, sf_dir):
    return ev.hold_over_intervals(m.events(spark, sf_dir), ["view", "click"], timedelta(hours=20), timedelta(hours=9))


def signals(spark, sf_dir):
    """Ten users share a home; what a user does decides which signal the event is."""
    role = (F.when(F.col("state").isin("click", "error"), "door").when(F.col("state") == "view", "motion")
             .when(F.col("state") == "signup", "tracker").otherwise("occupied"))
    high = F.col("value") > F.when(F.col("state") == "view", 100).otherwise(20)
    state = (F.when(F.col("state") == "signup", F.when(high, "not_home").otherwise("home"))
              .otherwise(F.when(high, "on").otherwise("off")))
    return m.events(spark, sf_dir).select(F.floor(F.col("entity_id") / 10).alias("home_id"), role.alias("role"),
                                          "entity_id", "event_id", "ts", state.alias("state"), "value")


SIGNALS_SQL = f"""
sig AS (SELECT user_id // 10 AS home_id, user_id AS entity_id, event_id, ts,
    CASE WHEN event_type IN ('click', 'error') THEN 'door' WHEN event_type = 'view' THEN 'motion'
         WHEN event_type = 'signup' THEN 'tracker' ELSE 'occupied' END AS role,
    CASE WHEN event_type = 'signup' THEN CASE WHEN value > 20 THEN 'not_home' ELSE 'home' END
         WHEN value > CASE WHEN event_type = 'view' THEN 100 ELSE 20 END THEN 'on' ELSE 'off' END AS state FROM events),
doors AS (SELECT home_id, entity_id AS door, event_id, ts, state,
    lag(state) OVER (PARTITION BY home_id, entity_id ORDER BY ts, event_id) AS prev FROM sig WHERE role = 'door'),
occ AS (SELECT * FROM (SELECT home_id, ts, state, lag(state) OVER (PARTITION BY home_id ORDER BY ts, event_id) AS prev FROM sig
          WHERE role = 'occupied') WHERE state IS DISTINCT FROM prev),
trk AS (SELECT home_id, ts, state FROM sig WHERE role = 'tracker'),
day_doors AS (SELECT * FROM doors WHERE strftime({LA.format(x='ts')}, '%H:%M:%S') BETWEEN '06:00:00' AND '21:59:59')"""


@check("st_17_departures", with_ctes(SIGNALS_SQL, f"""
closed AS (SELECT d.home_id, d.door, d.event_id, d.ts FROM day_doors d ASOF JOIN occ o ON o.home_id = d.home_id AND d.ts >= o.ts
  WHERE d.prev = 'on' AND d.state = 'off' AND o.state = 'on'),
waited AS (SELECT *, ts + INTERVAL 7 MINUTE AS later FROM (SELECT *, lead(ts) OVER (PARTITION BY home_id ORDER BY ts, event_id) AS nxt FROM closed)
  WHERE CASE WHEN nxt IS NULL THEN {HORIZON} >= ts + INTERVAL 7 MINUTE ELSE nxt > ts + INTERVAL 7 MINUTE END),
settled AS (SELECT w.* FROM waited w ASOF JOIN occ o ON o.home_id = w.home_id AND w.later >= o.ts
  WHERE epoch_us(w.later) - epoch_us(o.ts) > 600000000),
away AS (SELECT s.* FROM settled s ASOF JOIN trk t ON t.home_id = s.home_id AND s.later >= t.ts WHERE t.state = 'not_home'),
sensors AS (SELECT DISTINCT home_id, entity_id AS sensor FROM sig WHERE role = 'motion'),
asked AS (SELECT a.*, sensor FROM away a JOIN sensors s ON s.home_id = a.home_id),
seen AS (SELECT a.*, g.state AS st FROM asked a ASOF LEFT JOIN (SELECT home_id, entity_id, ts, state FROM sig WHERE role = 'motion') g
  ON g.home_id = a.home_id AND g.entity_id = a.sensor AND a.later >= g.ts)""", select="""
SELECT home_id, door, event_id, ts, later AS departed_at FROM seen GROUP BY ALL HAVING bool_and(coalesce(st = 'off', false))"""))
def departed(spark, sf_dir):
    return ev.departures(signals(spark, sf_dir))


@check("st_18_arrivals", with_ctes(SIGNALS_SQL, select="""
SELECT d.home_id, d.door, d.event_id, d.ts FROM day_doors d ASOF JOIN occ o ON o.home_id = d.home_id AND d.ts >= o.ts
WHERE d.prev = 'off' AND d.state = 'on' AND o.state = 'off'"""))
def arrived(spark, sf_dir):
    return ev.arrivals(signals(spark, sf_dir))


@check("st_19_latch", with_ctes(EV_SQL, select="""
SELECT entity_id, event_id, ts, flag FROM (SELECT *, state = 'purchase' AS flag,
    coalesce(lag(state = 'purchase') OVER (PARTITION BY entity_id ORDER BY ts, event_id), false) AS was
  FROM ev WHERE state IN ('purchase', 'error')) WHERE flag <> was"""))
def latched(spark, sf_dir):
    events = m.events(spark, sf_dir)
    return ev.latch(events.where("state = 'purchase'"), events.where("state = 'error'"))


@check("st_20_recovered", with_ctes("""
ev AS (SELECT event_id, user_id AS entity_id, ts, CASE event_type WHEN 'error' THEN 'unavailable' WHEN 'signup' THEN 'unknown'
    WHEN 'view' THEN 'idle' ELSE CAST(CAST(value AS DECIMAL(18,2)) - 20 AS VARCHAR) END AS state FROM events)""", CH_SQL, select=f"""
SELECT entity_id, event_id, ts, state, ts + INTERVAL 10 MINUTE AS fires_at FROM runs
WHERE from_state IN ('unavailable', 'unknown') AND try_cast(state AS DOUBLE) >= 0
  AND coalesce(changed_at, {HORIZON}) >= ts + INTERVAL 10 MINUTE"""))
def back(spark, sf_dir):
    state = (F.when(F.col("state") == "error", "unavailable").when(F.col("state") == "signup", "unknown")
              .when(F.col("state") == "view", "idle").otherwise((F.col("value").cast("decimal(18,2)") - 20).cast("string")))
    return of_ids(ev.recovered(m.events(spark, sf_dir).withColumn("state", state)), "state", "fires_at")


@check("st_21_guarded_action", with_ctes(EV_SQL, select="""
SELECT t.entity_id, t.event_id, t.ts FROM (SELECT *, entity_id + 1 AS load_id, entity_id + 2 AS unit_id FROM ev WHERE state = 'error') t
ASOF LEFT JOIN (SELECT entity_id, ts, value FROM ev) l ON l.entity_id = t.load_id AND t.ts >= l.ts
ASOF LEFT JOIN (SELECT entity_id, ts, state FROM ev) u ON u.entity_id = t.unit_id AND t.ts >= u.ts
WHERE NOT coalesce(l.value > 40, false) AND NOT coalesce(u.state IN ('click', 'view'), false)"""))
def guarded(spark, sf_dir):
    events = m.events(spark, sf_dir)
    triggers = events.where("state = 'error'").withColumns({"load_id": F.col("entity_id") + 1, "unit_id": F.col("entity_id") + 2})
    return of_ids(ev.guarded_action(triggers, events, load_above=40, active=("click", "view")))


HOURLY_SQL = """
SELECT user_id AS entity_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS start_at, round(avg(value), 4) AS mean, min(value) AS min,
  max(value) AS max, arg_max(value, ts) AS state, round(sum(value), 4) AS sum FROM events GROUP BY 1, 2"""


def rounded(df):
    return df.withColumns({"mean": F.round("mean", 4), "sum": F.round("sum", 4)})


@check("st_23_hourly_stats", HOURLY_SQL)
def hourly(spark, sf_dir):
    return rounded(ev.hourly_stats(m.events(spark, sf_dir)))
