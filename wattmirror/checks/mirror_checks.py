"""Mirror, gate, reconciliation and run bookkeeping against their oracles."""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import functions as F

from wattmirror.checks import model as m
from wattmirror.checks.registry import check, with_ctes
from wattmirror.functions.timecols import epoch_to_utc, instant
from wattmirror.functions.values import values_equal
from wattmirror.operators import gating, merge, reconcile as rec, runs
from wattmirror.plans import sync
from wattmirror.plans.pinned import pin
from wattmirror.session import work_dir
from wattmirror.sources import statistics as src

NOW = datetime(2024, 2, 1)
NOW_SQL = "TIMESTAMP '2024-02-01 00:00:00'"
OLD_SQL = "TIMESTAMP '2024-01-15 00:00:00'"
SINCE, UNTIL = datetime(2024, 1, 9), datetime(2024, 1, 24)
VALUES = "mean, mean_weight, min, max, state, sum"


# --- source shape --------------------------------------------------------------------------

def metric_no(col):
    """A number per metric: its home and the first letter of its kind."""
    home = F.coalesce(F.try_element_at(F.split(col, "_"), F.lit(2)), F.lit("0")).cast("bigint")
    return home * 1000 + F.ascii(col)


def source_statistics(spark, sf_dir):
    stat = m.statistic(spark, sf_dir)
    return stat.select(metric_no("statistic_id").alias("metadata_id"),
                       F.unix_seconds("start_at").cast("double").alias("start_ts"), *src.MEASURES,
                       F.when(F.col("state").isNull(), F.unix_seconds("start_at") - 0.5).cast("double").alias("last_reset_ts"))


def source_meta(spark, sf_dir):
    return m.catalog(spark, sf_dir).select(metric_no("statistic_id").alias("id"), "statistic_id", "unit_class")


SOURCE_SQL = f"""
src AS (
  SELECT statistic_id, start_at, {VALUES}, epoch(start_at) AS start_ts,
    CASE WHEN state IS NULL THEN epoch(start_at) - 0.5 END AS last_reset_ts,
    CASE WHEN state IS NULL THEN start_at - INTERVAL 500 MILLISECOND END AS reset_at FROM stat)"""


def grain_of(sid="s.statistic_id", at="s.start_at"):
    return f"""CASE WHEN {sid} IN (SELECT statistic_id FROM per) THEN
      (SELECT max(grain) FROM per p WHERE p.statistic_id = {sid} AND p.valid_from <= {at}
         AND (p.valid_until IS NULL OR {at} < p.valid_until)) ELSE 'hour' END"""


@check("src_01_scan_statistics", with_ctes(m.statistic_sql(0), SOURCE_SQL, select=f"""
SELECT statistic_id, CAST(start_ts AS DOUBLE) AS start_ts, {VALUES}, CAST(last_reset_ts AS DOUBLE) AS last_reset_ts
FROM src WHERE start_at >= TIMESTAMP '{SINCE}' AND start_at < TIMESTAMP '{UNTIL}'"""))
def scan(spark, sf_dir):
    return src.scan_statistics(source_statistics(spark, sf_dir), source_meta(spark, sf_dir),
                               SINCE.timestamp(), UNTIL.timestamp())


@check("src_03_pinned_source", with_ctes(m.statistic_sql(0), SOURCE_SQL, select=f"""
SELECT statistic_id, start_at, {VALUES}, reset_at AS last_reset_at FROM src"""))
def pinned(spark, sf_dir):
    return src.pin_source(src.timed(src.scan_statistics(source_statistics(spark, sf_dir), source_meta(spark, sf_dir))))


@check("src_07_stage", with_ctes(m.statistic_sql(0), SOURCE_SQL, m.CATALOG_SQL, m.periods_sql(0), select=f"""
SELECT statistic_id, start_at, {grain_of()} AS grain, {VALUES}, reset_at AS last_reset_at FROM src s"""))
def staged(spark, sf_dir):
    rows = src.timed(src.scan_statistics(source_statistics(spark, sf_dir), source_meta(spark, sf_dir)))
    return src.stage(gating.resolve_grain(rows, m.catalog(spark, sf_dir), m.periods(spark, sf_dir)))


@check("src_07_duplicate_keys", with_ctes(m.statistic_sql(0), select="""
SELECT statistic_id, start_at, CAST(2 AS BIGINT) AS "rows" FROM stat WHERE extract('hour' FROM start_at) % 6 = 0"""))
def repeated_keys(spark, sf_dir):
    rows = m.statistic(spark, sf_dir)
    return src.duplicate_keys(rows.union(rows.where(F.hour("start_at") % 6 == 0)))


@check("syn_01_resolve_grain", with_ctes(m.statistic_sql(0), m.CATALOG_SQL, m.periods_sql(0), select=f"""
SELECT statistic_id, start_at, {grain_of()} AS grain FROM stat s"""))
def grains(spark, sf_dir):
    rows = m.statistic(spark, sf_dir).select("statistic_id", "start_at")
    return gating.resolve_grain(rows, m.catalog(spark, sf_dir), m.periods(spark, sf_dir))


@check("syn_01_unresolved_rows", with_ctes(m.statistic_sql(0), m.CATALOG_SQL, m.periods_sql(0), select="""
SELECT statistic_id, start_at FROM stat s WHERE statistic_id IN (SELECT statistic_id FROM per)
  AND NOT EXISTS (SELECT 1 FROM per p WHERE p.grain <> 'day' AND p.statistic_id = s.statistic_id
    AND p.valid_from <= s.start_at AND (p.valid_until IS NULL OR s.start_at < p.valid_until))"""))
def no_grain(spark, sf_dir):
    rows = m.statistic(spark, sf_dir).select("statistic_id", "start_at")
    holed = m.periods(spark, sf_dir).where("grain <> 'day'")
    return gating.unresolved(gating.resolve_grain(rows, m.catalog(spark, sf_dir), holed))


@check("syn_02_epoch_to_utc", "SELECT event_id, ts AS back FROM events")
def epoch(spark, sf_dir):
    ev = m.events(spark, sf_dir)
    return ev.select("event_id", epoch_to_utc(F.unix_micros("ts") / 1e6).alias("back"))


# --- merge ---------------------------------------------------------------------------------

def mirror_table(spark, sf_dir):
    """An older copy of the statistics: clean values, some rows not there yet."""
    stat = m.statistic(spark, sf_dir, perturbed=False)
    hour = F.hour("start_at")
    old = stat.where(~((hour == 5) & (F.col("statistic_id") == "view")))
    extra = stat.where("statistic_id = 'click'").withColumn("start_at", F.col("start_at") - F.expr("INTERVAL 400 DAY"))
    return (old.unionByName(extra).withColumn("synced_at", F.lit(datetime(2024, 1, 15)))
               .withColumn("last_reset_at", F.when(hour == 7, F.col("start_at"))))


MIRROR_SQL = f"""
mir AS (
  SELECT statistic_id, start_at, grain, {VALUES}, CASE WHEN hour(start_at) = 7 THEN start_at END AS last_reset_at,
    {OLD_SQL} AS synced_at
  FROM (SELECT * FROM clean WHERE NOT (hour(start_at) = 5 AND statistic_id = 'view')
        UNION ALL SELECT * REPLACE (start_at - INTERVAL 400 DAY AS start_at) FROM clean WHERE statistic_id = 'click'))"""
BOTH = (m.statistic_sql(0), m.statistic_sql(0, perturbed=False, name="clean"), MIRROR_SQL)
MERGE_SQL = f"""
lab AS (
  SELECT coalesce(m.statistic_id, i.statistic_id) AS statistic_id, coalesce(m.start_at, i.start_at) AS start_at,
    CASE WHEN m.statistic_id IS NULL THEN 'inserted' WHEN i.statistic_id IS NULL THEN 'kept'
         WHEN (m.grain, m.mean, m.mean_weight, m.min, m.max, m.state, m.sum, m.last_reset_at) IS DISTINCT FROM
              (i.grain, i.mean, i.mean_weight, i.min, i.max, i.state, i.sum, i.last_reset_at) THEN 'updated'
         ELSE 'unchanged' END AS merge_label,
    i.state AS new_state, m.state AS old_state, i.sum AS new_sum, m.sum AS old_sum, m.synced_at AS old_synced
  FROM mir m FULL JOIN inc i ON i.statistic_id = m.statistic_id AND i.start_at = m.start_at)"""
INC_SQL = f"inc AS (SELECT * FROM stat WHERE start_at >= TIMESTAMP '{SINCE}')"


def incoming_rows(spark, sf_dir):
    return runs.in_window(m.statistic(spark, sf_dir), SINCE, None)


def labelled(spark, sf_dir):
    return merge.label_merge(mirror_table(spark, sf_dir), incoming_rows(spark, sf_dir), src.FACT_KEY,
                             merge.COMPARED, F.lit(NOW))


@check("snk_01_upsert_changed", with_ctes(*BOTH, INC_SQL, MERGE_SQL, select=f"""
SELECT statistic_id, start_at, merge_label,
  CASE WHEN merge_label IN ('inserted', 'updated') THEN new_state ELSE old_state END AS state,
  CASE WHEN merge_label IN ('inserted', 'updated') THEN new_sum ELSE old_sum END AS sum,
  CASE WHEN merge_label IN ('inserted', 'updated') THEN {NOW_SQL} ELSE old_synced END AS synced_at FROM lab"""))
def upserted(spark, sf_dir):
    return labelled(spark, sf_dir).select("statistic_id", "start_at", "merge_label", "state", "sum", "synced_at")


@check("snk_01_merge_into_path", with_ctes(*BOTH, INC_SQL, MERGE_SQL, select="""
SELECT statistic_id, start_at, CASE WHEN merge_label IN ('inserted', 'updated') THEN new_sum ELSE old_sum END AS sum
FROM lab"""))
def merged_path(spark, sf_dir):
    """The stored form: only what changed is written, beside the months it falls into."""
    import uuid

    from wattmirror.session import work_dir
    path = f"{work_dir(spark)}/facts-{uuid.uuid4().hex}"
    merge.write_months(mirror_table(spark, sf_dir), path)
    merge.merge_into_path(path, incoming_rows(spark, sf_dir), F.lit(NOW))
    return merge.read_months(spark, path).select("statistic_id", "start_at", "sum")


@check("snk_02_upsert_latest", f"""
WITH t AS (SELECT {m.METRIC_SQL} AS source, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS at, max(value) AS bpm FROM events
           WHERE ts < TIMESTAMP '2024-01-20 00:00:00' GROUP BY 1, 2),
i AS (SELECT {m.METRIC_SQL} AS source, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS at, arg_max(value, event_id) AS bpm FROM events
      WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' GROUP BY 1, 2)
SELECT coalesce(i.source, t.source) AS source, coalesce(i.at, t.at) AS at, coalesce(i.bpm, t.bpm) AS bpm,
  CASE WHEN i.at IS NULL THEN TIMESTAMP '2024-01-15 00:00:00' ELSE TIMESTAMP '2024-02-01 00:00:00' END AS synced_at
FROM t FULL JOIN i ON i.source = t.source AND i.at = t.at""")
def latest(spark, sf_dir):
    ev = m.events(spark, sf_dir).select("event_id", "ts", m.metric(F.col("state"), F.col("entity_id")).alias("source"),
                                        F.date_trunc("hour", "ts").alias("at"), F.col("value").alias("bpm"))
    target = (ev.where(F.col("ts") < instant("2024-01-20")).groupBy("source", "at").agg(F.max("bpm").alias("bpm"))
                .withColumn("synced_at", instant("2024-01-15")))
    return merge.upsert_latest(target, ev.where(F.col("ts") >= instant("2024-01-15")), ["source", "at"],
                               ["event_id"], F.lit(NOW))


COUNTS_SQL = """
SELECT statistic_id, count(*) AS rows_read, count(*) FILTER (WHERE merge_label = 'inserted') AS rows_inserted,
  count(*) FILTER (WHERE merge_label = 'updated') AS rows_updated,
  count(*) FILTER (WHERE merge_label = 'unchanged') AS rows_unchanged, max(start_at) AS source_max_ts
FROM lab WHERE merge_label <> 'kept' GROUP BY ROLLUP (statistic_id)"""


@check("syn_11_merge_counts", with_ctes(*BOTH, INC_SQL, MERGE_SQL, select=COUNTS_SQL))
def counts(spark, sf_dir):
    return merge.merge_counts(labelled(spark, sf_dir))


@check("syn_12_run_record", with_ctes(*BOTH, INC_SQL, MERGE_SQL, f"c AS ({COUNTS_SQL})", select=f"""
SELECT (SELECT max(o_orderkey) + 1 FROM orders) AS id, {NOW_SQL} AS started_at, {NOW_SQL} AS finished_at,
  'incremental' AS mode, TIMESTAMP '{SINCE}' AS window_start, CAST(NULL AS TIMESTAMP) AS window_end, source_max_ts,
  rows_read, rows_inserted, rows_updated, rows_unchanged, '0.1.0' AS exporter_version, 1 AS schema_version,
  '2024.1' AS source_version, 'success' AS status, CAST(NULL AS VARCHAR) AS error FROM c WHERE statistic_id IS NULL"""))
def record(spark, sf_dir):
    next_id = m.runs(spark, sf_dir).groupBy().agg((F.max("id") + 1).alias("n")).scalar()
    return runs.run_record(merge.merge_counts(labelled(spark, sf_dir)), next_id, "incremental", F.lit(NOW), F.lit(NOW),
                           F.lit(SINCE), F.lit(None).cast("timestamp"), F.lit("2024.1"))


@check("syn_12_latest_run_version", with_ctes(m.RUNS_SQL, select="""
SELECT id, coalesce(finished_at, started_at) AS logged_at, status FROM runs"""))
def versions(spark, sf_dir):
    """An append-only log with a running and a finished record per run."""
    log = m.runs(spark, sf_dir)
    first = log.select("id", F.col("started_at").alias("logged_at"), F.lit("running").alias("status"))
    last = log.where("finished_at IS NOT NULL").select("id", F.col("finished_at").alias("logged_at"), "status")
    return runs.latest_runs(first.unionByName(last))


# --- watermarks ----------------------------------------------------------------------------

def marks(spark, sf_dir):
    """Marks of some metrics, one of them ahead of the mirror."""
    stat = m.statistic(spark, sf_dir)
    return (stat.where("statistic_id <> 'view'").groupBy("statistic_id")
                .agg(F.when(F.col("statistic_id") == "click", F.max("start_at") + F.expr("INTERVAL 5 DAY"))
                      .otherwise(F.min("start_at") + F.expr("INTERVAL 12 DAY")).alias("source_max_ts"))
                .withColumn("observed_at", instant("2024-01-15")))


MARKS_SQL = f"""
wm AS (SELECT statistic_id, CASE WHEN statistic_id = 'click' THEN max(start_at) + INTERVAL 5 DAY
         ELSE min(start_at) + INTERVAL 12 DAY END AS source_max_ts, {OLD_SQL} AS observed_at
  FROM stat WHERE statistic_id <> 'view' GROUP BY 1)"""


@check("syn_09_advance_watermark", with_ctes(m.statistic_sql(0), MARKS_SQL, select=f"""
SELECT coalesce(w.statistic_id, n.statistic_id) AS statistic_id, greatest(w.source_max_ts, n.newest) AS source_max_ts,
  CASE WHEN n.newest IS NULL THEN w.observed_at ELSE {NOW_SQL} END AS observed_at
FROM wm w FULL JOIN (SELECT statistic_id, max(start_at) AS newest FROM stat WHERE statistic_id <> 'error' GROUP BY 1) n
  ON n.statistic_id = w.statistic_id"""))
def advanced(spark, sf_dir):
    committed = m.statistic(spark, sf_dir).where("statistic_id <> 'error'")
    return merge.advance_watermark(marks(spark, sf_dir), committed, F.lit(NOW))


@check("syn_10_seed_watermark", with_ctes(m.statistic_sql(0), MARKS_SQL, select=f"""
SELECT * FROM wm UNION ALL
SELECT statistic_id, max(start_at), {NOW_SQL} FROM stat WHERE statistic_id NOT IN (SELECT statistic_id FROM wm) GROUP BY 1"""))
def seeded(spark, sf_dir):
    return merge.seed_watermark(marks(spark, sf_dir), m.statistic(spark, sf_dir), F.lit(NOW))


# --- cadence -------------------------------------------------------------------------------

def stamp_rows(spark, sf_dir):
    """Two families of series: hourly stamps per event type, daily stamps per user."""
    ev = m.events(spark, sf_dir)
    hourly = ev.select(F.concat(F.lit("e_"), "state").alias("statistic_id"), F.date_trunc("hour", "ts").alias("start_at"))
    daily = ev.select(F.concat(F.lit("u_"), F.col("entity_id").cast("string")).alias("statistic_id"),
                      F.date_trunc("day", "ts").alias("start_at"))
    return hourly.unionByName(daily).distinct()


def stamp_periods(spark, sf_dir):
    """Hour grain for even users, day for odd ones; some metrics bounded, some coarse, some none."""
    ids = stamp_rows(spark, sf_dir).select("statistic_id").distinct()
    tail = F.substring("statistic_id", -1, 1)
    grain = (F.when(F.col("statistic_id").startswith("e_"), "hour").when(tail.isin("0", "2", "4", "6", "8"), "hour")
              .when(tail == "9", "billing_period").otherwise("day"))
    row = lambda lo, hi, g: F.struct(lo.alias("valid_from"), hi.alias("valid_until"), g.alias("grain"))
    cut = instant("2024-01-08")
    until = F.when(tail == "8", instant("2025-01-01"))
    spans = F.array(row(instant("0001-01-01"), cut, F.lit("billing_period")), row(cut, until, grain))
    return (ids.where(tail != "7").select("statistic_id", F.explode(spans).alias("p"))
               .select("statistic_id", "p.*"))


STAMPS_SQL = """
st AS (SELECT DISTINCT 'e_' || event_type AS statistic_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS t FROM events
  UNION SELECT DISTINCT 'u_' || user_id, CAST(date_trunc('day', ts) AS TIMESTAMP) FROM events),
judged AS (
  SELECT statistic_id, CASE WHEN statistic_id LIKE 'e\\_%' ESCAPE '\\' OR right(statistic_id, 1) IN ('0','2','4','6')
    THEN 'hour' ELSE 'day' END AS grain
  FROM (SELECT DISTINCT statistic_id FROM st) WHERE right(statistic_id, 1) NOT IN ('7', '8', '9')),
inc AS (SELECT * FROM st WHERE t >= TIMESTAMP '2024-01-17 00:00:00'),
old4 AS (SELECT * FROM st WHERE t < TIMESTAMP '2024-01-20 00:00:00' AND t >= TIMESTAMP '2024-01-08 00:00:00'
  QUALIFY row_number() OVER (PARTITION BY statistic_id ORDER BY t DESC) <= 4),
seen AS (SELECT s.* FROM (SELECT * FROM inc UNION SELECT * FROM old4) s JOIN judged USING (statistic_id)
         WHERE t >= TIMESTAMP '2024-01-08 00:00:00'),
gaps AS (SELECT *, epoch(t - lag(t) OVER (PARTITION BY statistic_id ORDER BY t)) AS g FROM seen),
cad AS (SELECT *, CASE WHEN g BETWEEN 1800 AND 7200 THEN 'hour' WHEN g BETWEEN 43200 AND 172800 THEN 'day' END AS c
  FROM gaps WHERE g IS NOT NULL),
outage AS (SELECT statistic_id, max(t) FILTER (WHERE c IS NULL) AS resumed FROM cad GROUP BY 1),
post AS (SELECT c.* FROM cad c JOIN outage o ON o.statistic_id = c.statistic_id WHERE resumed IS NULL OR t > resumed),
facts AS (SELECT statistic_id, count(*) AS n, list(c ORDER BY t DESC) AS cs, list(g ORDER BY t DESC) AS gs FROM post GROUP BY 1),
dec AS (
  SELECT i.statistic_id, resumed, grain, coalesce(n, 0) AS n, cs, gs,
    CASE WHEN len(cs) >= 2 AND cs[1] = cs[2] AND cs[1] <> grain THEN 'halt'
         WHEN resumed IS NOT NULL AND NOT coalesce(len(cs) >= 2 AND cs[1] = cs[2], false) THEN 'hold_tail'
         ELSE 'import_all' END AS action
  FROM (SELECT DISTINCT statistic_id FROM inc) i LEFT JOIN judged USING (statistic_id)
  LEFT JOIN outage USING (statistic_id) LEFT JOIN facts USING (statistic_id)),
decided AS (
  SELECT statistic_id, action, CASE WHEN action = 'hold_tail' THEN resumed END AS hold_from,
    CASE action WHEN 'halt' THEN 'grain ' || grain || ' is configured, but intervals of ' || CAST(gs[2] AS BIGINT) ||
           ' s and ' || CAST(gs[1] AS BIGINT) || ' s both read as ' || cs[1]
         WHEN 'hold_tail' THEN 'cadence since ' || strftime(resumed, '%Y-%m-%dT%H:%M:%S+00:00') || ' is not established ('
           || n || ' interval(s)); holding ' || (n + 1) || ' row(s)' END AS message FROM dec)"""


def decisions(spark, sf_dir):
    rows = stamp_rows(spark, sf_dir)
    return gating.cadence_decision(rows.where(F.col("start_at") < instant("2024-01-20")),
                                   rows.where(F.col("start_at") >= instant("2024-01-17")),
                                   stamp_periods(spark, sf_dir))


@check("syn_06_nearest_cadence", """
SELECT event_id, CASE WHEN g BETWEEN 1800 AND 7200 THEN 'hour' WHEN g BETWEEN 43200 AND 172800 THEN 'day' END AS cadence
FROM (SELECT event_id, value * 700 AS g FROM events)""")
def cadence(spark, sf_dir):
    return m.events(spark, sf_dir).select(
        "event_id", gating.nearest_cadence(F.col("value") * 700).alias("cadence"))


@check("syn_07_cadence_decision", with_ctes(STAMPS_SQL, select="SELECT * FROM decided"))
def decided(spark, sf_dir):
    return decisions(spark, sf_dir)


@check("syn_08_apply_decision", with_ctes(STAMPS_SQL, select="""
SELECT i.statistic_id, i.t AS start_at FROM inc i JOIN decided USING (statistic_id)
WHERE action <> 'halt' AND (hold_from IS NULL OR t < hold_from)"""))
def applied(spark, sf_dir):
    rows = stamp_rows(spark, sf_dir).where(F.col("start_at") >= instant("2024-01-17"))
    return gating.apply_decision(rows, decisions(spark, sf_dir))


@check("syn_08_flag_halted", with_ctes(STAMPS_SQL, select="""
SELECT statistic_id, coalesce(action = 'halt', false) AS grain_review_required
FROM (SELECT DISTINCT statistic_id FROM st) LEFT JOIN decided USING (statistic_id)"""))
def flagged(spark, sf_dir):
    cat = stamp_rows(spark, sf_dir).select("statistic_id").distinct().withColumn("grain_review_required", F.lit(False))
    return gating.flag_halted(cat, decisions(spark, sf_dir))


@check("syn_14_halt_summary", with_ctes(STAMPS_SQL, select="""
SELECT string_agg(statistic_id || ': ' || message, '; ' ORDER BY statistic_id) AS summary FROM decided WHERE action = 'halt'"""))
def summary(spark, sf_dir):
    return gating.halt_summary(decisions(spark, sf_dir))


# --- whole syncs ---------------------------------------------------------------------------

def sync_inputs(spark, sf_dir):
    return dict(stats=source_statistics(spark, sf_dir), meta=source_meta(spark, sf_dir),
                mirror=mirror_table(spark, sf_dir), catalog=m.catalog(spark, sf_dir), periods=m.periods(spark, sf_dir),
                watermarks=marks(spark, sf_dir), now=NOW)


def sync_sql(where, gated=True):
    """The rows a sync merges. Only imported metrics have periods, so only they are gated, each by itself."""
    read = f"SELECT statistic_id, start_at, {grain_of()} AS grain, {VALUES}, reset_at AS last_reset_at FROM src s WHERE {where}"
    gate = f"""
win AS ({read}),
seen AS (
  SELECT statistic_id, start_at AS t FROM win SEMI JOIN per USING (statistic_id) WHERE start_at >= TIMESTAMP '2024-01-21'
  UNION SELECT * FROM (SELECT statistic_id, start_at FROM mir SEMI JOIN per USING (statistic_id)
    WHERE start_at >= TIMESTAMP '2024-01-21' QUALIFY row_number() OVER (PARTITION BY statistic_id ORDER BY start_at DESC) <= 4)),
cad AS (SELECT statistic_id, t, CASE WHEN g BETWEEN 1800 AND 7200 THEN 'hour' WHEN g BETWEEN 43200 AND 172800 THEN 'day' END AS c
  FROM (SELECT statistic_id, t, epoch(t - lag(t) OVER (PARTITION BY statistic_id ORDER BY t)) AS g FROM seen) WHERE g IS NOT NULL),
outage AS (SELECT statistic_id, max(t) FILTER (WHERE c IS NULL) AS resumed FROM cad GROUP BY 1),
post AS (SELECT statistic_id, resumed, list(c ORDER BY t DESC) FILTER (WHERE resumed IS NULL OR t > resumed) AS cs
  FROM cad JOIN outage USING (statistic_id) GROUP BY 1, 2),
inc AS (SELECT win.* FROM win LEFT JOIN post USING (statistic_id)
  WHERE CASE WHEN len(cs) >= 2 AND cs[1] = cs[2] THEN cs[1] = 'hour'
    ELSE start_at < coalesce(resumed, TIMESTAMP '9999-01-01') END)"""
    return (*BOTH, SOURCE_SQL, m.CATALOG_SQL, m.periods_sql(0), gate if gated else f"inc AS ({read})", MERGE_SQL)


@check("syn_03_incremental", with_ctes(*sync_sql(f"start_at >= {NOW_SQL} - INTERVAL 240 HOUR"), select=COUNTS_SQL))
def incremental(spark, sf_dir):
    """Read, gate and merge in one go; where the imported metric is sparse its tail is held."""
    return sync.incremental(**sync_inputs(spark, sf_dir), hours=240).counts


@check("syn_04_repair", with_ctes(*sync_sql(
    f"start_at >= TIMESTAMP '{SINCE}' AND start_at < TIMESTAMP '{UNTIL}'"), select="""
SELECT statistic_id, start_at, merge_label FROM lab"""))
def repaired(spark, sf_dir):
    result = sync.repair(**sync_inputs(spark, sf_dir), lo=SINCE, hi=UNTIL)
    return result.labelled.select("statistic_id", "start_at", "merge_label")


@check("syn_05_backfill", with_ctes(*sync_sql("true", gated=False), f"c AS ({COUNTS_SQL})", select="""
SELECT c.*, coalesce(n, 0) AS problems FROM c LEFT JOIN (SELECT statistic_id, count(*) AS n FROM lab
  WHERE merge_label = 'kept' GROUP BY 1) k ON k.statistic_id = c.statistic_id"""))
def backfilled(spark, sf_dir):
    """Rows the source no longer has stay in the mirror and are the only problems left."""
    result = sync.backfill(**sync_inputs(spark, sf_dir))
    problems = result.problems.groupBy("statistic_id").agg(F.count(F.lit(1)).alias("problems"))
    return result.counts.join(problems, "statistic_id", "left").withColumn("problems", F.coalesce("problems", F.lit(0)))


def stored_inputs(spark, sf_dir):
    """The same inputs with the mirror as a stored table."""
    path = f"{work_dir(spark)}/stored-{uuid.uuid4().hex}"
    inputs = sync_inputs(spark, sf_dir)
    merge.write_months(inputs.pop("mirror"), path)
    return path, inputs


@check("syn_03_stored_incremental", with_ctes(*sync_sql(f"start_at >= {NOW_SQL} - INTERVAL 240 HOUR"), select=COUNTS_SQL))
def stored_incremental(spark, sf_dir):
    path, inputs = stored_inputs(spark, sf_dir)
    return sync.store_incremental(path, **inputs, hours=240).counts


@check("syn_05_stored_backfill", with_ctes(*sync_sql("true", gated=False), select="""
SELECT statistic_id, start_at AS at, 'absent_from_source' AS kind FROM lab WHERE merge_label = 'kept'
UNION ALL SELECT statistic_id, start_at, 'sum' FROM inc WHERE hour(start_at) = 9 AND sum IS NOT NULL"""))
def stored_backfill(spark, sf_dir):
    """Sums spoilt in the stored table after the write are all found."""
    path, inputs = stored_inputs(spark, sf_dir)
    stored = sync.store_backfill(path, **inputs).mirror
    merge.write_months(pin(stored.withColumn("sum", F.when(F.hour("start_at") == 9, F.col("sum") + 1).otherwise(F.col("sum")))), path)
    found = sync.verify_stored(path, inputs["stats"], inputs["meta"], inputs["catalog"], inputs["periods"])
    return found.select("statistic_id", "at", "kind")


# --- reconciliation ------------------------------------------------------------------------

def near(a, b):
    return (f"(({a} IS NULL AND {b} IS NULL) OR coalesce(abs({a} - {b}) <= "
            f"greatest(1e-9 * greatest(abs({a}), abs({b})), 1e-9), false))")


def problem_rows(bounded):
    bound = ("WHERE start_at <= coalesce((SELECT source_max_ts FROM wm w WHERE w.statistic_id = x.statistic_id), "
             "TIMESTAMP '9999-01-01')" if bounded else "")
    fields = "\n".join(
        f"UNION ALL SELECT statistic_id, \"at\", {no}, '{f}', CAST(s_{f} AS VARCHAR), CAST(m_{f} AS VARCHAR) FROM j "
        f"WHERE here AND there AND NOT {near(f's_{f}', f'm_{f}')}"
        for no, f in enumerate(src.MEASURES, start=3))
    cols = ", ".join(f"s.{f} AS s_{f}, m.{f} AS m_{f}" for f in ["grain", *src.MEASURES, "last_reset_at"])
    return f"""
j AS (SELECT coalesce(s.statistic_id, m.statistic_id) AS statistic_id, coalesce(s.start_at, m.start_at) AS "at",
    s.statistic_id IS NOT NULL AS here, m.statistic_id IS NOT NULL AS there, {cols}
  FROM (SELECT * FROM stat x {bound}) s FULL JOIN (SELECT * FROM mir x {bound}) m
    ON m.statistic_id = s.statistic_id AND m.start_at = s.start_at),
prob AS (
SELECT statistic_id, "at", 0 AS kind_no, 'missing_from_mirror' AS kind, CAST(NULL AS VARCHAR) AS source_value,
  CAST(NULL AS VARCHAR) AS mirror_value FROM j WHERE NOT there
UNION ALL SELECT statistic_id, "at", 1, 'absent_from_source', NULL, NULL FROM j WHERE NOT here
UNION ALL SELECT statistic_id, "at", 2, 'grain', s_grain, m_grain FROM j WHERE here AND there AND s_grain <> m_grain
{fields}
UNION ALL SELECT statistic_id, "at", 9, 'last_reset_at', CAST(s_last_reset_at AS VARCHAR), CAST(m_last_reset_at AS VARCHAR)
FROM j WHERE here AND there AND s_last_reset_at IS DISTINCT FROM m_last_reset_at)"""


@check("syn_15_reconcile", with_ctes(*BOTH, problem_rows(False), select="SELECT * FROM prob"))
def reconciled(spark, sf_dir):
    return rec.reconcile(m.statistic(spark, sf_dir), mirror_table(spark, sf_dir))


@check("syn_17_reconcile_bounded", with_ctes(*BOTH, MARKS_SQL, problem_rows(True), select="SELECT * FROM prob"))
def reconciled_bounded(spark, sf_dir):
    return rec.reconcile(m.statistic(spark, sf_dir), mirror_table(spark, sf_dir), marks(spark, sf_dir))


@check("syn_18_limit_problems", with_ctes(*BOTH, problem_rows(False), select="""
SELECT * FROM prob ORDER BY statistic_id, "at", kind_no LIMIT 200"""))
def limited(spark, sf_dir):
    return rec.limit_problems(rec.reconcile(m.statistic(spark, sf_dir), mirror_table(spark, sf_dir)))


@check("syn_16_values_equal", f"""
WITH v AS (SELECT event_id,
  CASE event_id % 7 WHEN 0 THEN NULL WHEN 1 THEN 'nan'::DOUBLE WHEN 2 THEN 'inf'::DOUBLE ELSE value END AS a,
  CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'nan'::DOUBLE WHEN 2 THEN 'inf'::DOUBLE
    WHEN 3 THEN value * (1 + 1e-10) ELSE value * (1 + 1e-7) END AS b FROM events)
SELECT event_id, CASE WHEN a IS NULL OR b IS NULL THEN a IS NULL AND b IS NULL
  WHEN isnan(a) OR isnan(b) THEN isnan(a) AND isnan(b) WHEN isinf(a) OR isinf(b) THEN a = b
  ELSE abs(a - b) <= greatest(1e-9 * greatest(abs(a), abs(b)), 1e-9) END AS same FROM v""")
def equality(spark, sf_dir):
    n, value = F.col("event_id"), F.col("value")
    odd = lambda k: (F.when(n % k == 0, F.lit(None).cast("double")).when(n % k == 1, F.lit(float("nan")))
                      .when(n % k == 2, F.lit(float("inf"))))
    a = odd(7).otherwise(value)
    b = odd(5).when(n % 5 == 3, value * (1 + 1e-10)).otherwise(value * (1 + 1e-7))
    return m.events(spark, sf_dir).select("event_id", values_equal(a, b).alias("same"))


# --- run log -------------------------------------------------------------------------------

RUN_NOW = datetime(2001, 7, 20)
RUN_NOW_SQL = "TIMESTAMP '2001-07-20 00:00:00'"


@check("syn_13_reap_stale", with_ctes(m.RUNS_SQL, select=f"""
SELECT id, CASE WHEN status = 'running' AND started_at < {RUN_NOW_SQL} - INTERVAL 6 HOUR THEN 'abandoned' ELSE status END AS status,
  CASE WHEN status = 'running' AND started_at < {RUN_NOW_SQL} - INTERVAL 6 HOUR
       THEN coalesce(error, 'process died; reaped at startup') ELSE error END AS error FROM runs"""))
def reaped(spark, sf_dir):
    return runs.reap_stale(m.runs(spark, sf_dir), F.lit(RUN_NOW)).select("id", "status", "error")


@check("syn_19_health", with_ctes(m.RUNS_SQL, m.CATALOG_SQL, """
s AS (SELECT max(finished_at) FILTER (WHERE status = 'success' AND mode = 'incremental') AS last_incremental,
  max(finished_at) FILTER (WHERE status = 'success') AS last_success,
  (SELECT count(*) FROM cat WHERE category = 'device_power') AS halted FROM runs)""", select="""
SELECT *, concat_ws('; ', CASE WHEN last_incremental IS NULL THEN 'no incremental run has ever succeeded' END,
  CASE WHEN epoch(TIMESTAMP '2001-12-01' - last_incremental) > 10800 THEN 'last incremental success is ' ||
    CAST(epoch(TIMESTAMP '2001-12-01' - last_incremental) AS BIGINT) || ' s old, limit 10800 s' END,
  CASE WHEN halted > 0 THEN halted || ' metric(s) wait for a grain review' END) AS problems, false AS healthy FROM s"""))
def health(spark, sf_dir):
    cat = m.catalog(spark, sf_dir).withColumn("grain_review_required", F.col("category") == "device_power")
    out = runs.health(m.runs(spark, sf_dir), cat, F.lit(datetime(2001, 12, 1)))
    return out.withColumn("problems", F.array_join("problems", "; "))


@check("syn_20_next_window", with_ctes(m.RUNS_SQL, """
ends AS (SELECT DISTINCT o_orderpriority AS endpoint FROM orders UNION SELECT DISTINCT 'new_' || o_orderstatus FROM orders)""",
                                       select="""
SELECT * FROM (SELECT e.endpoint, coalesce(max(window_end) FILTER (WHERE status = 'success'), DATE '2001-07-20' - 90) AS window_start,
  DATE '2001-07-20' AS window_end FROM ends e LEFT JOIN runs r ON r.endpoint = e.endpoint GROUP BY 1)
WHERE window_start < window_end"""))
def windows(spark, sf_dir):
    log = m.runs(spark, sf_dir)
    fresh = m.table(spark, sf_dir, "orders").select(F.concat(F.lit("new_"), "o_orderstatus").alias("endpoint"))
    ends = log.select("endpoint").unionByName(fresh).distinct()
    return runs.next_window(log, ends, date(2001, 7, 20))


@check("syn_21_endpoint_records", """
SELECT coalesce(i.e, f.e) AS endpoint, CASE WHEN f.e IS NULL THEN n ELSE 0 END AS records_synced,
  CASE WHEN f.e IS NULL THEN 'success' ELSE 'failed' END AS status,
  CASE WHEN f.e IS NOT NULL THEN 'no answer' END AS error
FROM (SELECT event_type AS e, count(*) AS n FROM events GROUP BY 1) i
FULL JOIN (SELECT DISTINCT CASE WHEN event_type = 'error' THEN event_type ELSE event_type || '_v2' END AS e FROM events) f
  ON f.e = i.e""")
def records(spark, sf_dir):
    ingested = m.events(spark, sf_dir).select(F.col("state").alias("endpoint"))
    failures = ingested.distinct().select(
        F.when(F.col("endpoint") == "error", "error").otherwise(F.concat("endpoint", F.lit("_v2"))).alias("endpoint"),
        F.lit("no answer").alias("error"))
    return runs.endpoint_records(ingested, failures)


@check("vw_17_sync_status", with_ctes(m.RUNS_SQL, select="""
SELECT endpoint, window_start, window_end, finished_at AS completed_at, status, records_synced FROM runs
QUALIFY row_number() OVER (PARTITION BY endpoint ORDER BY started_at DESC, id DESC) = 1"""))
def last_run(spark, sf_dir):
    return runs.sync_status(m.runs(spark, sf_dir).withColumnRenamed("finished_at", "completed_at"))
