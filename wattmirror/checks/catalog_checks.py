"""Catalog operators against their oracles; metric ids are built from the part names."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattmirror.checks import model as m
from wattmirror.checks import reporting_checks as r
from wattmirror.checks.registry import check, with_ctes
from wattmirror.functions import labels
from wattmirror.functions.timecols import instant
from wattmirror.operators import catalog as c

PREFIXES = ["sensor.", "sensor.", "opower:", "sensor.elec_account_", "sensor.pi5_", "sensor.r1_", "sensor."]
SUFFIXES = ["_today_s_consumption", "_total_consumption", "_summation_delivered", "_current_consumption",
            "_instantaneous_demand", "_temperature", "_power", "_this_month_s_consumption",
            "_energy_return", "_energy_cost", "_energy_compensation", "_3d05_x"]
CLASSES = ["temperature", "power", "energy", None, "volume"]


def sql_list(values):
    return "[" + ", ".join("NULL" if v is None else f"'{v}'" for v in values) + "]"


def _nth(values, index):
    return F.element_at(F.array(*map(F.lit, values)), (index % len(values) + 1).cast("int"))


def meta(spark, sf_dir):
    """Source metadata: one metric per part."""
    key = F.col("p_partkey")
    block = F.floor(key / 84)
    device = F.when((key % 84 == 0) & (block < 6), _nth(labels.LIFETIME_DEVICES, block)) \
              .otherwise(F.concat(F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("_"), key.cast("string")))
    sid = F.concat(_nth(PREFIXES, key), device, _nth(SUFFIXES, key))
    return m.table(spark, sf_dir, "part").select(
        key.alias("id"), sid.alias("statistic_id"),
        F.when(key % 5 == 0, "°C").when(key % 5 == 1, "W").when(key % 5 == 2, "kWh").alias("unit_of_measurement"),
        _nth(CLASSES, key).alias("unit_class"), F.when(key % 5 < 2, 1).alias("mean_type"),
        F.when(key % 6 != 0, key % 5 == 2).alias("has_sum"),
        F.when(key % 7 == 2, "opower").otherwise("recorder").alias("source"),
        F.when(key % 4 == 0, F.upper("p_name")).when(key % 4 == 1, "").alias("name"),
        "p_size", "p_type", "p_brand")


META_SQL = f"""
meta AS (
  SELECT p_partkey AS id,
    {sql_list(PREFIXES)}[p_partkey % {len(PREFIXES)} + 1] ||
    CASE WHEN p_partkey % 84 = 0 AND p_partkey // 84 < 6
         THEN {sql_list(labels.LIFETIME_DEVICES)}[p_partkey // 84 % 6 + 1]
         ELSE replace(p_name, ' ', '_') || '_' || p_partkey END ||
    {sql_list(SUFFIXES)}[p_partkey % {len(SUFFIXES)} + 1] AS statistic_id,
    CASE p_partkey % 5 WHEN 0 THEN '°C' WHEN 1 THEN 'W' WHEN 2 THEN 'kWh' END AS unit_of_measurement,
    {sql_list(CLASSES)}[p_partkey % 5 + 1] AS unit_class,
    CASE WHEN p_partkey % 5 < 2 THEN 1 END AS mean_type,
    CASE WHEN p_partkey % 6 <> 0 THEN p_partkey % 5 = 2 END AS has_sum,
    CASE WHEN p_partkey % 7 = 2 THEN 'opower' ELSE 'recorder' END AS source,
    CASE p_partkey % 4 WHEN 0 THEN upper(p_name) WHEN 1 THEN '' END AS name, p_size, p_type, p_brand
  FROM part)"""


def allowlist(source):
    """Metrics somebody reviewed, plus some the source no longer has."""
    listed = source.where("p_size > 10").select(
        "statistic_id",
        F.when(F.col("unit_class") == "energy", "device_energy").otherwise("device_power").alias("category"),
        F.when(F.col("unit_class") == "energy", "lifetime").alias("energy_role"),
        (F.col("p_size") != 50).alias("is_active"))
    gone = source.where("p_size = 1").select(
        F.concat("statistic_id", F.lit("_gone")).alias("statistic_id"), F.lit("device_power").alias("category"),
        F.lit(None).cast("string").alias("energy_role"), F.lit(True).alias("is_active"))
    return listed.unionByName(gone)


ALLOW_SQL = """
allow AS (
  SELECT statistic_id, CASE WHEN unit_class = 'energy' THEN 'device_energy' ELSE 'device_power' END AS category,
    CASE WHEN unit_class = 'energy' THEN 'lifetime' END AS energy_role, p_size <> 50 AS is_active
  FROM meta WHERE p_size > 10
  UNION ALL SELECT statistic_id || '_gone', 'device_power', NULL, true FROM meta WHERE p_size = 1)"""


def overrides(spark, sf_dir):
    return m.table(spark, sf_dir, "part").where("p_type = 'PROMO'").select(
        F.concat(F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("_"), F.col("p_partkey").cast("string")).alias("slug"),
        F.concat(F.lit("Reviewed "), "p_brand").alias("display_name"))


OVERRIDES_SQL = """
over AS (SELECT replace(p_name, ' ', '_') || '_' || p_partkey AS slug, 'Reviewed ' || p_brand AS display_name
  FROM part WHERE p_type = 'PROMO')"""

BASE_SQL = "regexp_replace(statistic_id, '^[^.]*\\.', '')"
for _suffix in labels.LABEL_SUFFIXES:
    BASE_SQL = f"regexp_replace({BASE_SQL}, '{_suffix}$', '')"
LABEL_SQL = f"""
labelled AS (
  SELECT b.*, coalesce(o.display_name, nullif(b.name, ''), array_to_string(list_transform(
      regexp_extract_all(replace(base, '_', ' '), '[a-zA-Z]+|[^a-zA-Z]+'),
      lambda w: upper(w[1:1]) || lower(w[2:])), '')) AS display_name
  FROM (SELECT *, {BASE_SQL} AS base FROM meta) b LEFT JOIN over o ON o.slug = b.base)"""
CEILING_SQL = """CASE WHEN statistic_id LIKE 'opower:%' THEN 25.0 WHEN contains(statistic_id, 'r1_')
  OR contains(statistic_id, 'r2_') OR contains(statistic_id, 'r3_') OR contains(statistic_id, 'aqara_lumi_light')
  THEN 0.05 ELSE 2.0 END::DOUBLE"""
REASON_SQL = f"""CASE
  WHEN suffix(statistic_id, '_this_month_s_consumption') THEN '{labels.MONTHLY_DUPLICATE.reason}'
  WHEN suffix(statistic_id, '_today_s_consumption') THEN
    CASE WHEN regexp_extract(statistic_id, '^.{{7}}(.*)_today_s_consumption$', 1) IN
              ('g1', 'p1', 'p2', 'p3', 'schoolhouse', 'schoolhouse_blue')
         THEN 'superseded by sensor.' || regexp_extract(statistic_id, '^.{{7}}(.*)_today_s_consumption$', 1)
              || '_total_consumption (lifetime meter)'
         ELSE 'unreviewed daily cycle sensor' END
  WHEN starts_with(statistic_id, 'sensor.elec_account_') THEN '{labels.OTHER_EXCLUSIONS[0].reason}'
  WHEN suffix(statistic_id, '_energy_return') THEN '{labels.OTHER_EXCLUSIONS[1].reason}'
  WHEN statistic_id IN ('sensor.computer_energy_this_month_wh', 'sensor.eve_monthly_cycle')
    THEN '{labels.OTHER_EXCLUSIONS[2].reason}'
  WHEN starts_with(statistic_id, 'sensor.pi5_') AND unit_class = 'temperature' THEN '{labels.OTHER_EXCLUSIONS[3].reason}'
  WHEN suffix(statistic_id, '_energy_cost') OR suffix(statistic_id, '_energy_compensation')
    THEN '{labels.OTHER_EXCLUSIONS[4].reason}' END"""


@check("src_04_available_metrics", with_ctes(META_SQL, ALLOW_SQL, select="""
SELECT statistic_id, statistic_id IN (SELECT statistic_id FROM meta) AS available FROM allow"""))
def available(spark, sf_dir):
    from wattmirror.sources.statistics import available_metrics
    source = meta(spark, sf_dir)
    todo, missing = available_metrics(allowlist(source).select("statistic_id"), source)
    return (todo.withColumn("available", F.lit(True))
                .unionByName(missing.withColumn("available", F.lit(False))))


def catalog_like(source, **changed):
    """A full catalog row per part, with some columns replaced."""
    base = {
        "statistic_id": F.col("statistic_id"), "category": F.lit("device_energy"), "display_name": F.lit("old name"),
        "source": F.col("source"), "unit_of_measurement": F.col("unit_of_measurement"),
        "unit_class": F.col("unit_class"), "mean_type": F.col("mean_type"), "has_sum": F.lit(True),
        "energy_role": F.lit("lifetime"), "max_plausible_kw": F.lit(2.0), "default_grain": F.lit("hour"),
        "is_active": F.lit(True), "grain_review_required": F.col("p_size") > 20, "notes": F.col("p_brand")}
    return source.select(*[v.alias(k) for k, v in {**base, **changed}.items()])


@check("cat_01_upsert_catalog", with_ctes(META_SQL, select="""
SELECT coalesce(o.statistic_id, n.statistic_id) AS statistic_id,
  CASE WHEN n.statistic_id IS NULL THEN 'device_energy' ELSE 'device_power' END AS category,
  CASE WHEN n.statistic_id IS NULL THEN 'old name' ELSE n.p_type END AS display_name,
  CASE WHEN n.statistic_id IS NULL THEN 'lifetime' END AS energy_role,
  CASE WHEN n.statistic_id IS NULL THEN CAST(2 AS DOUBLE) END AS max_plausible_kw,
  CASE WHEN o.statistic_id IS NULL THEN false ELSE o.p_size > 20 END AS grain_review_required, o.p_brand AS notes
FROM (SELECT * FROM meta WHERE p_size <= 30) o
FULL JOIN (SELECT * FROM meta WHERE p_size >= 20) n ON n.statistic_id = o.statistic_id"""))
def upsert(spark, sf_dir):
    source = meta(spark, sf_dir)
    null = lambda t: F.lit(None).cast(t)
    new = catalog_like(source.where("p_size >= 20"), category=F.lit("device_power"), display_name=F.col("p_type"),
                       energy_role=null("string"), max_plausible_kw=null("double")).drop("grain_review_required", "notes")
    merged = c.upsert_catalog(catalog_like(source.where("p_size <= 30")), new)
    return merged.select("statistic_id", "category", "display_name", "energy_role", "max_plausible_kw",
                         "grain_review_required", "notes")


# Periods made from the orders of each customer, dirty in every way the checks know.
DIRTY_SQL = f"""
per AS (
  SELECT 'meter_' || o_custkey AS statistic_id,
    CASE WHEN o_orderpriority LIKE '1%' THEN TIMESTAMP '{c.OPEN_PAST}' ELSE CAST(o_orderdate AS TIMESTAMP) END AS valid_from,
    max(CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS TIMESTAMP) + to_days(CAST(o_orderkey % 400 AS INTEGER)) END)
      AS valid_until,
    min(CASE o_orderstatus WHEN 'O' THEN 'hour' WHEN 'F' THEN 'day' ELSE 'minute' END) AS grain
  FROM orders GROUP BY 1, 2)"""


def dirty_periods(spark, sf_dir):
    """Grouped by numbers, grains by their place in the alphabet, and named afterwards: text could only be sorted for it."""
    at = F.col("o_orderdate").cast("timestamp")
    status = F.col("o_orderstatus")
    ends = F.when(status != "P", at + F.make_dt_interval(days=(F.col("o_orderkey") % 400).cast("int")))
    grains = ["day", "hour", "minute"]
    return (m.table(spark, sf_dir, "orders")
            .select("o_custkey", F.when(F.col("o_orderpriority").startswith("1"), instant(c.OPEN_PAST)).otherwise(at).alias("valid_from"),
                    ends.alias("ends"), F.when(status == "O", 1).when(status == "F", 0).otherwise(2).alias("g"))
            .groupBy("o_custkey", "valid_from").agg(F.max("ends").alias("valid_until"), F.min("g").alias("g"))
            .select(F.concat(F.lit("meter_"), F.col("o_custkey").cast("string")).alias("statistic_id"), "valid_from", "valid_until",
                    F.element_at(F.array(*map(F.lit, grains)), F.col("g") + 1).alias("grain")))


def as_text(df, *names):
    return df.withColumns({n: F.date_format(n, "yyyy-MM-dd HH:mm:ss") for n in names})


PERIOD_TEXT = ("strftime(valid_from, '%Y-%m-%d %H:%M:%S') AS valid_from, "
               "strftime(valid_until, '%Y-%m-%d %H:%M:%S') AS valid_until")


@check("cat_02_replace_periods", with_ctes(DIRTY_SQL, m.CATALOG_SQL, """
neu AS (SELECT statistic_id, min(valid_from) AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_until, 'hour' AS grain
  FROM per WHERE grain = 'minute' GROUP BY 1)""", select=f"""
SELECT statistic_id, {PERIOD_TEXT}, grain FROM (
  SELECT * FROM per WHERE statistic_id NOT IN (SELECT statistic_id FROM neu) UNION ALL SELECT * FROM neu)"""))
def replace(spark, sf_dir):
    old = dirty_periods(spark, sf_dir)
    new = (old.where("grain = 'minute'").groupBy("statistic_id").agg(F.min("valid_from").alias("valid_from"))
              .select("statistic_id", "valid_from", F.lit(None).cast("timestamp").alias("valid_until"),
                      F.lit("hour").alias("grain")))
    return as_text(c.replace_periods(old, new), "valid_from", "valid_until")


@check("cat_03_validate_periods", with_ctes(DIRTY_SQL, """
w AS (SELECT *, row_number() OVER x AS rn, lead(valid_from) OVER x AS nxt, lead(1) OVER x AS has_next
  FROM per WINDOW x AS (PARTITION BY statistic_id ORDER BY valid_from))""", select=f"""
SELECT statistic_id, {PERIOD_TEXT}, grain, kind FROM (
  SELECT *, 'late_start' AS kind FROM w WHERE rn = 1 AND valid_from > TIMESTAMP '{c.OPEN_PAST}'
  UNION ALL SELECT *, 'closed_end' FROM w WHERE has_next IS NULL AND valid_until IS NOT NULL
  UNION ALL SELECT *, 'open_middle' FROM w WHERE has_next = 1 AND valid_until IS NULL
  UNION ALL SELECT *, 'gap' FROM w WHERE has_next = 1 AND valid_until < nxt
  UNION ALL SELECT *, 'overlap' FROM w WHERE has_next = 1 AND valid_until > nxt)"""))
def validate(spark, sf_dir):
    return as_text(c.validate_periods(dirty_periods(spark, sf_dir)), "valid_from", "valid_until")


@check("cat_04_overlapping_periods", with_ctes(DIRTY_SQL, select=f"""
SELECT statistic_id, {PERIOD_TEXT}, grain FROM per a WHERE EXISTS (
  SELECT 1 FROM per b WHERE b.statistic_id = a.statistic_id AND b.valid_from < a.valid_from
    AND coalesce(b.valid_until, TIMESTAMP '{c.OPEN_FUTURE}') > a.valid_from)"""))
def overlapping(spark, sf_dir):
    return as_text(c.overlapping_periods(dirty_periods(spark, sf_dir)), "valid_from", "valid_until")


DIRTY_CATALOG_SQL = """
dc AS (SELECT statistic_id, CASE WHEN p_size = 7 THEN 'oops' WHEN p_size > 25 THEN 'device_energy' ELSE 'device_power' END AS category,
    CASE WHEN p_size = 30 THEN 'yearly' WHEN p_size > 20 THEN 'cycle' END AS energy_role,
    CASE WHEN p_size = 40 THEN CAST(-1 AS DOUBLE) WHEN p_size > 22 THEN CAST(2 AS DOUBLE) END AS max_plausible_kw,
    CASE WHEN p_size = 8 THEN 'week' WHEN p_size <> 9 THEN 'hour' END AS default_grain
  FROM (SELECT * FROM meta UNION ALL SELECT * FROM meta WHERE p_size = 3))"""


@check("cat_05_catalog_constraints", with_ctes(META_SQL, DIRTY_CATALOG_SQL, select="""
SELECT 'category' AS rule, statistic_id AS row_key FROM dc WHERE category NOT IN
  ('environmental_temperature','machine_temperature','home_energy','device_energy','device_power')
UNION ALL SELECT 'energy_role', statistic_id FROM dc WHERE energy_role NOT IN ('lifetime','cycle')
UNION ALL SELECT 'role_iff_energy', statistic_id FROM dc
  WHERE (category IN ('home_energy','device_energy')) <> (energy_role IS NOT NULL)
UNION ALL SELECT 'ceiling_iff_energy', statistic_id FROM dc
  WHERE (category IN ('home_energy','device_energy')) <> (max_plausible_kw IS NOT NULL)
UNION ALL SELECT 'ceiling_positive', statistic_id FROM dc WHERE NOT max_plausible_kw > 0
UNION ALL SELECT 'default_grain', statistic_id FROM dc WHERE default_grain NOT IN ('hour','day','billing_period')
UNION ALL SELECT 'primary_key', statistic_id FROM dc GROUP BY statistic_id HAVING count(*) > 1"""))
def catalog_constraints(spark, sf_dir):
    source = meta(spark, sf_dir)
    source = source.unionByName(source.where("p_size = 3"))
    size = F.col("p_size")
    dirty = catalog_like(
        source, category=F.when(size == 7, "oops").when(size > 25, "device_energy").otherwise("device_power"),
        energy_role=F.when(size == 30, "yearly").when(size > 20, "cycle"),
        max_plausible_kw=F.when(size == 40, F.lit(-1.0)).when(size > 22, F.lit(2.0)),
        default_grain=F.when(size == 8, "week").when(size != 9, "hour"))
    return c.constraint_violations(dirty, c.catalog_rules())


@check("cat_05_period_constraints", with_ctes(DIRTY_SQL, select="""
SELECT 'grain' AS rule, statistic_id || '|' || strftime(valid_from, '%Y-%m-%d %H:%M:%S') AS row_key FROM per
WHERE grain NOT IN ('hour','day','billing_period')
UNION ALL SELECT 'range_order', statistic_id || '|' || strftime(valid_from, '%Y-%m-%d %H:%M:%S') FROM per
WHERE NOT valid_until > valid_from
UNION ALL SELECT 'foreign_key_statistic_id', statistic_id || '|' || strftime(valid_from, '%Y-%m-%d %H:%M:%S') FROM per
WHERE statistic_id NOT IN (SELECT 'meter_' || c_custkey FROM customer WHERE c_acctbal > 0)"""))
def period_constraints(spark, sf_dir):
    known = m.table(spark, sf_dir, "customer").where("c_acctbal > 0").select(
        F.concat(F.lit("meter_"), F.col("c_custkey").cast("string")).alias("statistic_id"))
    return c.constraint_violations(dirty_periods(spark, sf_dir), c.period_rules(),
                                   {"statistic_id": (known, "statistic_id")})


@check("cat_05_run_constraints", with_ctes(m.RUNS_SQL, select="""
SELECT 'status' AS rule, CAST(id AS VARCHAR) AS row_key FROM runs WHERE status = 'failed'
UNION ALL SELECT 'rows_read_not_negative', CAST(id AS VARCHAR) FROM runs WHERE records_synced < 500"""))
def run_constraints(spark, sf_dir):
    runs = m.runs(spark, sf_dir)
    zero = F.lit(0).cast("bigint")
    dirty = runs.withColumn("status", F.when(F.col("status") == "failed", "broken").otherwise(F.col("status"))).select(
        "id", "mode", "status", (F.col("records_synced") - 500).alias("rows_read"), zero.alias("rows_inserted"),
        zero.alias("rows_updated"), F.lit(None).cast("bigint").alias("rows_unchanged"))
    return c.constraint_violations(dirty, c.run_rules())


@check("cat_05_fact_constraints", with_ctes(m.statistic_sql(0), m.CATALOG_SQL, m.REVIEW_SQL, select="""
SELECT 'grain' AS rule, statistic_id || '|' || strftime(start_at, '%Y-%m-%d %H:%M:%S') AS row_key FROM stat WHERE grain = 'day'
UNION ALL SELECT 'decision', statistic_id || '|' || strftime(start_at, '%Y-%m-%d %H:%M:%S') FROM rev WHERE decision = 'exclude'"""))
def fact_constraints(spark, sf_dir):
    stat = m.statistic(spark, sf_dir)
    rev = m.reviews(stat)
    odd = lambda col, old, new: F.when(F.col(col) == old, new).otherwise(F.col(col))
    facts = stat.withColumn("grain", odd("grain", "day", "dag"))
    notes = rev.withColumn("decision", odd("decision", "exclude", "drop"))
    return (c.constraint_violations(facts, c.statistic_rules(), {"statistic_id": (m.catalog(spark, sf_dir), "statistic_id")})
             .unionByName(c.constraint_violations(notes, c.review_rules())))


@check("cat_06_catalog_drift", with_ctes(META_SQL, ALLOW_SQL, select="""
SELECT 'only_config' AS side, statistic_id FROM allow WHERE statistic_id NOT IN (SELECT statistic_id FROM meta WHERE p_size < 45)
UNION ALL SELECT 'only_catalog', statistic_id FROM meta WHERE p_size < 45
  AND statistic_id NOT IN (SELECT statistic_id FROM allow)"""))
def drift(spark, sf_dir):
    source = meta(spark, sf_dir)
    return c.catalog_drift(allowlist(source), source.where("p_size < 45"))


@check("cat_07_selected_metrics", with_ctes(META_SQL, select="SELECT statistic_id FROM meta WHERE NOT p_size > 20"))
def selected(spark, sf_dir):
    return c.selected_metrics(catalog_like(meta(spark, sf_dir)))


@check("cat_08_discovery_audit", with_ctes(META_SQL, ALLOW_SQL, select=f"""
SELECT *, reason IS NOT NULL AS reviewed FROM (
  SELECT statistic_id, {REASON_SQL} AS reason FROM meta
  WHERE (unit_class IN ('temperature', 'power', 'energy') OR starts_with(statistic_id, 'opower:'))
    AND statistic_id NOT IN (SELECT statistic_id FROM allow))"""))
def audit(spark, sf_dir):
    source = meta(spark, sf_dir)
    return c.discovery_audit(source, allowlist(source))


@check("cat_09_exclusion_reason", with_ctes(META_SQL, select=f"SELECT id, statistic_id, {REASON_SQL} AS reason FROM meta"))
def reason(spark, sf_dir):
    return meta(spark, sf_dir).select(
        "id", "statistic_id", labels.exclusion_reason(F.col("statistic_id"), F.col("unit_class")).alias("reason"))


@check("cat_10_ceiling", with_ctes(META_SQL, select=f"SELECT id, {CEILING_SQL} AS ceiling_kw FROM meta"))
def ceiling(spark, sf_dir):
    return meta(spark, sf_dir).select("id", labels.ceiling_kw(F.col("statistic_id")).alias("ceiling_kw"))


@check("cat_11_label", with_ctes(META_SQL, OVERRIDES_SQL, LABEL_SQL, select="SELECT id, display_name FROM labelled"))
def display(spark, sf_dir):
    return c.label(meta(spark, sf_dir), overrides(spark, sf_dir)).select("id", "display_name")


@check("cat_12_exclude_globs", with_ctes(META_SQL, select="""
SELECT id, statistic_id FROM meta WHERE NOT regexp_matches(statistic_id, '^sensor\\..*_power$')
  AND NOT starts_with(statistic_id, 'sensor.pi5_') AND NOT regexp_matches(statistic_id, '_1._today_s_consumption$')"""))
def globs(spark, sf_dir):
    return c.exclude_globs(meta(spark, sf_dir), ["sensor.*_power", "sensor.pi5_*", "*_1?_today_s_consumption"]) \
            .select("id", "statistic_id")


@check("cat_13_build_catalog", with_ctes(META_SQL, ALLOW_SQL, OVERRIDES_SQL, LABEL_SQL, select=f"""
SELECT a.statistic_id, a.category, l.display_name, l.source, l.unit_of_measurement, l.unit_class, l.mean_type,
  CASE WHEN l.id IS NOT NULL THEN coalesce(l.has_sum, false) END AS has_sum, a.energy_role,
  CASE WHEN a.energy_role IS NOT NULL THEN {CEILING_SQL.replace('statistic_id', 'a.statistic_id')} END AS max_plausible_kw,
  CASE WHEN l.id IS NOT NULL THEN 'hour' END AS default_grain, a.is_active, l.id IS NULL AS missing
FROM allow a LEFT JOIN labelled l ON l.statistic_id = a.statistic_id"""))
def build(spark, sf_dir):
    source = meta(spark, sf_dir)
    allow = allowlist(source)
    rows, missing = c.build_catalog(allow, source, overrides(spark, sf_dir))
    lost = missing.join(allow, "statistic_id").withColumn("missing", F.lit(True))
    return rows.withColumn("missing", F.lit(False)).unionByName(lost, allowMissingColumns=True)


@check("cat_14_grain_partition", with_ctes(m.statistic_sql(0), select=f"""
SELECT coalesce(f.statistic_id, x.statistic_id) AS statistic_id, coalesce(f.grain, x.grain) AS grain,
  coalesce(rows, 0) AS rows, coalesce(expected, 0) AS expected, coalesce(rows, 0) = coalesce(expected, 0) AS matches
FROM (SELECT statistic_id, grain, count(*) AS rows FROM stat GROUP BY 1, 2) f
FULL JOIN (SELECT {m.METRIC_SQL} AS statistic_id, CASE WHEN event_type = 'purchase' THEN 'day' ELSE 'hour' END AS grain,
             count(DISTINCT date_trunc('hour', ts)) AS expected FROM events GROUP BY 1, 2) x
  ON x.statistic_id = f.statistic_id AND x.grain = f.grain"""))
def partition(spark, sf_dir):
    expected = (m.events(spark, sf_dir)
                .select(m.metric(F.col("state"), F.col("entity_id")).alias("statistic_id"),
                        F.when(F.col("state") == "purchase", "day").otherwise("hour").alias("grain"),
                        F.date_trunc("hour", "ts").alias("h"))
                .groupBy("statistic_id", "grain").agg(F.countDistinct("h").alias("expected")))
    return c.grain_partition(m.statistic(spark, sf_dir), expected)
