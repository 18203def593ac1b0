"""Model tables derived from the given test tables, in Spark and as DuckDB text.

The two halves state the same rules twice on purpose: a check compares them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattmirror.functions.timecols import instant

FIRST_DAY = "2024-01-01"
USERS_PER_HOME = 15
NOW = "2024-02-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State events: one entity per user."""
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").alias("entity_id"), F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type").alias("state"), "value", F.col("props").alias("attrs"))


def metric(event_type: Column, user: Column) -> Column:
    """Metric id: one per event type and home, the first home's without a number, so that metrics grow with the users."""
    home = F.floor(user / USERS_PER_HOME)
    return F.when(home == 0, event_type).otherwise(F.concat_ws("_", event_type, home.cast("string")))


def kind(statistic_id) -> Column:
    """The event type a metric stands for."""
    return F.substring_index(statistic_id, "_", 1)


METRIC_SQL = f"""event_type || CASE WHEN user_id < {USERS_PER_HOME} THEN '' ELSE '_' || CAST(user_id // {USERS_PER_HOME} AS VARCHAR) END"""


def statistic(spark: SparkSession, sf_dir: str, shift_days: int = 0, perturbed: bool = True) -> DataFrame:
    """Statistic rows per metric; purchases are imported and change grain twice.

    The running total runs over rows already grouped to hours, so a series has at most one
    row per hour of history however many events there are.
    """
    base = F.date_add(F.lit(FIRST_DAY).cast("date"), shift_days).cast("timestamp")
    ts = F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + shift_days * 86_400_000_000)
    day_no = F.datediff(ts, base) + 1
    imported = F.col("event_type") == "purchase"
    after = lambda days: F.date_add(F.lit(FIRST_DAY).cast("date"), shift_days + days).cast("timestamp")
    start = (F.when(imported & (day_no <= 4), base)
              .when(imported & (day_no <= 7), after(4))
              .when(imported & (day_no <= 10), after(7))
              .when(imported & (day_no <= 20), F.date_trunc("day", ts))
              .otherwise(F.date_trunc("hour", ts)))
    grain = (F.when(imported & (day_no <= 10), "billing_period")
              .when(imported & (day_no <= 20), "day").otherwise("hour"))
    value = F.col("value").cast("decimal(18,2)")
    grouped = (table(spark, sf_dir, "events")
               .select(metric(F.col("event_type"), F.col("user_id")).alias("statistic_id"), start.alias("start_at"),
                       grain.alias("grain"), value.alias("v"))
               .groupBy("statistic_id", "start_at", "grain")
               .agg(F.sum("v").alias("tot"), F.count(F.lit(1)).alias("n"),
                    F.min("v").alias("mn"), F.max("v").alias("mx")))
    run = F.sum("tot").over(Window.partitionBy("statistic_id").orderBy("start_at")).cast("double")
    eh = (F.unix_seconds("start_at") / 3600).cast("bigint")
    tot = F.col("tot").cast("double")
    state, total = tot, F.col("run")
    if perturbed:
        state = F.when(eh % 59 == 0, F.lit(None)).when(eh % 53 == 0, tot + 1).otherwise(tot)
        total = F.when(eh % 89 == 0, F.lit(None)).when(eh % 97 == 0, F.col("run") - 500).otherwise(F.col("run"))
    return grouped.withColumn("run", run).select(
        "statistic_id", "start_at", "grain", (tot / F.col("n")).alias("mean"),
        F.lit(None).cast("double").alias("mean_weight"),
        F.col("mn").cast("double").alias("min"), F.col("mx").cast("double").alias("max"),
        state.cast("double").alias("state"), total.cast("double").alias("sum"),
        F.lit(None).cast("timestamp").alias("last_reset_at"))


def statistic_sql(shift_days: int = 0, perturbed: bool = True, name: str = "stat") -> str:
    """CTE text of `statistic`, without the leading WITH."""
    base = f"(TIMESTAMP '{FIRST_DAY}' + INTERVAL {shift_days} DAY)"
    state = ("CASE WHEN eh % 59 = 0 THEN NULL WHEN eh % 53 = 0 THEN tot + 1 ELSE tot END"
             if perturbed else "tot")
    total = ("CASE WHEN eh % 89 = 0 THEN NULL WHEN eh % 97 = 0 THEN run - 500 ELSE run END"
             if perturbed else "run")
    return f"""
{name}_ev AS (
  SELECT event_type, {METRIC_SQL} AS statistic_id, CAST(value AS DECIMAL(18,2)) AS v, ts + INTERVAL {shift_days} DAY AS ts,
         date_diff('day', {base}, ts + INTERVAL {shift_days} DAY) + 1 AS d
  FROM events),
{name}_grp AS (
  SELECT statistic_id,
         CASE WHEN event_type = 'purchase' AND d <= 4 THEN {base}
              WHEN event_type = 'purchase' AND d <= 7 THEN {base} + INTERVAL 4 DAY
              WHEN event_type = 'purchase' AND d <= 10 THEN {base} + INTERVAL 7 DAY
              WHEN event_type = 'purchase' AND d <= 20 THEN CAST(date_trunc('day', ts) AS TIMESTAMP)
              ELSE CAST(date_trunc('hour', ts) AS TIMESTAMP) END AS start_at,
         CASE WHEN event_type = 'purchase' AND d <= 10 THEN 'billing_period'
              WHEN event_type = 'purchase' AND d <= 20 THEN 'day' ELSE 'hour' END AS grain,
         sum(v) AS t, count(*) AS n, min(v) AS mn, max(v) AS mx
  FROM {name}_ev GROUP BY 1, 2, 3),
{name}_run AS (
  SELECT *, CAST(t AS DOUBLE) AS tot, epoch_us(start_at) // 3600000000 AS eh,
         CAST(sum(t) OVER (PARTITION BY statistic_id ORDER BY start_at) AS DOUBLE) AS run
  FROM {name}_grp),
{name} AS (
  SELECT statistic_id, start_at, grain, tot / n AS mean, CAST(NULL AS DOUBLE) AS mean_weight,
         CAST(mn AS DOUBLE) AS min, CAST(mx AS DOUBLE) AS max,
         {state} AS state, {total} AS sum, CAST(NULL AS TIMESTAMP) AS last_reset_at
  FROM {name}_run)"""


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One catalog row per metric found in the data."""
    sid, of = F.col("statistic_id"), kind("statistic_id")
    pick = lambda **by: _choose(of, by)
    return (table(spark, sf_dir, "events").select(metric(F.col("event_type"), F.col("user_id")).alias("statistic_id")).distinct()
            .select(
                "statistic_id",
                F.coalesce(pick(signup="environmental_temperature", error="machine_temperature",
                                click="device_power", view="device_energy", purchase="home_energy"),
                           F.lit("device_power")).alias("category"),
                F.concat(F.lit("Meter "), sid).alias("display_name"),
                F.when(of == "purchase", "opower").otherwise("recorder").alias("source"),
                pick(signup="°F", error="°C", click="W", view="kWh", purchase="kWh").alias("unit_of_measurement"),
                pick(signup="temperature", error="temperature", click="power", view="energy",
                     purchase="energy").alias("unit_class"),
                F.when(of.isin("view", "purchase"), 0).otherwise(1).alias("mean_type"),
                of.isin("view", "purchase").alias("has_sum"),
                F.when(of.isin("view", "purchase"), "lifetime").alias("energy_role"),
                F.when(of.isin("view", "purchase"), F.lit(250.0)).alias("max_plausible_kw"),
                F.lit("hour").alias("default_grain"),
                (of != "error").alias("is_active"),
                F.lit(False).alias("grain_review_required"),
                F.lit(None).cast("string").alias("notes")))


def _choose(key, by):
    chain = F
    for name, value in by.items():
        chain = chain.when(key == name, value)
    return chain


CATALOG_SQL = f"""
cat AS (
  SELECT statistic_id,
    CASE kind WHEN 'signup' THEN 'environmental_temperature' WHEN 'error' THEN 'machine_temperature'
      WHEN 'click' THEN 'device_power' WHEN 'view' THEN 'device_energy' WHEN 'purchase' THEN 'home_energy'
      ELSE 'device_power' END AS category,
    'Meter ' || statistic_id AS display_name,
    CASE WHEN kind = 'purchase' THEN 'opower' ELSE 'recorder' END AS source,
    CASE kind WHEN 'signup' THEN '°F' WHEN 'error' THEN '°C' WHEN 'click' THEN 'W'
      WHEN 'view' THEN 'kWh' WHEN 'purchase' THEN 'kWh' END AS unit_of_measurement,
    CASE kind WHEN 'signup' THEN 'temperature' WHEN 'error' THEN 'temperature' WHEN 'click' THEN 'power'
      WHEN 'view' THEN 'energy' WHEN 'purchase' THEN 'energy' END AS unit_class,
    CASE WHEN kind IN ('view','purchase') THEN 0 ELSE 1 END AS mean_type,
    kind IN ('view','purchase') AS has_sum,
    CASE WHEN kind IN ('view','purchase') THEN 'lifetime' END AS energy_role,
    CASE WHEN kind IN ('view','purchase') THEN CAST(250 AS DOUBLE) END AS max_plausible_kw,
    'hour' AS default_grain, kind <> 'error' AS is_active,
    false AS grain_review_required, CAST(NULL AS VARCHAR) AS notes
  FROM (SELECT DISTINCT event_type AS kind, {METRIC_SQL} AS statistic_id FROM events))"""


def periods(spark: SparkSession, sf_dir: str, shift_days: int = 0) -> DataFrame:
    """Reviewed grain periods of the imported metrics: billing, then day, then hour."""
    at = lambda days: F.date_add(F.lit(FIRST_DAY).cast("date"), shift_days + days).cast("timestamp")
    row = lambda lo, hi, grain: F.struct(lo.alias("valid_from"), hi.alias("valid_until"), F.lit(grain).alias("grain"))
    spans = F.array(row(instant("0001-01-01 00:00:00"), at(10), "billing_period"),
                    row(at(10), at(20), "day"),
                    row(at(20), F.lit(None).cast("timestamp"), "hour"))
    return (catalog(spark, sf_dir).where(F.col("source") != "recorder")
            .select("statistic_id", F.explode(spans).alias("p")).select("statistic_id", "p.*"))


def periods_sql(shift_days: int = 0) -> str:
    base = f"TIMESTAMP '{FIRST_DAY}' + INTERVAL {shift_days} DAY"
    return f"""
per AS (
  SELECT statistic_id, unnest([
    {{'valid_from': TIMESTAMP '0001-01-01 00:00:00', 'valid_until': {base} + INTERVAL 10 DAY, 'grain': 'billing_period'}},
    {{'valid_from': {base} + INTERVAL 10 DAY, 'valid_until': {base} + INTERVAL 20 DAY, 'grain': 'day'}},
    {{'valid_from': {base} + INTERVAL 20 DAY, 'valid_until': CAST(NULL AS TIMESTAMP), 'grain': 'hour'}}],
    recursive := true)
  FROM cat WHERE source <> 'recorder')"""


def reviews(stat: DataFrame) -> DataFrame:
    """Decisions about perturbed rows, one broken one, and one excluded day row."""
    eh = (F.unix_seconds("start_at") / 3600).cast("bigint")
    decision = (F.when(eh % 53 == 0, F.element_at(F.array(*map(F.lit, ["accept_sum", "accept_state", "exclude"])),
                                                  (eh % 3 + 1).cast("int")))
                 .when(eh % 59 == 0, "accept_state")
                 .when((F.col("grain") == "day") & (F.dayofmonth("start_at") == 14), "exclude"))
    return (stat.select("statistic_id", "start_at", decision.alias("decision"))
                .where(F.col("decision").isNotNull()))


REVIEW_SQL = """
rev AS (
  SELECT * FROM (
    SELECT statistic_id, start_at,
      CASE WHEN eh % 53 = 0 THEN ['accept_sum','accept_state','exclude'][eh % 3 + 1]
           WHEN eh % 59 = 0 THEN 'accept_state'
           WHEN grain = 'day' AND day(start_at) = 14 THEN 'exclude' END AS decision
    FROM (SELECT *, epoch_us(start_at) // 3600000000 AS eh FROM stat))
  WHERE decision IS NOT NULL)"""


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sync runs, one per order; a repair, an incremental and a backfill mode by priority."""
    start = F.col("o_orderdate").cast("timestamp")
    day = F.to_date("o_orderdate")
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), start.alias("started_at"),
        F.when(status != "P", start + F.expr("INTERVAL 1 HOUR")).alias("finished_at"),
        F.when(F.col("o_orderpriority").startswith("1"), "backfill")
         .when(F.col("o_orderpriority").startswith("2"), "repair").otherwise("incremental").alias("mode"),
        F.col("o_orderpriority").alias("endpoint"),
        F.date_sub(day, 7).alias("window_start"), day.alias("window_end"),
        F.when(status == "O", "success").when(status == "F", "failed").otherwise("running").alias("status"),
        F.when((status == "F") & (F.col("o_orderkey") % 3 != 0),
               F.concat(F.lit("failure "), F.col("o_orderkey").cast("string"))).alias("error"),
        F.when(status == "O", F.col("o_custkey")).cast("bigint").alias("records_synced"))


RUNS_SQL = """
runs AS (
  SELECT o_orderkey AS id, CAST(o_orderdate AS TIMESTAMP) AS started_at,
    CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + INTERVAL 1 HOUR END AS finished_at,
    CASE WHEN o_orderpriority LIKE '1%' THEN 'backfill' WHEN o_orderpriority LIKE '2%' THEN 'repair'
         ELSE 'incremental' END AS mode,
    o_orderpriority AS endpoint,
    CAST(o_orderdate AS DATE) - 7 AS window_start, CAST(o_orderdate AS DATE) AS window_end,
    CASE o_orderstatus WHEN 'O' THEN 'success' WHEN 'F' THEN 'failed' ELSE 'running' END AS status,
    CASE WHEN o_orderstatus = 'F' AND o_orderkey % 3 <> 0 THEN 'failure ' || o_orderkey END AS error,
    CASE WHEN o_orderstatus = 'O' THEN o_custkey END AS records_synced
  FROM orders)"""
