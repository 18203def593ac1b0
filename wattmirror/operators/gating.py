"""Grain resolution and the cadence gate in front of the mirror."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattmirror.functions.timecols import seconds_between
from wattmirror.operators.catalog import overlapping_periods
from wattmirror.plans.ordered import MONTH, ordered_scan, settled

# The cadences an interval can be recognised as, the accepted ratio band, and
# how many stored rows the gate looks back.
CADENCE_SECONDS = {"hour": 3600, "day": 86400}
BAND = (0.5, 2.0)
STORED_TAIL = 4


def resolve_grain(rows: DataFrame, catalog: DataFrame, periods: DataFrame) -> DataFrame:
    """Attach the reviewed grain; NULL where a metric has periods but none holds the row.

    The id is an equi-key, so the period range is only a residual condition of the join.
    """
    spans = periods.select(F.col("statistic_id").alias("__id"), "valid_from", "valid_until",
                           F.col("grain").alias("__grain"))
    inside = ((F.col("statistic_id") == F.col("__id")) & (F.col("valid_from") <= F.col("start_at"))
              & (F.col("valid_until").isNull() | (F.col("start_at") < F.col("valid_until"))))
    reviewed = periods.select("statistic_id").distinct().withColumn("__reviewed", F.lit(True))
    defaults = (catalog.select("statistic_id", "default_grain")
                       .join(reviewed, "statistic_id", "left"))
    grain = F.when(F.col("__reviewed"), F.col("__grain")).otherwise(F.col("default_grain"))
    return (rows.join(defaults, "statistic_id", "left").join(spans, inside, "left")
                .withColumn("grain", grain)
                .drop("__id", "valid_from", "valid_until", "__grain", "__reviewed", "default_grain"))


def unresolved(resolved: DataFrame) -> DataFrame:
    """Rows without a grain: the reviewed periods are out of date."""
    return resolved.where(F.col("grain").isNull()).select("statistic_id", "start_at")


def assert_resolved(resolved: DataFrame) -> DataFrame:
    """Raise on the first row without a grain; never fall back to a default."""
    bad = unresolved(resolved).limit(1).collect()
    if bad:
        raise ValueError(f"{bad[0].statistic_id} has a row at {bad[0].start_at} in no reviewed grain "
                         "period; review the periods, then repair the range")
    return resolved


def assert_disjoint(periods: DataFrame) -> DataFrame:
    """Raise on a reviewed period that begins before an earlier one of its metric has ended, naming the first."""
    bad = overlapping_periods(periods).orderBy("statistic_id", "valid_from").limit(1).collect()
    if bad:
        raise ValueError(f"{bad[0].statistic_id} has reviewed periods that overlap from {bad[0].valid_from} on")
    return periods


def nearest_cadence(gap_seconds: Column) -> Column:
    """The cadence an interval looks like on a log scale; NULL for an outage."""
    def distance(name: str) -> Column:
        ratio = gap_seconds / CADENCE_SECONDS[name]
        return F.when(ratio.between(*BAND), F.abs(F.ln(ratio)))
    hour, day = distance("hour"), distance("day")
    return (F.when(hour.isNull() & day.isNull(), None)
             .when(day.isNull() | (hour <= day), "hour").otherwise("day"))


def judged_metrics(periods: DataFrame) -> DataFrame:
    """Metrics whose last period is open and of hour or day grain, with that period."""
    last = periods.groupBy("statistic_id").agg(
        F.max_by(F.struct("valid_from", "valid_until", "grain"), "valid_from").alias("p"))
    return (last.where(F.col("p.valid_until").isNull() & F.col("p.grain").isin(*CADENCE_SECONDS))
                .select("statistic_id", F.col("p.valid_from").alias("last_from"), F.col("p.grain").alias("grain")))


def observed_stamps(stored: DataFrame, incoming: DataFrame, judged: DataFrame) -> DataFrame:
    """Distinct stamps of the last period: the newest four stored ones and all incoming."""
    newest_first = Window.partitionBy("statistic_id").orderBy(F.col("start_at").desc())
    inside = lambda df: (df.select("statistic_id", "start_at").join(judged, "statistic_id")
                           .where(F.col("start_at") >= F.col("last_from")))
    # row_number <= k is cut to k rows per key and task before the shuffle.
    tail = (inside(stored).withColumn("__rn", F.row_number().over(newest_first))
                          .where(F.col("__rn") <= STORED_TAIL).drop("__rn"))
    return tail.unionByName(inside(incoming)).select("statistic_id", "start_at").distinct()


def cadence_decision(stored: DataFrame, incoming: DataFrame, periods: DataFrame) -> DataFrame:
    """One row per incoming metric: import_all, hold_tail (from hold_from) or halt, with why.

    Rows after an outage are held until two intervals agree; two agreeing intervals against
    the reviewed grain halt the metric.
    """
    judged = judged_metrics(periods)
    stamps = settled(observed_stamps(stored, incoming, judged))
    scan = lambda df, **adds: ordered_scan(df, ["statistic_id"], "start_at", width=MONTH, **adds)

    steps = scan(stamps, previous={"prev_at": "start_at"}).where(F.col("prev_at").isNotNull())
    gap = seconds_between("prev_at", "start_at")
    steps = steps.select("statistic_id", "start_at", F.lit(1).alias("one"), gap.alias("last_gap"),
                         nearest_cadence(gap).alias("last_cadence"))
    steps = scan(settled(steps), total={"n": "one"}, previous={"prior_gap": "last_gap", "prior_cadence": "last_cadence"})
    outage = F.when(F.col("last_cadence").isNull(), F.struct("start_at", "n"))
    # The newest interval tells the last two cadences, the newest outage where they must start.
    evidence = steps.groupBy("statistic_id").agg(
        F.max_by(F.struct("n", "last_gap", "last_cadence", "prior_gap", "prior_cadence"), "start_at").alias("e"),
        F.max(outage).alias("o"))
    evidence = evidence.select("statistic_id", "e.*", F.col("o.start_at").alias("resumed_at"),
                               (F.col("e.n") - F.coalesce("o.n", F.lit(0))).alias("intervals"))

    facts = (incoming.select("statistic_id").distinct().join(judged, "statistic_id", "left")
             .join(evidence, "statistic_id", "left"))
    agree = (F.col("intervals") >= 2) & (F.col("last_cadence") == F.col("prior_cadence"))
    contradicts = agree & (F.col("last_cadence") != F.col("grain"))
    down = F.col("resumed_at").isNotNull()
    action = (F.when(F.coalesce(contradicts, F.lit(False)), "halt")
               .when(down & ~F.coalesce(agree, F.lit(False)), "hold_tail")
               .otherwise("import_all"))
    intervals = F.coalesce("intervals", F.lit(0)).cast("int")
    why = (F.when(F.col("action") == "halt", F.format_string(
                "grain %s is configured, but intervals of %d s and %d s both read as %s",
                F.col("grain"), F.col("prior_gap").cast("bigint"), F.col("last_gap").cast("bigint"),
                F.col("last_cadence")))
            .when(F.col("action") == "hold_tail", F.format_string(
                "cadence since %s is not established (%d interval(s)); holding %d row(s)",
                F.date_format("resumed_at", "yyyy-MM-dd'T'HH:mm:ss'+00:00'"), intervals, intervals + 1)))
    return (facts.withColumn("action", action)
                 .select("statistic_id", "action",
                         F.when(F.col("action") == "hold_tail", F.col("resumed_at")).alias("hold_from"),
                         why.alias("message")))


def apply_decision(rows: DataFrame, decisions: DataFrame) -> DataFrame:
    """The rows that may be imported: none of a halted metric, none from the hold on."""
    verdicts = decisions.select("statistic_id", "action", "hold_from")
    allowed = ((F.col("action") != "halt")
               & (F.col("hold_from").isNull() | (F.col("start_at") < F.col("hold_from"))))
    return rows.join(verdicts, "statistic_id").where(allowed).drop("action", "hold_from")


def flag_halted(catalog: DataFrame, decisions: DataFrame) -> DataFrame:
    """Mark halted metrics as waiting for a grain review."""
    halted = decisions.where("action = 'halt'").select("statistic_id", F.lit(True).alias("__halt"))
    return (catalog.join(halted, "statistic_id", "left")
                   .withColumn("grain_review_required",
                               F.coalesce("__halt", "grain_review_required"))
                   .drop("__halt").select(*catalog.columns))


def halt_summary(decisions: DataFrame) -> DataFrame:
    """One text naming every halted metric in id order, NULL when there is none."""
    return decisions.where("action = 'halt'").groupBy().agg(F.expr(
        "listagg(statistic_id || ': ' || message, '; ') WITHIN GROUP (ORDER BY statistic_id)").alias("summary"))
