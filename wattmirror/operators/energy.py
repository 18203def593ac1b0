"""Energy reporting: deltas with quality flags, daily totals, billing periods.

Energy is always the difference of the running total ``sum``. ``state`` is only used where a
person accepted it or where an imported series starts and has nothing to subtract from.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattmirror.functions.timecols import (LOCAL_TZ, expected_hours, local_day, seconds_between)
from wattmirror.functions.values import distinct_from, round_half_up
from wattmirror.plans.ordered import MONTH, ordered_scan

# Categories, sources, seconds per grain, tolerance and the flag names.
ENERGY_CATEGORIES = ["home_energy", "device_energy"]
SEED_SOURCE = "opower"
RECORDER_SOURCE = "recorder"
GRAIN_STEP_SECONDS = {"hour": 3600, "day": 86400}
DISAGREEMENT_KWH = 0.011
CLEAN_FLAGS = ["ok", "seeded_from_state", "reviewed_state", "grain_transition"]
UNRESOLVED_FLAGS = ["negative_delta", "implausible_positive", "source_disagreement",
                    "reviewed_excluded", "review_invalid"]


def with_predecessor(stat: DataFrame) -> DataFrame:
    """Sum, time and grain of the row before, over all grains of a metric."""
    return ordered_scan(stat, ["statistic_id"], "start_at", width=MONTH,
                        previous={"prev_sum": "sum", "prev_at": "start_at", "prev_grain": "grain"})


def with_review(rows: DataFrame, review: DataFrame) -> DataFrame:
    """Attach the human decision about a row, if there is one."""
    decisions = review.select("statistic_id", "start_at", F.col("decision").alias("review_decision"))
    return rows.join(decisions, ["statistic_id", "start_at"], "left")


def covered_hours(prev_at: Column, start_at: Column) -> Column:
    return seconds_between(prev_at, start_at) / 3600.0


def expected_step(grain: Column) -> Column:
    """Seconds to the next row at this grain; irregular billing periods have none."""
    return reduce(lambda chain, g: chain.when(grain == g, F.lit(GRAIN_STEP_SECONDS[g])),
                  GRAIN_STEP_SECONDS, F)


def with_delta(rows: DataFrame, seed_source: str = SEED_SOURCE) -> DataFrame:
    """delta_kwh with its source: reviewed state, then seeding state, then sum difference."""
    has_state = F.col("state").isNotNull()
    no_previous = F.col("prev_sum").isNull()
    source = (F.when((F.col("review_decision") == "accept_state") & has_state, "state_reviewed")
               .when(no_previous & (F.col("source") == seed_source) & has_state, "state")
               .when(~no_previous, "sum_delta"))
    delta = (F.when(F.col("delta_source").isin("state_reviewed", "state"), F.col("state"))
              .when(F.col("delta_source") == "sum_delta", F.col("sum") - F.col("prev_sum")))
    return rows.withColumn("delta_source", source).withColumn("delta_kwh", delta)


def quality_flags() -> Column:
    """The flags that hold for a row, in fixed order; ``ok`` only when none does."""
    c = F.col
    decision = c("review_decision")
    step = expected_step(c("grain"))
    rules: list[tuple[str, Column]] = [
        ("seeded_from_state", c("delta_source") == "state"),
        ("reviewed_state", c("delta_source") == "state_reviewed"),
        ("missing_predecessor", c("delta_kwh").isNull() & c("delta_source").isNull()),
        ("negative_delta", c("delta_kwh") < 0),
        ("grain_transition", c("prev_grain") != c("grain")),
        ("gap", (c("prev_grain") == c("grain")) & (seconds_between("prev_at", "start_at") > step)),
        ("implausible_positive", c("delta_kwh") > c("max_plausible_kw") * c("covered_hours")),
        ("source_disagreement",
         (c("source") != RECORDER_SOURCE)
         & (F.abs(c("state") - (c("sum") - c("prev_sum"))) > DISAGREEMENT_KWH)
         & distinct_from(decision, F.lit("accept_sum"))
         & distinct_from(decision, F.lit("accept_state"))),
        ("reviewed_excluded", decision == "exclude"),
        ("review_invalid", (decision == "accept_state") & c("state").isNull()),
    ]
    raised = F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules]))
    return F.when(F.size(raised) == 0, F.array(F.lit("ok"))).otherwise(raised)


def v_energy(stat: DataFrame, catalog: DataFrame, review: DataFrame,
             seed_source: str = SEED_SOURCE) -> DataFrame:
    """Every row of the energy metrics with its delta, covered interval and flags."""
    meters = (catalog.where(F.col("category").isin(ENERGY_CATEGORIES))
                     .select("statistic_id", "display_name", "category", "energy_role",
                             "max_plausible_kw", "source", "is_active"))
    # The window only carries what it needs; what the catalog says is joined behind the shuffle.
    rows = (stat.select("statistic_id", "start_at", "grain", "sum", "state")
                .join(meters.select("statistic_id"), "statistic_id", "left_semi"))
    rows = with_review(with_predecessor(rows), review).join(meters, "statistic_id")
    rows = with_delta(rows, seed_source)
    rows = rows.withColumn("covered_hours", covered_hours(F.col("prev_at"), F.col("start_at")))
    return rows.select(
        "statistic_id", "display_name", "category", "energy_role", "grain", "is_active",
        "start_at", F.col("prev_at").alias("covered_from"), F.col("start_at").alias("covered_until"),
        "covered_hours", "delta_kwh", "delta_source", "review_decision",
        quality_flags().alias("quality_flags"))


def all_clean(flags: Column) -> Column:
    return F.size(F.array_except(flags, F.array(*map(F.lit, CLEAN_FLAGS)))) == 0


def bucket_class(flags: Column) -> Column:
    """unresolved > unallocated > allocated, each row in exactly one."""
    return (F.when(F.arrays_overlap(flags, F.array(*map(F.lit, UNRESOLVED_FLAGS))), "unresolved")
             .when(F.array_contains(flags, "gap"), "unallocated")
             .when(all_clean(flags), "allocated")
             .otherwise("unknown"))


def v_energy_daily(energy: DataFrame, tz: str = LOCAL_TZ) -> DataFrame:
    """Hourly deltas per metric and local day, split by how far they can be trusted."""
    rows = (energy.where(F.col("grain") == "hour")
                  .select("statistic_id", "display_name", "category", "delta_kwh",
                          local_day("start_at", tz).alias("local_day"),
                          bucket_class(F.col("quality_flags")).alias("cls")))
    of = lambda cls, value: F.when(F.col("cls") == cls, value)
    days = rows.groupBy("statistic_id", "display_name", "category", "local_day").agg(
        F.sum(of("allocated", F.col("delta_kwh"))).alias("allocated_kwh"),
        F.sum(of("unallocated", F.col("delta_kwh"))).alias("unallocated_kwh"),
        F.sum(of("unresolved", F.col("delta_kwh"))).alias("unresolved_kwh"),
        F.count(F.lit(1)).alias("bucket_count"),
        F.count(of("allocated", F.lit(1))).alias("allocated_buckets"),
        F.count(of("unknown", F.lit(1))).alias("unclassified_buckets"))
    days = days.withColumn("expected_buckets", expected_hours("local_day", tz))
    return days.select("*", temporal_coverage().alias("temporal_coverage"),
                       allocation_coverage().alias("allocation_coverage"))


def temporal_coverage() -> Column:
    return round_half_up(F.col("bucket_count") / F.col("expected_buckets"), 4)


def allocation_coverage() -> Column:
    """Attributable share of the accountable energy; unresolved energy is in neither part."""
    allocated = F.coalesce("allocated_kwh", F.lit(0.0))
    accountable = allocated + F.coalesce("unallocated_kwh", F.lit(0.0))
    return round_half_up(F.try_divide(allocated, accountable), 4)


def v_energy_billing(energy: DataFrame) -> DataFrame:
    """Coarse rows at their native grain; billable only when every flag is clean."""
    return (energy.where(F.col("grain").isin("billing_period", "day"))
                  .select("statistic_id", "display_name", "grain", "covered_from", "covered_until",
                          "covered_hours", "delta_kwh", "delta_source", "review_decision",
                          "quality_flags",
                          F.when(all_clean(F.col("quality_flags")), F.col("delta_kwh"))
                           .alias("billable_kwh")))
