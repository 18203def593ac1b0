"""The reviewed catalog: building it, changing it, and checking that it holds together."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattmirror.functions.labels import (IMPORTED_PREFIX, ceiling_kw, exclusion_reason, glob_regex,
                                         label_base, title_slug)
from wattmirror.functions.timecols import instant
from wattmirror.plans.ordered import MONTH, ordered_scan

# The allowed words of the model, the columns a review owns, the open past.
CATEGORIES = ("environmental_temperature", "machine_temperature", "home_energy", "device_energy",
              "device_power")
ENERGY = ("home_energy", "device_energy")
ROLES = ("lifetime", "cycle")
GRAINS = ("hour", "day", "billing_period")
DECISIONS = ("accept_sum", "accept_state", "exclude")
MODES = ("backfill", "incremental", "repair")
STATUSES = ("running", "success", "failed", "abandoned")
COUNTERS = ("rows_read", "rows_inserted", "rows_updated", "rows_unchanged")
REVIEWED = ("category", "display_name", "source", "unit_of_measurement", "unit_class", "mean_type",
            "has_sum", "energy_role", "max_plausible_kw", "default_grain", "is_active")
AUDITED_CLASSES = ("temperature", "power", "energy")
OPEN_PAST = "0001-01-01 00:00:00"
OPEN_FUTURE = "9999-12-31 23:59:59"


def upsert_catalog(catalog: DataFrame, reviewed: DataFrame) -> DataFrame:
    """Reviewed columns take the new value, NULL included; the rest keep what they had."""
    old, new = catalog.alias("old"), reviewed.withColumn("__new", F.lit(True)).alias("new")
    joined = old.join(new, F.col("old.statistic_id") == F.col("new.statistic_id"), "full_outer")
    is_new = F.col("new.__new").isNotNull()
    known = F.col("old.statistic_id").isNotNull()
    out = [F.coalesce("old.statistic_id", "new.statistic_id").alias("statistic_id")]
    defaults = {"grain_review_required": F.lit(False)}
    for name in catalog.columns[1:]:
        if name in REVIEWED:
            out.append(F.when(is_new, F.col(f"new.{name}")).otherwise(F.col(f"old.{name}")).alias(name))
        else:
            out.append(F.when(known, F.col(f"old.{name}")).otherwise(defaults.get(name, F.lit(None))).alias(name))
    return joined.select(*out)


def replace_periods(periods: DataFrame, new: DataFrame) -> DataFrame:
    """Drop every period of the metrics named in ``new`` and put the new ones in."""
    return (periods.join(new.select("statistic_id").distinct(), "statistic_id", "left_anti")
                   .unionByName(new.select(*periods.columns)))


def validate_periods(periods: DataFrame) -> DataFrame:
    """Places where a metric's periods do not cover the whole timeline exactly once.

    Kinds: late_start, closed_end, open_middle, gap, overlap.
    """
    marked = periods.withColumn("present", F.lit(True))
    rows = ordered_scan(marked, ["statistic_id"], "valid_from", ["valid_until"], width=12 * MONTH,
                        previous={"has_previous": "present"},
                        following={"next_from": "valid_from", "has_next": "present"})
    c = F.col
    first, last = c("has_previous").isNull(), c("has_next").isNull()
    kinds = F.array_compact(F.array(
        F.when(first & (c("valid_from") > instant(OPEN_PAST)), "late_start"),
        F.when(last & c("valid_until").isNotNull(), "closed_end"),
        F.when(~last & c("valid_until").isNull(), "open_middle")
         .when(~last & (c("valid_until") < c("next_from")), "gap")
         .when(~last & (c("valid_until") > c("next_from")), "overlap")))
    return rows.select("statistic_id", "valid_from", "valid_until", "grain", F.explode(kinds).alias("kind"))


def overlapping_periods(periods: DataFrame) -> DataFrame:
    """Periods starting before an earlier one of the same metric has ended."""
    ends = periods.withColumn("ends_at", F.coalesce("valid_until", instant(OPEN_FUTURE)))
    scanned = ordered_scan(ends, ["statistic_id"], "valid_from", ["ends_at"], width=12 * MONTH,
                           highest={"covered_until": "ends_at"})
    return (scanned.where(F.col("covered_until") > F.col("valid_from"))
                   .select("statistic_id", "valid_from", "valid_until", "grain"))


# --- constraints ---------------------------------------------------------------------------

@dataclass(frozen=True)
class Rules:
    """Row rules (violated only when FALSE), a primary key, and foreign keys."""

    rows: dict[str, Column]
    key: tuple[str, ...] = ()


def catalog_rules() -> Rules:
    energy = F.col("category").isin(*ENERGY)
    ceiling = F.col("max_plausible_kw")
    return Rules({
        "category": F.col("category").isin(*CATEGORIES),
        "energy_role": F.col("energy_role").isin(*ROLES),
        "role_iff_energy": energy == F.col("energy_role").isNotNull(),
        "ceiling_iff_energy": energy == ceiling.isNotNull(),
        "ceiling_positive": ceiling > 0,
        "default_grain": F.col("default_grain").isin(*GRAINS),
    }, ("statistic_id",))


def period_rules() -> Rules:
    return Rules({"grain": F.col("grain").isin(*GRAINS),
                  "range_order": F.col("valid_until") > F.col("valid_from")},
                 ("statistic_id", "valid_from"))


def statistic_rules() -> Rules:
    return Rules({"grain": F.col("grain").isin(*GRAINS)}, ("statistic_id", "start_at"))


def review_rules() -> Rules:
    return Rules({"decision": F.col("decision").isin(*DECISIONS)}, ("statistic_id", "start_at"))


def run_rules() -> Rules:
    checks = {"mode": F.col("mode").isin(*MODES), "status": F.col("status").isin(*STATUSES)}
    return Rules(checks | {f"{c}_not_negative": F.col(c) >= 0 for c in COUNTERS}, ("id",))


def constraint_violations(df: DataFrame, rules: Rules,
                          foreign: dict[str, tuple[DataFrame, str]] | None = None) -> DataFrame:
    """(rule, row_key) of every row breaking a rule, a key, or a foreign key.

    All row rules are judged in one pass; like a CHECK, a NULL result passes.
    """
    row_key = F.concat_ws("|", *[F.col(k).cast("string") for k in rules.key])
    used = [c for c in df.columns if c != "data"]
    broken = F.array_compact(F.array(*[F.when(~test, F.lit(name)) for name, test in rules.rows.items()]))
    found = df.select(*used).select(F.explode(broken).alias("rule"), row_key.alias("row_key"))
    twice = (df.groupBy(*rules.key).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
               .select(F.lit("primary_key").alias("rule"), row_key.alias("row_key")))
    found = found.unionByName(twice)
    for column, (parent, parent_key) in (foreign or {}).items():
        known = parent.select(F.col(parent_key).alias(column)).distinct()
        orphans = (df.where(F.col(column).isNotNull()).join(known, column, "left_anti")
                     .select(F.lit(f"foreign_key_{column}").alias("rule"), row_key.alias("row_key")))
        found = found.unionByName(orphans)
    return found


# --- contract checks -----------------------------------------------------------------------

def catalog_drift(config: DataFrame, catalog: DataFrame) -> DataFrame:
    """Ids that only the configuration or only the catalog knows, sorted."""
    a = config.select("statistic_id").distinct().withColumn("in_config", F.lit(True))
    b = catalog.select("statistic_id").distinct().withColumn("in_catalog", F.lit(True))
    side = (F.when(F.col("in_catalog").isNull(), "only_config")
             .when(F.col("in_config").isNull(), "only_catalog"))
    return (a.join(b, "statistic_id", "full_outer").select(side.alias("side"), "statistic_id")
             .where(F.col("side").isNotNull()).orderBy("side", "statistic_id"))


def selected_metrics(catalog: DataFrame) -> DataFrame:
    """Metrics that may be exported: all that do not wait for a grain review."""
    return catalog.where(~F.col("grain_review_required")).select("statistic_id").orderBy("statistic_id")


def discovery_audit(meta: DataFrame, catalog: DataFrame) -> DataFrame:
    """Relevant source metrics outside the allowlist, with the reason or marked unreviewed."""
    sid, unit_class = F.col("statistic_id"), F.col("unit_class")
    relevant = meta.where(unit_class.isin(*AUDITED_CLASSES) | sid.startswith(IMPORTED_PREFIX))
    unlisted = relevant.join(catalog.select("statistic_id"), "statistic_id", "left_anti")
    return (unlisted.select("statistic_id", exclusion_reason(sid, unit_class).alias("reason"))
                    .withColumn("reviewed", F.col("reason").isNotNull()))


def exclude_globs(df: DataFrame, globs: list[str], column: str = "statistic_id") -> DataFrame:
    """Drop series whose id matches any of the globs."""
    if not globs:
        return df
    return df.where(~F.col(column).rlike("|".join(glob_regex(g) for g in globs)))


def label(ids: DataFrame, overrides: DataFrame, source_name: str = "name") -> DataFrame:
    """Add display_name: reviewed name, else the source's, else the titled slug."""
    base = label_base(F.col("statistic_id"))
    named = ids.withColumn("label_base", base).join(
        overrides.select(F.col("slug").alias("label_base"), F.col("display_name").alias("__override")),
        "label_base", "left")
    upstream = F.when(F.col(source_name) != "", F.col(source_name))
    return named.withColumn("display_name", F.coalesce("__override", upstream, title_slug(F.col("label_base")))) \
                .drop("__override", "label_base")


def build_catalog(allow: DataFrame, meta: DataFrame, overrides: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Catalog rows from the grouped allowlist, and the allowed ids the source lacks.

    ``allow``: statistic_id, category, energy_role, is_active.
    """
    sid = F.col("statistic_id")
    known = allow.join(meta.drop("id"), "statistic_id")
    rows = label(known, overrides).select(
        "statistic_id", "category", "display_name", "source", "unit_of_measurement", "unit_class",
        "mean_type", F.coalesce("has_sum", F.lit(False)).alias("has_sum"), "energy_role",
        F.when(F.col("energy_role").isNotNull(), ceiling_kw(sid)).alias("max_plausible_kw"),
        F.lit("hour").alias("default_grain"), "is_active")
    missing = allow.join(meta.select("statistic_id"), "statistic_id", "left_anti").select("statistic_id")
    return rows, missing


def grain_partition(stat: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows per metric and grain next to the expected count; either side may lack a grain."""
    found = stat.groupBy("statistic_id", "grain").agg(F.count(F.lit(1)).alias("rows"))
    both = found.join(expected, ["statistic_id", "grain"], "full_outer")
    return both.select("statistic_id", "grain", F.coalesce("rows", F.lit(0)).alias("rows"),
                       F.coalesce("expected", F.lit(0)).cast("bigint").alias("expected"),
                       (F.coalesce("rows", F.lit(0)) == F.coalesce("expected", F.lit(0))).alias("matches"))
