"""Exhaustive comparison of the mirror with its source: digests of months first, then the rows of those that differ."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattmirror.functions.values import values_equal
from wattmirror.operators.merge import bound_by_watermark
from wattmirror.plans.pinned import pin
from wattmirror.sources.statistics import FACT_KEY, MEASURES

# Fixed value: problem kinds in the order they are reported for one row.
KINDS = ["missing_from_mirror", "absent_from_source", "grain", *MEASURES, "last_reset_at"]
MAX_PROBLEMS = 200
FIELDS = ["grain", *MEASURES, "last_reset_at"]
PART = ["__metric", "__month"]          # of a digest
NO_MONTH = -1                           # of rows without a time; else months since the year 0
SEEDS = (11, 12)                        # one 64-bit hash of a row each


def with_part(rows: DataFrame) -> DataFrame:
    """Add the metric and month whose digest a row counts in; neither is NULL."""
    return rows.withColumns({"__metric": F.coalesce("statistic_id", F.lit("")),
                             "__month": F.coalesce(F.year("start_at") * 12 + F.month("start_at") - 1, F.lit(NO_MONTH))})


def digests(rows: DataFrame) -> DataFrame:
    """Per metric and month the number of rows and a digest of them: __metric, __month, digest.

    The digest adds up two 64-bit hashes of every row, in halves that cannot overflow, so it depends neither on order
    nor on partitions and repeated rows do not cancel. It is combined before the shuffle: no row is moved.
    """
    # A hash passes over NULLs, so the places that are NULL are hashed as well.
    nulls = reduce(Column.__add__, [F.col(c).isNull().cast("int") * (1 << i) for i, c in enumerate(FIELDS)])
    hashes = [F.xxhash64(F.lit(seed), nulls, *FACT_KEY, *FIELDS) for seed in SEEDS]
    halves = [half for h in hashes for half in (h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32))]
    return with_part(rows).groupBy(*PART).agg(
        F.struct(F.count(F.lit(1)).alias("n"), *[F.sum(h).alias(f"h{i}") for i, h in enumerate(halves)]).alias("digest"))


def differing_parts(source: DataFrame, mirror: DataFrame) -> DataFrame:
    """The (__metric, __month) pairs whose rows are not the same on both sides."""
    both = digests(source).join(digests(mirror).withColumnRenamed("digest", "other"), PART, "full_outer")
    return both.where(~F.col("digest").eqNullSafe(F.col("other"))).select(*PART)


def months_of(parts: DataFrame) -> list[int]:
    """The months that occur, in order: a row per month comes to the driver."""
    return sorted(r[0] for r in parts.select("__month").distinct().collect())


def rows_of(rows: DataFrame, parts: DataFrame, months: list[int]) -> DataFrame:
    """The rows of the parts. Runs of months are plain bounds on start_at, so that a scan skips the others."""
    runs: list[list[int]] = []
    for month in (m for m in months if m != NO_MONTH):
        if runs and runs[-1][1] == month:
            runs[-1][1] = month + 1
        else:
            runs.append([month, month + 1])
    at = F.col("start_at")
    begin = lambda month: F.lit(f"{month // 12:04d}-{month % 12 + 1:02d}-01").cast("timestamp")
    inside = [(at >= begin(lo)) & (at < begin(hi)) for lo, hi in runs]
    if NO_MONTH in months:
        inside.append(at.isNull())
    some = rows.where(reduce(Column.__or__, inside, F.lit(False)))
    return with_part(some).join(parts, PART, "left_semi").drop(*PART)


def reconcile(source: DataFrame, mirror: DataFrame, watermarks: DataFrame | None = None) -> DataFrame:
    """One row per difference between source rows (with their resolved grain) and the mirror.

    Both sides are bounded by the same watermarks. Digests per metric and month are compared first, by a job of its
    own; only rows of parts that differ are then read again, moved and compared field by field, so a clean mirror costs
    two scans that shuffle no row. Rows that differ within the tolerance only make their part differ, but no problem.
    Inputs are read twice and must not change in between.
    """
    if watermarks is not None:
        source, mirror = bound_by_watermark(source, watermarks), bound_by_watermark(mirror, watermarks)
    parts = pin(differing_parts(source, mirror), "parts")
    months = months_of(parts)
    return differences(rows_of(source, parts, months), rows_of(mirror, parts, months))


def differences(source: DataFrame, mirror: DataFrame) -> DataFrame:
    """Every key on either side, compared field by field.

    The join is on the unique fact key: rows spread evenly whatever the metrics' sizes.
    """
    pack = lambda df, name: df.select(*FACT_KEY, F.struct(*FIELDS).alias(name))
    both = pack(source, "s").join(pack(mirror, "m"), FACT_KEY, "full_outer")
    missing, absent = F.col("m").isNull(), F.col("s").isNull()

    def differs(name: str) -> Column:
        a, b = F.col(f"s.{name}"), F.col(f"m.{name}")
        same = values_equal(a, b) if name in MEASURES else a.eqNullSafe(b)
        return ~missing & ~absent & ~same

    def problem(no: int, kind: str, test: Column, a: Column, b: Column) -> Column:
        return F.when(test, F.struct(F.lit(no).alias("kind_no"), F.lit(kind).alias("kind"),
                                     a.alias("source_value"), b.alias("mirror_value")))

    none = F.lit(None).cast("string")
    text = lambda side, name: F.col(f"{side}.{name}").cast("string")
    found = [problem(0, KINDS[0], missing, none, none), problem(1, KINDS[1], absent, none, none)]
    found += [problem(no, name, differs(name), text("s", name), text("m", name))
              for no, name in enumerate(FIELDS, start=2)]
    return (both.select("statistic_id", F.col("start_at").alias("at"),
                        F.explode(F.array_compact(F.array(*found))).alias("p"))
                .select("statistic_id", "at", "p.*"))


def absent(rows: DataFrame) -> DataFrame:
    """Mirror rows that are known to be gone from the source, as problems."""
    none = F.lit(None).cast("string")
    return rows.select("statistic_id", F.col("start_at").alias("at"), F.lit(1).alias("kind_no"), F.lit(KINDS[1]).alias("kind"),
                       none.alias("source_value"), none.alias("mirror_value"))


def limit_problems(problems: DataFrame, n: int = MAX_PROBLEMS) -> DataFrame:
    """The first n problems in metric, time and field order; a top-n, not a full sort."""
    return problems.orderBy("statistic_id", "at", "kind_no").limit(n)
