"""Scans whose span summaries compose: several steps over the rows of a key from one cut, without a write between.

``ordered_scan`` answers one question per scan. Here the summary of a span holds what the next step needs to know as
well, whatever comes before the span: of a run of states its first and last value and its changes inside, of intervals
the furthest end and the last start that no interval of the span itself covers. What depends on earlier spans is
settled among the summaries, one row per (key, span), and joined back. Summaries are made from the same shuffled rows
that they are joined to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattmirror.plans.ordered import SPAN, STRETCH, spanned


def _windows(keys: list[str], ts: str, ties: list[str]):
    inside = Window.partitionBy(*keys, SPAN, STRETCH).orderBy(ts, *ties)
    across = Window.partitionBy(*keys).orderBy(SPAN, STRETCH)
    return inside, across, across.rowsBetween(Window.unboundedPreceding, -1), across.rowsBetween(1, Window.unboundedFollowing)


def _differ(one: Column, other: Column) -> Column:
    return ~one.eqNullSafe(other)


def state_runs(df: DataFrame, keys: list[str], ts: str, ties: list[str], value: str, previous: str,
               changed_at: str | None = None, since: str | None = None) -> DataFrame:
    """The rows whose value differs from that of the row before, in (ts, *ties) order; keys are not NULL.

    ``previous``: the value before (NULL on the first row of a key, which differs unless it is NULL itself).
    ``changed_at``: when the next such row comes (NULL if none). ``since``: when the last one before came.
    The rows keep SPAN and STRETCH, for a step that goes on with them.
    """
    inside, across, earlier, later = _windows(keys, ts, ties)
    rows = spanned(df, keys, ts, ties).withColumns({
        "__prev": F.lag(value).over(inside), "__first": F.row_number().over(inside) == 1})
    # A change that the span sees by itself; whether its first row is one depends on the span before.
    rows = rows.withColumn("__moved", F.when(~F.col("__first") & _differ(F.col(value), F.col("__prev")), F.col(ts)))
    order = F.struct(ts, *ties)
    summary = rows.groupBy(*keys, SPAN, STRETCH).agg(
        F.min_by(value, order).alias("__head"), F.max_by(value, order).alias("__tail"), F.min(ts).alias("__begin"),
        F.min("__moved").alias("__next_in"), F.max("__moved").alias("__last_in"))
    summary = summary.withColumn("__before", F.lag("__tail").over(across))
    opens = F.when(_differ(F.col("__head"), F.col("__before")), F.col("__begin"))
    summary = summary.withColumn("__opens", opens).select(
        *keys, SPAN, STRETCH, "__before", "__opens",
        F.first(F.coalesce("__opens", "__next_in"), ignorenulls=True).over(later).alias("__after"),
        F.last(F.coalesce("__last_in", "__opens"), ignorenulls=True).over(earlier).alias("__since"))
    steps = {}
    if changed_at:
        steps["__next"] = F.first("__moved", ignorenulls=True).over(inside.rowsBetween(1, Window.unboundedFollowing))
    if since:
        steps["__past"] = F.last("__moved", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, -1))
    out = rows.withColumns(steps).join(summary, [*keys, SPAN, STRETCH])
    out = out.where(F.coalesce("__moved", F.when(F.col("__first"), F.col("__opens"))).isNotNull())
    added = {previous: F.when(F.col("__first"), F.col("__before")).otherwise(F.col("__prev"))}
    if changed_at:
        added[changed_at] = F.coalesce("__next", "__after")
    if since:
        added[since] = F.coalesce("__past", F.when(~F.col("__first"), F.col("__opens")), "__since")
    return out.select(*df.columns, *[c.alias(n) for n, c in added.items()], SPAN, STRETCH)


def interval_starts(rows: DataFrame, keys: list[str], ts: str, ties: list[str], ends: str, starts: str) -> DataFrame:
    """Add the beginning of the merged interval that each row's interval [ts, ends] belongs to; rows have SPAN and STRETCH.

    An interval joins the one before if it begins no later than the furthest end so far.
    """
    inside, across, earlier, _ = _windows(keys, ts, ties)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reach = F.max(ends).over(before)
    rows = rows.withColumn("__reach", reach)
    rows = rows.withColumn("__fresh", F.when(F.col("__reach").isNull() | (F.col(ts) > F.col("__reach")), F.col(ts)))
    summary = rows.groupBy(*keys, SPAN, STRETCH).agg(F.max(ends).alias("__end"), F.max("__fresh").alias("__last"))
    summary = summary.withColumn("__far", F.max("__end").over(earlier))
    # What the span itself does not cover begins afresh unless an earlier span reaches that far.
    free = lambda stamp: F.when(F.col("__far").isNull() | (F.col(stamp) > F.col("__far")), F.col(stamp))
    summary = summary.withColumn("__own", free("__last")).select(
        *keys, SPAN, STRETCH, "__far", F.last("__own", ignorenulls=True).over(earlier).alias("__open"))
    out = rows.join(summary, [*keys, SPAN, STRETCH]).withColumn("__begun", F.last(free("__fresh"), ignorenulls=True).over(upto))
    return out.withColumn(starts, F.coalesce("__begun", "__open")).drop("__reach", "__fresh", "__far", "__open", "__begun")
