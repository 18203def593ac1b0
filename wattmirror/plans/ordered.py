"""Windows over one key in order that survive a key holding most of the rows.

A plain ``Window.partitionBy(key).orderBy(ts)`` puts a whole key into one task. Here every scan, whatever its size,
has one plan of two levels. A key is cut into spans: calendar spans of a month (numbers are not cut by value), and where a
key has more than SPAN_ROWS rows in one of them, into as many stretches of its own range as its rows fill. A caller that
knows how many rows a span can have (hourly facts: 744 a month) gives a ``width``, and nothing is counted. The window runs inside (key, span); what a row needs from other spans (the last row before, the first row
after, a running max or sum) comes from a summary with one row per (key, span), which is scanned per key and joined back.

So a key has at most one span a month and one per SPAN_ROWS rows, however sparse its values are, and a span of evenly
spread rows has about SPAN_ROWS of them. A single moment is cut by the first tie, if that is a number. Which keys are
crowded is a part of the plan, with at most rows / SPAN_ROWS rows; nothing runs while a scan is built and nothing is
broadcast by hint. The input is read by all parts: write it once with ``settled`` where it is costly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattmirror.plans.pinned import pin

HOUR, MONTH = 3_600, 31 * 86_400        # seconds
NUMBERS = 65_536                        # values of a span of a numeric order column
SPAN_ROWS = 500_000                     # rows of a key in one span, above which the span is cut
WIDTH_CONF = "wattmirror.spanWidth"     # overrides every width, in seconds or values
ROWS_CONF = "wattmirror.spanRows"       # overrides SPAN_ROWS

SPAN, STRETCH = "__span", "__stretch"


def span_of(df: DataFrame, order: str, width: float | None = None) -> Column:
    """The span a row lies in: rises with the order column; rows without a value come first."""
    kind = df.schema[order].dataType.typeName()
    timed = kind in ("date", "timestamp", "timestamp_ntz")
    wide = float(df.sparkSession.conf.get(WIDTH_CONF, None) or width or (HOUR if timed else NUMBERS))
    if timed:
        place, wide = F.unix_micros(F.col(order).cast("timestamp")), wide * 1_000_000
    else:
        place = F.col(order)
    return F.coalesce(F.floor(place / F.lit(wide)).cast("bigint"), F.lit(-(1 << 62)))


def _timed(df: DataFrame, column: str) -> bool:
    return df.schema[column].dataType.typeName() in ("date", "timestamp", "timestamp_ntz")


def spanned(df: DataFrame, keys: list[str], ts: str, ties: list[str] | None = None, width: float | None = None) -> DataFrame:
    """Add SPAN and STRETCH: the calendar span, and the stretch of it where the key is crowded there (else 0)."""
    conf = df.sparkSession.conf
    most = int(conf.get(ROWS_CONF, None) or SPAN_ROWS)
    timed = _timed(df, ts)
    whole = not timed and width is None and conf.get(WIDTH_CONF, None) is None
    rows = df.withColumn(SPAN, F.lit(0).cast("bigint") if whole else span_of(df, ts, width or MONTH))
    if width is not None and conf.get(ROWS_CONF, None) is None:
        return rows.withColumn(STRETCH, F.lit(0).cast("bigint"))
    place = (F.unix_micros(F.col(ts).cast("timestamp")) if timed else F.col(ts)).cast("double")
    tie = ties[0] if ties and df.schema[ties[0]].dataType.typeName() in ("byte", "short", "integer", "long", "float", "double", "decimal") else None
    other = F.col(tie).cast("double") if tie else F.lit(None).cast("double")
    crowded = rows.groupBy(*keys, SPAN).agg(
        F.count(F.lit(1)).alias("__n"), F.min(place).alias("__lo"), F.max(place).alias("__hi"),
        F.min(other).alias("__tie_lo"), F.max(other).alias("__tie_hi")).where(F.col("__n") > most)
    within = lambda value, lo, hi: F.floor((value - F.col(lo)) / ((F.col(hi) - F.col(lo) + 1) / F.ceil(F.col("__n") / most)))
    stretch = F.when(F.col("__lo") < F.col("__hi"), within(place, "__lo", "__hi")).otherwise(within(other, "__tie_lo", "__tie_hi"))
    return rows.join(crowded, [*keys, SPAN], "left").withColumn(STRETCH, F.coalesce(stretch.cast("bigint"), F.lit(0))) \
               .drop("__n", "__lo", "__hi", "__tie_lo", "__tie_hi")


def settled(df: DataFrame) -> DataFrame:
    """Rows that another scan builds on, written once: a scan reads its input twice."""
    return pin(df, "rows")


def ordered_scan(df: DataFrame, keys: list[str], ts: str, ties: list[str] | None = None, *,
                 previous: dict[str, str] | None = None,
                 following: dict[str, str] | None = None,
                 known: dict[str, str] | None = None,
                 highest: dict[str, str] | None = None,
                 total: dict[str, str] | None = None,
                 width: float | None = None) -> DataFrame:
    """Add columns computed over the rows of one key in (ts, *ties) order. Keys are not NULL.

    Each argument maps an output name to an input column:
      previous   value on the row before                  (NULL on the first row)
      following  value on the row after                   (NULL on the last row)
      known      latest non-NULL value up to this row
      highest    maximum over all earlier rows            (this row excluded)
      total      sum over all rows up to and including this one
    ``width`` is that of a calendar span, in seconds for times, else in values; give it where a span of that width
    has a bounded number of rows. Without it spans are a month or all values, and crowded ones are cut.
    """
    previous, following = previous or {}, following or {}
    known, highest, total = known or {}, highest or {}, total or {}
    order = [ts, *(ties or [])]
    cut = spanned(df, keys, ts, ties, width)
    parts = [*keys, SPAN, STRETCH]

    inside = Window.partitionBy(*parts).orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    # Plain columns, not structs: a struct would be built below the shuffle and sent along.
    adds: dict[str, Column] = {o: F.lag(c).over(inside) for o, c in previous.items()}
    adds |= {o: F.lead(c).over(inside) for o, c in following.items()}
    adds |= {o: F.last(c, ignorenulls=True).over(upto) for o, c in known.items()}
    adds |= {o: F.max(c).over(before) for o, c in highest.items()}
    adds |= {o: F.sum(c).over(upto) for o, c in total.items()}
    if previous:
        adds["__first"] = F.row_number().over(inside) == 1
    if following:
        adds["__last"] = F.lead(F.lit(True)).over(inside).isNull()

    carry = _carries(cut, keys, order, previous, following, known, highest, total)
    out = cut.withColumns(adds).join(carry, parts, "left")
    merged = {o: F.when(F.col("__first"), F.col(f"__c_prev.{o}")).otherwise(F.col(o)) for o in previous}
    merged |= {o: F.when(F.col("__last"), F.col(f"__c_next.{o}")).otherwise(F.col(o)) for o in following}
    merged |= {o: F.coalesce(o, f"__c_{o}") for o in known}
    merged |= {o: F.greatest(o, f"__c_{o}") for o in highest}
    merged |= {o: F.when(F.col(f"__c_{o}").isNull(), F.col(o))
                   .otherwise(F.coalesce(F.col(o), F.lit(0)) + F.col(f"__c_{o}"))
               for o in total}
    return out.withColumns(merged).drop("__first", "__last", SPAN, STRETCH, *[c for c in carry.columns if c.startswith("__c_")])


def _carries(rows, keys, order, previous, following, known, highest, total) -> DataFrame:
    """One row per (key, span): what that span inherits from the spans around it."""
    at = F.struct(*order)
    struct = lambda cols: F.struct(*[F.col(c).alias(o) for o, c in cols.items()])
    aggs: list[Column] = [F.count(F.lit(1)).alias("__rows")]
    if previous:
        aggs.append(F.max_by(struct(previous), at).alias("__tail"))
    if following:
        aggs.append(F.min_by(struct(following), at).alias("__head"))
    aggs += [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), at)).alias(f"__k_{o}") for o, c in known.items()]
    aggs += [F.max(c).alias(f"__h_{o}") for o, c in highest.items()]
    aggs += [F.sum(c).alias(f"__t_{o}") for o, c in total.items()]
    summary = rows.groupBy(*keys, SPAN, STRETCH).agg(*aggs)

    across = Window.partitionBy(*keys).orderBy(SPAN, STRETCH)
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    cols: dict[str, Column] = {}
    if previous:
        cols["__c_prev"] = F.lag("__tail").over(across)
    if following:
        cols["__c_next"] = F.lead("__head").over(across)
    cols |= {f"__c_{o}": F.last(f"__k_{o}", ignorenulls=True).over(earlier) for o in known}
    cols |= {f"__c_{o}": F.max(f"__h_{o}").over(earlier) for o in highest}
    cols |= {f"__c_{o}": F.sum(f"__t_{o}").over(earlier) for o in total}
    return summary.select(*keys, SPAN, STRETCH, *[c.alias(n) for n, c in cols.items()])
