"""Join of points with the intervals that hold them (``BETWEEN``), for
intervals of any length that may overlap, by equality of keys alone.

A condition ``point between start and end`` plans as a nested loop: every
point with every interval.  Here the line is cut into bins of level 0, four of
them make a bin of level 1, and so on.  An interval is the union of a few
bins, as wide as they fit (at most six of a level); a point lies in one bin of
each level.  So every match is found in exactly one bin, by an equi-join on
(level, bin), and wide intervals need no more rows than narrow ones: an
interval of n bins becomes about 6 * log4(n) rows, a point one row for each
level up to that of the longest interval.

Points may crowd in a bin (a third of them may have one value).  Bins with
more than ``hot_rows`` points are counted first and their points dealt into
as many parts; the intervals' rows of such a bin are repeated for each part.
The list of hot bins is bounded (``MOST_HOT``) by raising ``hot_rows`` with the
number of points, so it is broadcast.

Whole numbers, dates and timestamps are binned exactly; decimals and doubles
by ``unit`` (the width of a bin of level 0), and the condition itself is
checked after the join, so a ``unit`` only changes the cost.  Null points,
null ends and intervals whose end is before their start match nothing, as in
SQL.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, DecimalType, DoubleType, FloatType, IntegralType, TimestampNTZType, TimestampType

#: Bits by which a bin of one level is wider than one of the level below.
BITS = 2
#: Points of a bin from which on it is cut, and the most such bins.
HOT_ROWS, MOST_HOT = 1_000_000, 20_000

_LEVEL, _BIN, _PART, _PARTS, _P, _S, _E = (f"_ij_{n}" for n in ("level", "bin", "part", "parts", "p", "s", "e"))


def _cell(c: Column, kind: DataType, unit: float | None) -> Column:
    """The bin of level 0 of a value: a whole number that never falls while
    the value rises."""
    if isinstance(kind, IntegralType):
        whole = c.cast("long")
    elif isinstance(kind, DateType):
        whole = F.unix_date(c).cast("long")
    elif isinstance(kind, TimestampType):
        whole = F.unix_micros(c)
    elif isinstance(kind, TimestampNTZType):
        whole = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), c)
    elif isinstance(kind, (DecimalType, DoubleType, FloatType)):
        return F.floor(c.cast("double") / F.lit(float(unit or 1))).cast("long")
    else:
        raise TypeError(f"interval join: {kind.simpleString()} has no order of numbers")
    return F.floor(whole / F.lit(unit)).cast("long") if unit else whole


def _bins(s: Column, e: Column, top: int, bits: int) -> Column:
    """The bins (level, bin) whose union is [s, e], in cells."""
    def low(level: int) -> Column:  # first bin of a level that begins inside
        return F.shiftright(s + F.lit((1 << bits * level) - 1), bits * level)

    def high(level: int) -> Column:  # first bin that does not end inside
        return F.shiftright(e + F.lit(1), bits * level)

    def run(level: int, begin: Column, end: Column) -> Column:
        empty = F.array().cast("array<struct<level:int,bin:bigint>>")
        bins = F.transform(F.sequence(begin, end - 1), lambda b: F.struct(F.lit(level).alias("level"), b.alias("bin")))
        return F.when(begin < end, bins).otherwise(empty)

    parts = []
    for level in range(top + 1):
        if level == top:
            parts.append(run(level, low(level), high(level)))
            break
        inner = low(level + 1) < high(level + 1)  # wider bins take the middle
        parts.append(run(level, low(level), F.when(inner, F.shiftleft(low(level + 1), bits)).otherwise(high(level))))
        parts.append(F.when(inner, run(level, F.shiftleft(high(level + 1), bits), high(level)))
                     .otherwise(F.array().cast("array<struct<level:int,bin:bigint>>")))
    return F.concat(*parts)


def interval_join(points: DataFrame, intervals: DataFrame, point: str, start: str, end: str, *,
                  on: Sequence[str] = (), unit: float | None = None, bits: int = BITS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """All pairs with ``start <= point <= end`` (and equal ``on`` columns):
    the columns of ``points``, then those of ``intervals`` without ``on``.

    Both frames are read twice: for the longest interval and the hot bins, and
    for the join; a computed frame is best stored before.
    """
    on = list(on)
    clash = (set(points.columns) & set(intervals.columns)) - set(on)
    if clash:
        raise ValueError(f"interval join: both sides have the columns {sorted(clash)}")
    kind = {f.name: f.dataType for f in [*points.schema.fields, *intervals.schema.fields]}
    spans = intervals.withColumns({_S: _cell(F.col(start), kind[start], unit), _E: _cell(F.col(end), kind[end], unit)})
    spans = spans.where(F.col(_S).isNotNull() & F.col(_E).isNotNull() & (F.col(start) <= F.col(end)))
    placed = points.withColumn(_P, _cell(F.col(point), kind[point], unit)).where(F.col(_P).isNotNull())

    longest = spans.agg(F.max(F.col(_E) - F.col(_S) + 1)).first()[0] or 1
    top = int(math.log2(longest)) // bits
    number = placed.count()
    least = max(hot_rows, -(-number * (top + 1) // MOST_HOT))

    levels = F.array(*[F.struct(F.lit(n).alias("level"), F.shiftright(F.col(_P), bits * n).alias("bin")) for n in range(top + 1)])
    many = placed.withColumn("_ij", F.explode(levels)).withColumns({_LEVEL: F.col("_ij.level"), _BIN: F.col("_ij.bin")}).drop("_ij", _P)
    few = spans.withColumn("_ij", F.explode(_bins(F.col(_S), F.col(_E), top, bits))).withColumns(
        {_LEVEL: F.col("_ij.level"), _BIN: F.col("_ij.bin")}).drop("_ij", _S, _E)
    keys = [*on, _LEVEL, _BIN]
    if number > least:  # else no bin can hold more
        hot = many.groupBy(*keys).count().where(F.col("count") > least).select(
            *keys, F.ceil(F.col("count") / least).cast("int").alias(_PARTS))
        parts = F.coalesce(F.col(_PARTS), F.lit(1))
        many = many.join(F.broadcast(hot), keys, "left").withColumn(
            _PART, F.pmod(F.monotonically_increasing_id(), parts).cast("int")).drop(_PARTS)
        few = few.join(F.broadcast(hot), keys, "left").withColumn(_PART, F.explode(F.sequence(F.lit(0), parts - 1))).drop(_PARTS)
        keys = [*keys, _PART]
    joined = many.join(few, keys).where(F.col(point).between(F.col(start), F.col(end)))
    return joined.select(*points.columns, *[c for c in intervals.columns if c not in on])
