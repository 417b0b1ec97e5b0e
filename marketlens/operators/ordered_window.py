"""Distributed ordered window: row_number, dense_rank, lag/lead and running
sums over a total order, optionally per partition key, without funnelling a
whole table (or one hot partition key) through a single task.

A plain ``Window.orderBy(...)`` with no partition key plans as
``Exchange SinglePartition``: every row goes to one task.  A
``Window.partitionBy(user)`` does the same for a user that owns a third of
the rows.  This operator instead:

1. stores the input (a Parquet table under ``spark.checkpoint.dir``), so that
   taking a sample of it does not compute it twice;
2. cuts it into buckets of about ``target_rows_per_bucket`` rows of the
   composite order (partition keys, then order keys) by the bounds of a sorted
   sample.  The number of buckets grows with the rows; a hot value or hot
   partition key is spread over several buckets by the tie-break columns.
   Rows know their bucket before they move, so they are shuffled once;
3. runs the window inside each bucket (a table of one bucket ends here, as
   nothing has to be carried over) and stores the result, so that what
   follows reads the same buckets whatever happens to an executor;
4. takes the first and the last row of each bucket.  A partition key that
   goes over a bucket's end is the key of both rows there, so these (two rows
   a bucket) hold all that later buckets need: counts, ranks, sums, values;
5. sums them up over the buckets and adds them to the rows by a broadcast
   join on the bucket (one row a bucket).

Results equal the single-task window exactly (decimal sums are exact).
Null order follows Spark: ascending = nulls first, descending = nulls last.
The order must be total (end it with a unique key) for row_number, lag,
lead and running sums to be deterministic; dense_rank only looks at the
``rank_by`` prefix.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# rows per bucket: the sort and the window buffers of one fit in the memory of a
# task, as a window holds all rows of its partition
DEFAULT_ROWS_PER_BUCKET = 500_000
# rows of the sample that the bounds of a bucket are taken from
SAMPLE_PER_BUCKET = 100

_B = "_ow_bucket"
_FIRST = "_ow_first"
_LAST = "_ow_last"
_LRN = "_ow_lrn"
_LDR = "_ow_ldr"


@dataclass(frozen=True)
class Order:
    col: str
    desc: bool = False


def _spec(order: Sequence[Order]) -> list[Column]:
    return [F.col(o.col).desc_nulls_last() if o.desc else F.col(o.col).asc_nulls_first() for o in order]


def _checkpoint(df: DataFrame) -> DataFrame:
    from marketlens.sources.sinks import materialize
    return materialize(df)


def _bounds(base: DataFrame, order: list[Order], buckets: int, rows: int) -> DataFrame:
    """A row with the first rows of all buckets but the first, in order, from
    a sample of ``SAMPLE_PER_BUCKET`` rows a bucket.  Stored, as every row is
    held against the same bounds."""
    cols = list(dict.fromkeys(o.col for o in order))
    sample = base.select(*cols).sample(min(1.0, SAMPLE_PER_BUCKET * buckets / max(rows, 1)), seed=7)
    in_order = Window.orderBy(*_spec(order))
    tiles = sample.withColumn("_ow_tile", F.ntile(buckets).over(in_order)).withColumn("_ow_tile0", F.lag("_ow_tile").over(in_order))
    firsts = F.sort_array(F.collect_list(F.struct("_ow_tile", *cols)))
    return _checkpoint(tiles.where(F.col("_ow_tile") > F.col("_ow_tile0")).agg(firsts.alias("_ow_bounds")))


def _before(order: list[Order], bound: Column) -> Column:
    """Whether a row comes before a bound."""
    out = F.lit(False)
    for o in reversed(order):
        here, there = F.col(o.col), bound[o.col]
        less, null = (here > there, there.isNull()) if o.desc else (here < there, here.isNull())
        out = F.when(here.eqNullSafe(there), out).otherwise(F.coalesce(less, null))
    return out


def _with_bucket(base: DataFrame, order: list[Order], buckets: int, rows: int) -> DataFrame:
    """Adds the number of bounds that a row does not come before, found by
    halving."""
    def further(found: Column, step: Column) -> Column:
        bound = F.get("_ow_bounds", found + step - 1)
        return F.when(bound.isNotNull() & ~_before(order, bound), found + step).otherwise(found)

    steps = F.array(*[F.lit(1 << k) for k in reversed(range((buckets - 1).bit_length()))])
    known = base.crossJoin(F.broadcast(_bounds(base, order, buckets, rows)))
    return known.select(*base.columns, F.aggregate(steps, F.lit(0), further).alias(_B))


def _bucketed_window(
    base: DataFrame, order_by: list[Order], pcols: list[str], rank_cols: list[str], buckets: int, rows: int,
    lag: dict[str, str], lead: dict[str, str], running_sum: dict[str, str],
) -> DataFrame:
    """``base`` with its bucket, flags of the bucket's first and last row and
    the window columns as they are inside the bucket."""
    composite = [Order(c) for c in pcols] + order_by
    in_bucket = Window.partitionBy(_B).orderBy(*_spec(composite))
    local = Window.partitionBy(_B, *pcols).orderBy(*_spec(order_by))
    running = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rank = F.struct(*rank_cols)
    before = F.lag(rank).over(local)
    # both windows sort by bucket, partition keys, order: one exchange, one sort,
    # and each bucket is a partition of its own
    frame = _with_bucket(base, composite, buckets, rows).repartitionById(buckets, _B).withColumns({
        _FIRST: F.lag(F.lit(True)).over(in_bucket).isNull(),
        _LAST: F.lead(F.lit(True)).over(in_bucket).isNull(),
    })
    frame = frame.withColumns({
        _LRN: F.row_number().over(local).cast("long"),
        "_ow_step": F.when(before.isNull() | ~before.eqNullSafe(rank), 1).otherwise(0),
        **{f"_ow_lag_{out}": F.lag(src).over(local) for out, src in lag.items()},
        **{f"_ow_lead_{out}": F.lead(src).over(local) for out, src in lead.items()},
        **{f"_ow_run_{out}": F.sum(src).over(running) for out, src in running_sum.items()},
    })
    return frame.withColumn(_LDR, F.sum("_ow_step").over(running).cast("long")).drop("_ow_step")


def _carried(
    stored: DataFrame, pcols: list[str], rank_cols: list[str],
    lag: dict[str, str], lead: dict[str, str], running_sum: dict[str, str],
) -> DataFrame:
    """One row a bucket: the keys of its first and last row, and what earlier
    buckets add to the first key and the next one to the last key."""
    key, rank = F.struct(F.lit(0), *pcols), F.struct(*rank_cols)
    firsts = stored.where(_FIRST).select(
        F.col(_B), key.alias("_ow_k0"), rank.alias("_ow_r0"),
        *[F.col(src).alias(f"_ow_v0_{out}") for out, src in lead.items()])
    lasts = stored.where(_LAST).select(
        F.col(_B), key.alias("_ow_k1"), rank.alias("_ow_r1"), F.col(_LRN).alias("_ow_n1"), F.col(_LDR).alias("_ow_d1"),
        *[F.col(src).alias(f"_ow_v1_{out}") for out, src in lag.items()],
        *[F.col(f"_ow_run_{out}").alias(f"_ow_s1_{out}") for out in running_sum])
    ends = firsts.join(lasts, _B)
    by_bucket = Window.orderBy(_B)
    prev = lambda c: F.lag(c).over(by_bucket)
    goes_on = F.coalesce(prev("_ow_k1").eqNullSafe(F.col("_ow_k0")) & prev("_ow_n1").isNotNull(), F.lit(False))
    ends = ends.withColumn("_ow_on", goes_on).withColumn(
        "_ow_same", F.when(F.col("_ow_on") & prev("_ow_r1").eqNullSafe(F.col("_ow_r0")), 1).otherwise(0))
    # totals of the last key over all its buckets so far
    so_far = Window.partitionBy("_ow_k1").orderBy(_B).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = F.col("_ow_k0").eqNullSafe(F.col("_ow_k1"))
    ends = ends.withColumns({
        "_ow_n": F.sum("_ow_n1").over(so_far),
        "_ow_d": F.sum(F.col("_ow_d1") - F.when(whole, F.col("_ow_same")).otherwise(0)).over(so_far),
        **{f"_ow_s_{out}": F.sum(f"_ow_s1_{out}").over(so_far) for out in running_sum},
    })
    next_on = F.coalesce(F.lead("_ow_on").over(by_bucket), F.lit(False))
    return ends.select(
        F.col(_B).alias("_ow_ob"), "_ow_k0",
        F.when(F.col("_ow_on"), prev("_ow_n")).otherwise(0).alias("_ow_off_rn"),
        F.when(F.col("_ow_on"), prev("_ow_d") - F.col("_ow_same")).otherwise(0).alias("_ow_off_dr"),
        *[F.when(F.col("_ow_on"), prev(f"_ow_v1_{out}")).alias(f"_ow_prev_{out}") for out in lag],
        *[F.when(next_on, F.lead(f"_ow_v0_{out}").over(by_bucket)).alias(f"_ow_next_{out}") for out in lead],
        *[F.when(F.col("_ow_on"), prev(f"_ow_s_{out}")).alias(f"_ow_off_{out}") for out in running_sum])


def ordered_window(
    df: DataFrame,
    order_by: Sequence[Order],
    *,
    partition_by: Sequence[str] = (),
    rank_by: Sequence[str] | None = None,
    row_number: str | None = None,
    dense_rank: str | None = None,
    lag: dict[str, str] | None = None,
    lead: dict[str, str] | None = None,
    running_sum: dict[str, str] | None = None,
    target_rows_per_bucket: int | None = None,
    materialize: bool = True,
    num_buckets: int | None = None,
    bucket_col: str | None = None,
) -> DataFrame:
    """Add window columns to ``df``.

    ``lag`` / ``lead`` / ``running_sum`` map an output column to its source
    column (offset 1 for lag/lead, frame = unbounded preceding .. current
    row for running sums).  ``materialize=False`` says that ``df`` is a stored
    table already; ``num_buckets`` forces the bucket count (tests);
    ``bucket_col`` names an output column carrying each row's bucket.
    """
    lag, lead, running_sum = dict(lag or {}), dict(lead or {}), dict(running_sum or {})
    order_by, pcols = list(order_by), list(partition_by)
    rank_cols = list(rank_by) if rank_by is not None else [order_by[0].col]

    base = _checkpoint(df) if materialize else df
    rows = base.count()
    n = num_buckets or max(1, math.ceil(rows / (target_rows_per_bucket or DEFAULT_ROWS_PER_BUCKET)))
    if n == 1:  # no other bucket has anything to carry over
        only = plain_window(base, order_by, partition_by=pcols, rank_by=rank_cols, row_number=row_number, dense_rank=dense_rank,
                            lag=lag, lead=lead, running_sum=running_sum)
        return only.withColumn(bucket_col, F.lit(0)) if bucket_col else only
    stored = _checkpoint(_bucketed_window(base, order_by, pcols, rank_cols, n, rows, lag, lead, running_sum))
    carried = _carried(stored, pcols, rank_cols, lag, lead, running_sum)

    # one row a bucket -> broadcast
    joined = stored.join(F.broadcast(carried), F.col(_B) == F.col("_ow_ob"))
    first_key = F.struct(F.lit(0), *pcols).eqNullSafe(F.col("_ow_k0"))
    finals = {}
    if row_number:
        finals[row_number] = F.col(_LRN) + F.when(first_key, F.col("_ow_off_rn")).otherwise(0)
    if dense_rank:
        finals[dense_rank] = F.col(_LDR) + F.when(first_key, F.col("_ow_off_dr")).otherwise(0)
    for out in lag:
        finals[out] = F.when(F.col(_FIRST), F.col(f"_ow_prev_{out}")).otherwise(F.col(f"_ow_lag_{out}"))
    for out in lead:
        finals[out] = F.when(F.col(_LAST), F.col(f"_ow_next_{out}")).otherwise(F.col(f"_ow_lead_{out}"))
    for out in running_sum:
        here, off = F.col(f"_ow_run_{out}"), F.when(first_key, F.col(f"_ow_off_{out}"))
        finals[out] = F.coalesce(here + off, here, off).cast(stored.schema[f"_ow_run_{out}"].dataType)
    if bucket_col:
        finals[bucket_col] = F.col(_B)
    out = joined.withColumns(finals)
    return out.drop(*[c for c in out.columns if c.startswith("_ow_")])


def plain_window(
    df: DataFrame,
    order_by: Sequence[Order],
    *,
    partition_by: Sequence[str] = (),
    rank_by: Sequence[str] | None = None,
    row_number: str | None = None,
    dense_rank: str | None = None,
    lag: dict[str, str] | None = None,
    lead: dict[str, str] | None = None,
    running_sum: dict[str, str] | None = None,
) -> DataFrame:
    """The same columns with ordinary Spark windows (for small, bounded
    inputs such as categories or payment groups, and as the test oracle)."""
    w = Window.partitionBy(*partition_by).orderBy(*_spec(order_by)) if partition_by \
        else Window.orderBy(*_spec(order_by))
    rank_cols = list(rank_by) if rank_by is not None else [order_by[0].col]
    by_col = {o.col: o for o in order_by}
    rank_spec = _spec([by_col.get(c, Order(c)) for c in rank_cols])
    wr = Window.partitionBy(*partition_by).orderBy(*rank_spec) if partition_by else Window.orderBy(*rank_spec)
    cols = {}
    if row_number:
        cols[row_number] = F.row_number().over(w).cast("long")
    if dense_rank:
        cols[dense_rank] = F.dense_rank().over(wr).cast("long")
    for out, src in (lag or {}).items():
        cols[out] = F.lag(src).over(w)
    for out, src in (lead or {}).items():
        cols[out] = F.lead(src).over(w)
    for out, src in (running_sum or {}).items():
        cols[out] = F.sum(src).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumns(cols)
