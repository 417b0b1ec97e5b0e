"""A type-2 history that is stored and continued by every snapshot run.

The table keeps one location and is partitioned by (``state``, ``part``):

* ``state=open``: the open versions, dealt into a fixed number of buckets by
  a hash of their key (``part`` is ``bucket-<n>``);
* ``state=closed``: one partition per run (``part`` is ``run-<its time in
  microseconds since 1970>``), written by that run and never again.

A run joins the extract with the open versions only, stores the difference
and then writes no more than that: the closed versions as a new partition,
and the buckets that hold a changed key in place of the old ones (dynamic
partition overwrite).  Buckets without a change, and the closed versions of
all earlier runs, stay the files they are.  A run whose extract changes
nothing writes nothing but its line in the list of runs.

A run that ended half way is completed by the same run again: the closed
versions come first and are appended only where they are not there yet, the
buckets follow, and the run's line in ``_runs`` comes last.  An extract not
newer than the last complete run is passed over: it has been applied, or its
place in time is taken.
Two runs at once on one history are not coordinated.

Null and repeated keys of an extract are an error, since no version could be
told from another.  A history keeps the columns that it began with; an extract
of other columns is an error.  Files are replaced in place: a session that
reads the table by name while it stays open has to refresh it after a run.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.functions.dates import ts_ntz
from marketlens.operators.scd2 import VALID_FROM, VALID_TO, VERSION_ID, scd2_changes
from marketlens.sources.sinks import materialize, remove_folder, write_partitions

STATE, PART = "state", "part"
OPEN, CLOSED = "open", "closed"
#: Buckets of open versions; a run rewrites those with a changed key.  Set it
#: with the first run, so that a bucket is some files' size.
BUCKETS = 16
_RUNS = "run long, buckets int, closed long, opened long, columns array<string>"


def _time(spark: SparkSession, as_of: dt.datetime | str | Column) -> tuple[int, Column]:
    """A run's number (microseconds since 1970) and its time as a column."""
    if isinstance(as_of, Column):
        as_of = spark.range(1).select(as_of.cast("timestamp_ntz").alias("t")).first()["t"]
    when = dt.datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    return (when - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1), ts_ntz(when.isoformat(sep=" "))


def _found(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    try:
        reader = spark.read.schema(schema) if schema else spark.read
        return reader.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def runs(spark: SparkSession, path: str) -> DataFrame | None:
    """The complete runs of a history, one row each; None before the first."""
    return _found(spark, f"{path.rstrip('/')}/_runs", _RUNS)


def stored(spark: SparkSession, path: str, extract: DataFrame | None = None) -> DataFrame | None:
    """All versions with their ``state`` and ``part``; None where nothing is
    stored.  With the ``extract`` that a history is made of the schema is
    known and no file is opened for it."""
    if extract is None:
        return _found(spark, path.rstrip("/"))
    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in extract.schema.fields]
    types += [f"{VALID_FROM} timestamp_ntz", f"{VALID_TO} timestamp_ntz", f"{VERSION_ID} string", f"{STATE} string", f"{PART} string"]
    return _found(spark, path.rstrip("/"), ", ".join(types))


def history(spark: SparkSession, path: str) -> DataFrame:
    """All versions, open and closed."""
    return stored(spark, path).drop(STATE, PART)


def open_versions(spark: SparkSession, path: str) -> DataFrame:
    """The open versions; closed partitions are not read."""
    return stored(spark, path).where(F.col(STATE) == OPEN).drop(STATE, PART)


def _keyed_once(extract: DataFrame, key: str) -> None:
    """One aggregate over the keys alone."""
    twice = extract.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | F.col(key).isNull())
    bad = twice.agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("key")).first()
    if bad["n"]:
        raise ValueError(f"snapshot: {bad['n']} keys of the extract are null or repeated, such as {bad['key']}")


def apply_extract(spark: SparkSession, path: str, extract: DataFrame, key: str, check_cols: list[str],
                  as_of: dt.datetime | str | Column, *, buckets: int = BUCKETS, invalidate_hard_deletes: bool = True) -> bool:
    """Continue the history at ``path`` with one whole extract; whether it
    was applied (False: it is not newer than the last run)."""
    path = path.rstrip("/")
    run, when = _time(spark, as_of)
    done = runs(spark, path)
    last = done.agg(F.max(F.struct("run", "buckets", "columns")).alias("r")).first()["r"] if done is not None else None
    if last is not None:
        if run <= last["run"]:
            return False
        if sorted(last["columns"]) != sorted(extract.columns):
            raise ValueError(f"snapshot: the history has the columns {last['columns']}, the extract {extract.columns}")
        buckets = last["buckets"]
    _keyed_once(extract, key)
    before = stored(spark, path, extract)
    if before is None:
        none = spark.createDataFrame([], extract.schema).withColumns(
            {VALID_FROM: when, VALID_TO: when, VERSION_ID: F.lit("")})
        opened = none
    else:
        opened = before.where(F.col(STATE) == OPEN)
    changes = scd2_changes(opened, extract, key, check_cols, when, invalidate_hard_deletes=invalidate_hard_deletes)
    changes = materialize(changes.withColumn(PART, F.concat(F.lit("bucket-"), F.pmod(F.xxhash64("key"), F.lit(buckets)))))
    counts = changes.groupBy(PART).agg(F.count("old").alias("closed"), F.count("new").alias("opened")).collect()  # a row a bucket
    if sum(r["closed"] for r in counts):
        closing = changes.where(F.col("old").isNotNull()).select("old.*")
        known = before.where((F.col(STATE) == CLOSED) & (F.col(PART) == f"run-{run}")).select(VERSION_ID)
        _partitioned(closing.join(known, VERSION_ID, "left_anti").select(*closing.columns, F.lit(CLOSED).alias(STATE), F.lit(f"run-{run}").alias(PART)),
                     path, "append")
    if counts:
        parts = [r[PART] for r in counts]
        opening = changes.where(F.col("new").isNotNull()).select("new.*", F.lit(OPEN).alias(STATE), PART)
        if before is not None:
            touched = before.where((F.col(STATE) == OPEN) & F.col(PART).isin(parts))
            gone = changes.where(F.col("old").isNotNull()).select(F.col("old")[VERSION_ID].alias(VERSION_ID))
            opening = touched.join(gone, VERSION_ID, "left_anti").select(*opening.columns).unionByName(opening)
        opening = materialize(opening)
        _partitioned(opening, path, "overwrite")
        left = {r[PART] for r in opening.select(PART).distinct().collect()}
        for part in set(parts) - left:  # overwriting by partition leaves one without rows as it was
            remove_folder(spark, f"{path}/{STATE}={OPEN}/{PART}={part}")
    line = [(run, buckets, sum(r["closed"] for r in counts), sum(r["opened"] for r in counts), extract.columns)]
    spark.createDataFrame(line, _RUNS).coalesce(1).write.mode("append").parquet(f"{path}/_runs")
    return True


def _partitioned(versions: DataFrame, path: str, mode: str) -> None:
    write_partitions(versions, path, [STATE, PART], mode)
