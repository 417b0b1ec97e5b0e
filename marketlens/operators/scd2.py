"""Type-2 slowly changing dimension (snapshot with a ``check`` strategy).

``scd2_apply(history, current, key, check_cols, as_of)`` returns the new
history:

* first run (``history`` is None): every current row opens a version;
* key unchanged on all check columns (null-safe) -> open version kept as is
  (other columns such as ``created_at`` are not compared);
* any check column differs -> open version closed at ``as_of`` and a new
  version opened;
* key missing from ``current`` -> open version closed (hard delete);
* key present but without an open version (new, or returned after a
  delete) -> new version opened.

Only open versions meet ``current`` in one full outer join on the key (one
shuffle); closed versions pass through untouched.  Each joined row emits its
0-2 output versions through a single ``explode``, so the join is evaluated
once.  Version ids are ``md5(key | valid_from)``.

``scd2_changes`` gives only what a run changes (versions to close and to
open), for a history that is stored (``sources.history``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VALID_FROM, VALID_TO, VERSION_ID = "valid_from", "valid_to", "version_id"


def _version_id(key: Column, valid_from: Column) -> Column:
    return F.md5(F.concat_ws("|", key.cast("string"), valid_from.cast("string")))


def scd2_apply(history: DataFrame | None, current: DataFrame, key: str, check_cols: list[str],
               as_of: Column, *, invalidate_hard_deletes: bool = True) -> DataFrame:
    cols = current.columns
    if history is None:
        return current.select(
            *cols, as_of.alias(VALID_FROM), F.lit(None).cast(as_of_type(current, as_of)).alias(VALID_TO),
            _version_id(F.col(key), as_of).alias(VERSION_ID))

    out_cols = cols + [VALID_FROM, VALID_TO, VERSION_ID]
    closed = history.filter(F.col(VALID_TO).isNotNull()).select(*out_cols)
    open_ = history.filter(F.col(VALID_TO).isNull()).select(
        *[F.col(c).alias(f"h_{c}") for c in out_cols])
    cur = current.select(*[F.col(c).alias(f"c_{c}") for c in cols])
    j = open_.join(cur, F.col(f"h_{key}") == F.col(f"c_{key}"), "full_outer")

    has_old, has_new = F.col(f"h_{key}").isNotNull(), F.col(f"c_{key}").isNotNull()
    same = None
    for c in check_cols:
        eq = F.col(f"h_{c}").eqNullSafe(F.col(f"c_{c}"))
        same = eq if same is None else (same & eq)
    changed = has_old & has_new & ~same
    deleted = has_old & ~has_new

    close_old = changed | deleted if invalidate_hard_deletes else changed
    old_row = F.struct(*[F.col(f"h_{c}").alias(c) for c in cols],
                       F.col(f"h_{VALID_FROM}").alias(VALID_FROM),
                       F.when(close_old, as_of).otherwise(F.col(f"h_{VALID_TO}")).alias(VALID_TO),
                       F.col(f"h_{VERSION_ID}").alias(VERSION_ID))
    new_row = F.struct(*[F.col(f"c_{c}").alias(c) for c in cols],
                       as_of.alias(VALID_FROM),
                       F.lit(None).cast(as_of_type(current, as_of)).alias(VALID_TO),
                       _version_id(F.col(f"c_{key}"), as_of).alias(VERSION_ID))
    emitted = F.filter(F.array(F.when(has_old, old_row), F.when(~has_old | changed, new_row)),
                       lambda x: x.isNotNull())
    versions = j.select(F.explode(emitted).alias("v")).select("v.*")
    return closed.unionByName(versions)


def scd2_changes(open_versions: DataFrame, current: DataFrame, key: str, check_cols: list[str], as_of: Column, *,
                 invalidate_hard_deletes: bool = True) -> DataFrame:
    """One row per key whose open version changes: ``old``, the version that
    is closed at ``as_of`` (null: there was none), and ``new``, the version
    that is opened (null: the key is gone).  Keys without a change, which are
    nearly all in a usual run, have no row.
    """
    cols = current.columns
    kind = as_of_type(current, as_of)
    h = open_versions.select(F.struct(*cols, VALID_FROM, as_of.cast(kind).alias(VALID_TO), VERSION_ID).alias("old"),
                             F.col(key).alias("h_key"))
    c = current.select(F.struct(*cols, as_of.cast(kind).alias(VALID_FROM), F.lit(None).cast(kind).alias(VALID_TO),
                                _version_id(F.col(key), as_of).alias(VERSION_ID)).alias("new"), F.col(key).alias("c_key"))
    j = h.join(c, F.col("h_key") == F.col("c_key"), "full_outer")
    same = F.lit(True)
    for col in check_cols:
        same = same & F.col("old")[col].eqNullSafe(F.col("new")[col])
    gone = F.col("c_key").isNull()
    changed = F.col("h_key").isNull() | (~gone & ~same)
    return j.where((changed | gone) if invalidate_hard_deletes else changed).select(
        F.coalesce("h_key", "c_key").alias("key"), "old", "new")


def as_of_type(df: DataFrame, as_of: Column) -> str:
    return df.sparkSession.range(1).select(as_of.alias("t")).schema["t"].dataType.simpleString()


def current_versions(history: DataFrame) -> DataFrame:
    """Open versions only (the 'current' view)."""
    return history.filter(F.col(VALID_TO).isNull())
