"""Data-quality checks as one report DataFrame.

Output: ``table_name, check_name, column_names, failing_rows``.

``run_suite`` groups keys by domain (the columns that a key is unique in, or
refers to), all domains in one job:

* a domain's rows are its parent rows and the child and detail rows that refer
  to it, each with its key in its own type and counters of what it is.  They
  meet in a shuffle of that domain alone, summed per key in each task before
  it, so that a hot key is one row a task.  No row is multiplied or carries
  the keys of other domains, and a scan reads only the columns of its domain;
* a key's counts then tell all of its checks at once: ``unique`` and
  ``unique_combination`` count keys with several parent rows, ``relationships``
  the child rows of keys without a parent, ``reconciliation`` the keys whose
  stored total differs from the sum of their detail rows;
* rows that lack a part of their own key are counted by the same groups, which
  keep null keys until the last step (filtered earlier, they would also keep
  domains from sharing the shuffles that a table is made of), so a table with
  one key and its ``not_null`` is computed once;
* all other row checks and freshness are counted in a scan of the table's own
  without a shuffle: as counters beside the keys they would be carried through
  it with every key;
* what comes back is a row a domain and a row a table with such checks.

(``DataFrame.observe`` would count failing rows on the side, but twice where a
task runs again after an executor is lost.)

Keys with a null part take part in nothing, as in SQL.  ``freshness`` fails
(1 row) when the newest timestamp is older than ``as_of - max_age``.

Row predicates are plain SQL expressions, so the same text runs in Spark
(``F.expr``) and in any SQL oracle.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType


@dataclass(frozen=True)
class RowCheck:
    table: str
    check: str
    columns: str
    failing_sql: str  # SQL predicate that is TRUE for a failing row


@dataclass(frozen=True)
class UniqueCheck:
    table: str
    columns: tuple[str, ...]

    @property
    def check(self) -> str:
        return "unique" if len(self.columns) == 1 else "unique_combination"


@dataclass(frozen=True)
class RelationshipCheck:
    table: str
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class FreshnessCheck:
    table: str
    column: str
    as_of: str
    max_age_days: int


@dataclass(frozen=True)
class ReconcileCheck:
    table: str
    key: str
    stored: str
    detail: str
    detail_key: str
    detail_amount: str


@dataclass
class Suite:
    rows: list[RowCheck] = field(default_factory=list)
    uniques: list[UniqueCheck] = field(default_factory=list)
    relationships: list[RelationshipCheck] = field(default_factory=list)
    freshness: list[FreshnessCheck] = field(default_factory=list)
    reconcile: list[ReconcileCheck] = field(default_factory=list)


def not_null(table: str, col: str) -> RowCheck:
    return RowCheck(table, "not_null", col, f"{col} is null")


def accepted_values(table: str, col: str, values: list[str]) -> RowCheck:
    lits = ", ".join("'" + v + "'" for v in values)
    return RowCheck(table, "accepted_values", col, f"{col} is not null and {col} not in ({lits})")


def constraint(table: str, col: str, predicate: str) -> RowCheck:
    """``predicate`` must hold; null values pass (as a SQL CHECK does)."""
    return RowCheck(table, "row_constraint", col, f"not coalesce({predicate}, true)")


def _all_not_null(cols) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


@dataclass
class _Domain:
    """A set of keys: where they are unique, who refers to them, and which
    totals are kept for them."""
    number: int
    parents: list[tuple[str, tuple[str, ...]]] = field(default_factory=list)  # at most one; a check's own
    unique: UniqueCheck | None = None
    children: list[RelationshipCheck] = field(default_factory=list)
    reconcile: ReconcileCheck | None = None


def _domains(suite: Suite) -> list[_Domain]:
    found: dict[tuple[str, tuple[str, ...]], _Domain] = {}

    def of(table: str, columns: tuple[str, ...]) -> _Domain:
        key = table, columns
        if key not in found:
            found[key] = _Domain(len(found), [key])
        return found[key]

    extra: list[_Domain] = []
    for u in suite.uniques:
        of(u.table, u.columns).unique = u
    for r in suite.relationships:
        of(r.parent, (r.parent_column,)).children.append(r)
    for rc in suite.reconcile:
        domain = of(rc.table, (rc.key,))
        if domain.reconcile is None:
            domain.reconcile = rc
        else:
            extra.append(_Domain(len(found) + len(extra), [(rc.table, (rc.key,))], reconcile=rc))
    out = [*found.values(), *extra]
    for n, d in enumerate(out):
        d.number = n
    return out


_REPORT = "table_name string, check_name string, column_names string, failing_rows long"


def _amount_type(frames: dict[str, DataFrame], suite: Suite) -> str:
    """The type of totals: that of the columns if they have one, else wide."""
    kinds = {frames[t].schema[c].dataType.simpleString() for r in suite.reconcile for t, c in ((r.table, r.stored), (r.detail, r.detail_amount))}
    return kinds.pop() if len(kinds) == 1 else "decimal(38,6)" if kinds else "decimal(1,0)"


def _whole(frames: dict[str, DataFrame], table: str, columns: tuple[str, ...]) -> bool:
    return len(columns) == 1 and isinstance(frames[table].schema[columns[0]].dataType, IntegralType)


def _key(df: DataFrame, columns: tuple[str, ...]) -> list[Column]:
    """A row's key in a domain.  A single whole number is kept as such, any
    other single column becomes text; several columns keep their types."""
    if len(columns) > 1:
        return [F.col(c).alias(f"key{n}") for n, c in enumerate(columns)]
    whole = isinstance(df.schema[columns[0]].dataType, IntegralType)
    return [F.col(columns[0]).cast("long" if whole else "string").alias("key0")]


def _fresh(f: FreshnessCheck) -> str:
    return f"{f.column} >= timestamp_ntz'{f.as_of}' - make_dt_interval({f.max_age_days})"


def _domain_counts(frames: dict[str, DataFrame], d: _Domain, kind: str) -> DataFrame:
    """A row a key of the domain, with what its checks count there; keys with
    a null part are counted in ``absent`` alone."""
    table, columns = d.parents[0]
    rc = d.reconcile
    roles: dict[tuple[str, str], int] = {}  # of the columns that refer to the domain; a parent row's is -1
    for r in d.children:
        if _whole(frames, r.table, (r.column,)) != _whole(frames, table, columns):
            raise TypeError(f"{r.table}.{r.column} and {r.parent}.{r.parent_column} are of different types")
        roles.setdefault((r.table, r.column), len(roles))
    if rc:
        roles.setdefault((rc.detail, rc.detail_key), len(roles))

    def emit(name: str, cols: tuple[str, ...], role: int, amount: str | None) -> DataFrame:
        amounts = [(F.lit(None) if amount is None else F.col(amount)).cast(kind).alias("amount")] if rc else []
        return frames[name].select(*_key(frames[name], cols), F.lit(role).alias("role"), *amounts)

    rows = reduce(DataFrame.unionByName, [
        emit(table, columns, -1, rc.stored if rc else None),
        *[emit(name, (column,), role, rc.detail_amount if rc and (name, column) == (rc.detail, rc.detail_key) else None)
          for (name, column), role in roles.items()]])

    keys, role = [f"key{n}" for n in range(len(columns))], F.col("role")
    by_key = rows.groupBy(*keys).agg(
        F.count_if(role == -1).alias("parents"),
        *[F.count_if(role == roles[r.table, r.column]).alias(f"child{n}") for n, r in enumerate(d.children)],
        *([F.max(F.when(role == -1, F.col("amount"))).alias("stored"),
           F.sum(F.when(role == roles[rc.detail, rc.detail_key], F.col("amount"))).alias("detail")] if rc else []))
    known, parents = _all_not_null(keys), F.col("parents")
    differs = (parents > 0) & ~F.col("stored").eqNullSafe(F.coalesce("detail", F.lit(0))) if rc else F.lit(False)
    counts = by_key.select(
        F.when(known & (parents > 1), 1).otherwise(0).alias("repeated"), F.when(known & differs, 1).otherwise(0).alias("differing"),
        *[F.when(known & (parents == 0), F.col(f"child{n}")).otherwise(0).alias(f"orphans{n}") for n in range(len(d.children))],
        *[F.when(F.col(k).isNull(), parents).otherwise(0).alias(f"absent{n}") for n, k in enumerate(keys)])
    return _counting(counts)


def _counting(counts: DataFrame) -> DataFrame:
    """The rows that count for any check: few, where most keys and rows pass."""
    return counts.where(reduce(Column.__or__, [F.col(c) > 0 for c in counts.columns]))


def run_suite(frames: dict[str, DataFrame], suite: Suite) -> DataFrame:
    """Run all checks; the report has a row a check."""
    spark = next(iter(frames.values())).sparkSession
    domains, kind = _domains(suite), _amount_type(frames, suite)
    parts = [_domain_counts(frames, d, kind) for d in domains]
    absent = {(d.parents[0][0], c): (d.number, f"absent{n}") for d in reversed(domains) for n, c in enumerate(d.parents[0][1])}
    found_in: dict[tuple[str, str], tuple[int, str]] = {}  # a table's condition: where its rows are counted
    scans: dict[str, list[str]] = {}
    for table, condition in [*[(c.table, c.failing_sql) for c in suite.rows], *[(f.table, _fresh(f)) for f in suite.freshness]]:
        column = condition.removesuffix(" is null")
        if column != condition and (table, column) in absent:
            found_in[table, condition] = absent[table, column]
        elif (table, condition) not in found_in:
            met = scans.setdefault(table, [])
            found_in[table, condition] = len(domains) + list(scans).index(table), f"met{len(met)}"
            met.append(condition)
    parts += [_counting(frames[table].select(*[F.when(F.expr(c), 1).otherwise(0).alias(f"met{n}") for n, c in enumerate(met)]))
              for table, met in scans.items()]
    if not parts:
        return spark.createDataFrame([], _REPORT)
    names = list(dict.fromkeys(c for p in parts for c in p.columns))
    sums = [p.select(F.lit(n).alias("part"), *[(F.col(c) if c in p.columns else F.lit(None)).cast("long").alias(c) for c in names])
            for n, p in enumerate(parts)]
    found = reduce(DataFrame.unionByName, sums).groupBy("part").agg(*[F.sum(c).alias(c) for c in names]).collect()
    by_part = {r["part"]: r for r in found}

    def count(part: int, column: str) -> int:
        return by_part[part][column] if part in by_part else 0

    report = [(c.table, c.check, c.columns, count(*found_in[c.table, c.failing_sql])) for c in suite.rows]
    for d in domains:
        if d.unique:
            report.append((d.unique.table, d.unique.check, ",".join(d.unique.columns), count(d.number, "repeated")))
        report += [(c.table, "relationships", f"{c.column}->{c.parent}.{c.parent_column}", count(d.number, f"orphans{n}"))
                   for n, c in enumerate(d.children)]
        if d.reconcile:
            rc = d.reconcile
            report.append((rc.table, "reconciliation", f"{rc.stored}=sum({rc.detail}.{rc.detail_amount})", count(d.number, "differing")))
    report += [(f.table, "freshness", f.column, int(not count(*found_in[f.table, _fresh(f)]))) for f in suite.freshness]
    return spark.createDataFrame(report, _REPORT)


def suite_sql(suite: Suite) -> str:
    """The same suite as one SQL statement over relations named like the frames."""
    sel = []
    for rc in suite.rows:
        sel.append(f"select '{rc.table}' as table_name, '{rc.check}' as check_name, '{rc.columns}' as column_names, "
                   f"cast(coalesce(sum(case when {rc.failing_sql} then 1 else 0 end), 0) as bigint) as failing_rows "
                   f"from {rc.table}")
    for u in suite.uniques:
        cols = ", ".join(u.columns)
        nn = " and ".join(f"{c} is not null" for c in u.columns)
        sel.append(f"select '{u.table}', '{u.check}', '{','.join(u.columns)}', cast(count(*) as bigint) from "
                   f"(select {cols} from {u.table} where {nn} group by {cols} having count(*) > 1)")
    for r in suite.relationships:
        sel.append(f"select '{r.table}', 'relationships', '{r.column}->{r.parent}.{r.parent_column}', "
                   f"cast(count(*) as bigint) from {r.table} c where c.{r.column} is not null and not exists "
                   f"(select 1 from {r.parent} p where p.{r.parent_column} = c.{r.column})")
    for f in suite.freshness:
        sel.append(f"select '{f.table}', 'freshness', '{f.column}', cast(case when max({f.column}) is null or "
                   f"max({f.column}) < timestamp '{f.as_of}' - to_days({f.max_age_days}) then 1 else 0 end as bigint) "
                   f"from {f.table}")
    for rc in suite.reconcile:
        sel.append(f"select '{rc.table}', 'reconciliation', '{rc.stored}=sum({rc.detail}.{rc.detail_amount})', "
                   f"cast(count(*) as bigint) from {rc.table} t left join (select {rc.detail_key} as k, "
                   f"sum({rc.detail_amount}) as d from {rc.detail} group by 1) x on t.{rc.key} = x.k "
                   f"where t.{rc.stored} is distinct from coalesce(x.d, 0)")
    return "\nunion all\n".join(sel)
