"""Null policy (N2-N4, F5): sequential impute-or-drop, planned from one or two aggregate jobs.

The rule (per column, in column order): let n be the row count of the input, k the nulls of
the column in the *current* frame (earlier drops applied). k = 0: nothing. k/n*100 below the
threshold: drop those rows. Otherwise fill: numeric columns with the mean of the current
frame (cast to the column type, so integer columns truncate), other columns with the mode
(most frequent non-null value, ties to the smallest).

Plan, instead of 1 + m counts and one job per fill:
  1. one aggregate of every column's null count, sum, non-null count and NaN count over the rows alive under the
     drops found so far, repeated for the columns behind a new drop (one row per pass; typically one or two passes).
  2. only if some non-numeric column needs a mode: a summary of every such column's frequent values, then the exact counts of
     the values that can be the mode (all columns together, each counting only rows alive at its step).
  3. apply as one filter + one projection: a narrow stage, no shuffle.
The column-by-column loop (``plan_null_policy_sequential``) is the reference semantics for tests.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripspark.fixed import NULL_DROP_THRESHOLD_PCT
from tripspark.schema import FLOATING_TYPES, INTEGRAL_TYPES, is_numeric

DEFAULT_THRESHOLD_PCT = NULL_DROP_THRESHOLD_PCT


@dataclass(frozen=True)
class ColumnDecision:
    column: str
    position: int
    data_type: str
    null_count: int  # nulls in the frame current when the column is visited
    null_pct: float  # of the initial row count
    action: str  # none | drop | fill_mean | fill_mode | unfillable
    fill_value: object = None


@dataclass
class NullPlan:
    n_rows: int
    decisions: list[ColumnDecision]
    nan_as_null: bool = True
    method: str = "fixed-point"
    extra: dict = field(default_factory=dict)
    # floating columns seen holding NaN when planned; None = unknown, map every floating column
    nan_columns: frozenset | None = None
    # the mean of every numeric column that has one, at its step: fills for columns without nulls when planned
    means: dict[str, object] = field(default_factory=dict)

    @property
    def drop_columns(self) -> list[str]:
        return [d.column for d in self.decisions if d.action == "drop"]

    @property
    def fills(self) -> dict[str, object]:
        return {d.column: d.fill_value for d in self.decisions if d.action in ("fill_mean", "fill_mode")}

    def apply(self, df: DataFrame, planned_on: bool = True) -> DataFrame:
        """One filter and one projection; usable on a batch or on a stream with the same schema.

        NaN -> null is applied only to the floating columns that held NaN when the plan was made,
        so the others reach the filter as plain columns and their predicates push down to the
        scan. ``planned_on=False``: ``df`` is not the frame the plan was made on (another batch, a
        stream), so NaN may stand in any floating column, and a numeric column that had no null then is filled
        with its mean.
        """
        only = self.nan_columns if planned_on else None
        out = nan_to_null(df, only) if self.nan_as_null else df
        drops = self.drop_columns
        if drops:
            out = out.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in drops]))
        fills = self.fills
        if not planned_on:
            fills = {c: v for c, v in self.means.items() if c not in drops} | fills
        if not fills:
            return out
        types = {f.name: f.dataType for f in out.schema.fields}
        return out.select(
            *[
                F.coalesce(F.col(c), _literal(fills[c], types[c])).alias(c) if c in fills else F.col(c)
                for c in out.columns
            ]
        )

    def report(self, spark: SparkSession) -> DataFrame:
        """The decisions as a small DataFrame (column, action, counts, fill value as text)."""
        rows = [
            (d.column, d.position, d.data_type, d.null_count, d.null_pct, d.action,
             None if d.fill_value is None else str(d.fill_value))
            for d in self.decisions
        ]
        schema = "column_name string, position int, data_type string, null_count long, null_pct double, action string, fill_value string"
        return spark.createDataFrame(rows, schema)


def _literal(value: object, dt: T.DataType) -> Column:
    # Non-numeric values travel as their Spark string form and are cast back in the JVM,
    # which keeps timestamps free of any Python time-zone conversion.
    if isinstance(dt, T.DecimalType):
        return F.lit(str(value)).cast(dt)
    if is_numeric(dt):
        return F.lit(value).cast(dt)
    return F.lit(str(value)).cast(dt)


def nan_to_null(df: DataFrame, only: frozenset | set | None = None) -> DataFrame:
    """NaN -> null in floating columns (na.drop / fillna treat NaN as null, isNull does not).
    ``only``: restrict to these columns."""
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, FLOATING_TYPES) and (only is None or f.name in only)]
    if not floating:
        return df
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floating})


def _mean_fill(mean: float, dt: T.DataType) -> object:
    if isinstance(dt, INTEGRAL_TYPES):
        return int(mean)  # truncation toward zero, as a cast of the mean to the column type
    if isinstance(dt, T.DecimalType):
        return Decimal(repr(mean))
    return float(mean)


def _decide(f: T.StructField, position: int, k: int, n: int, dropped: bool, numeric: bool, mean: float | None) -> ColumnDecision:
    """One column's decision from its current null count ``k`` (of ``n`` input rows): none when
    it has no nulls, drop, fill with the mean (numeric; unfillable without any value), or fill
    with the mode (value resolved by :func:`column_modes`)."""
    base = dict(column=f.name, position=position, data_type=f.dataType.simpleString(), null_count=k, null_pct=(k / n * 100.0) if n else 0.0)
    if k == 0:
        return ColumnDecision(action="none", **base)
    if dropped:
        return ColumnDecision(action="drop", **base)
    if numeric:
        if mean is None:
            return ColumnDecision(action="unfillable", **base)
        return ColumnDecision(action="fill_mean", fill_value=_mean_fill(mean, f.dataType), **base)
    return ColumnDecision(action="fill_mode", **base)


def _below(k: int, n: int, threshold_pct: float) -> bool:
    return k > 0 and n > 0 and k / n * 100.0 < threshold_pct


def _alive(drop_columns: list[str]) -> Column:
    if not drop_columns:
        return F.lit(True)
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in drop_columns])


def _exact_modes(df: DataFrame, targets: list[tuple[str, list[str]]]) -> dict[str, tuple[str | None, int]]:
    """Mode of each target column and its count, from the counts of all values of ``df``'s columns: GROUPING SETS over the
    target columns, then a global min over struct(-count, value)."""
    cols = [c for c, _ in targets]
    grouped = df.groupingSets([[c] for c in cols], *cols).agg(
        *[F.grouping(c).alias(f"_g{i}") for i, c in enumerate(cols)],
        *[F.sum(f"_a{i}").alias(f"_c{i}") for i in range(len(cols))],
    )
    best = grouped.agg(
        *[
            F.min(
                F.when(
                    (F.col(f"_g{i}") == 0) & F.col(c).isNotNull() & (F.col(f"_c{i}") > 0),
                    F.struct((-F.col(f"_c{i}")).alias("neg_count"), F.col(c).alias("value")),
                )
            ).alias(f"_m{i}")
            for i, c in enumerate(cols)
        ]
    )
    best = best.select(*[F.struct(F.col(f"_m{i}.value").cast("string").alias("v"), (-F.col(f"_m{i}.neg_count")).alias("n")).alias(f"_m{i}") for i in range(len(cols))])
    row = best.collect()[0]  # exactly one row
    return {c: (row[f"_m{i}"]["v"], row[f"_m{i}"]["n"] or 0) for i, c in enumerate(cols)}


SUMMARY_ITEMS = 4096  # values that the summary of a column follows
SUMMARY_TYPES = (T.StringType, T.BooleanType, T.DateType, T.DecimalType, *INTEGRAL_TYPES)  # followed as they are, others as text


def _summary_key(df: DataFrame, c: str) -> Column:
    kind = df.schema[c].dataType
    if isinstance(kind, SUMMARY_TYPES):
        return F.col(c)
    return (F.col(c) + F.lit(0.0) if isinstance(kind, FLOATING_TYPES) else F.col(c)).cast("string")  # -0.0 is 0.0


def column_modes(df: DataFrame, targets: list[tuple[str, list[str]]]) -> dict[str, str | None]:
    """Mode of each target column over the rows alive at its step.

    ``targets``: (column, drop columns applied before it). Nulls are not a candidate; ties go
    to the smallest value. Returns the value in Spark's string form (None if no value).

    1. One aggregate: a mergeable summary of each column's frequent values (``approx_top_k``), of bounded size however many
       values a column has. A value it does not list occurs at most ``7 * n / SUMMARY_ITEMS`` times (n: rows of the column;
       twice the summary's own error of at most 3.5 n over its size).
    2. One job of exact counts, only of the values whose estimate is within that bound of the best: a few groups per column and task.
    3. If the best exact count exceeds the bound, no unlisted value can reach it. Otherwise (nearly unique columns, whose mode
       is a matter of a few rows) all the values of that column are counted, by a scan pruned to it.
    """
    if not targets:
        return {}
    named = [f"_v{i}" for i in range(len(targets))]
    taken = df.select(
        *[F.when(_alive(drops), F.col(c)).alias(v) for v, (c, drops) in zip(named, targets, strict=True)],
        *[F.when(_alive(drops), _summary_key(df, c)).alias(f"_k{i}") for i, (c, drops) in enumerate(targets)],
    )
    summary = taken.agg(
        *[F.count(v).alias(f"_n{i}") for i, v in enumerate(named)],
        *[F.expr(f"approx_top_k(_k{i}, {SUMMARY_ITEMS}, {SUMMARY_ITEMS}) FILTER (WHERE _k{i} IS NOT NULL)").alias(f"_t{i}") for i in range(len(named))],
    ).collect()[0]  # one row, at most SUMMARY_ITEMS values a column
    bounds: dict[int, int] = {}
    masked: dict[str, Column] = {}
    for i, v in enumerate(named):
        listed = sorted(((r["count"], r["item"]) for r in summary[f"_t{i}"] or []), key=lambda r: -r[0])
        bound = 7 * summary[f"_n{i}"] // SUMMARY_ITEMS
        near = [item for n, item in listed if n >= listed[0][0] - bound]
        # a full list may leave out values as frequent as its last one
        bounds[i] = max(bound, listed[-1][0] + bound if len(listed) >= SUMMARY_ITEMS else 0)
        masked[v] = F.when(F.col(f"_k{i}").isin(near), F.col(v)) if near else F.lit(None).cast(taken.schema[v].dataType)
    ones = {f"_a{i}": F.col(v).isNotNull().cast("long") for i, v in enumerate(named)}
    counted = _exact_modes(taken.withColumns(masked).withColumns(ones), [(v, []) for v in named])
    modes: dict[str, str | None] = {}
    for i, (v, (c, _)) in enumerate(zip(named, targets, strict=True)):
        if counted[v][1] <= bounds[i] and summary[f"_n{i}"]:
            alone = taken.select(v, F.col(v).isNotNull().cast("long").alias("_a0"))
            counted[v] = _exact_modes(alone, [(v, [])])[v]
        modes[c] = counted[v][0]
    return modes


def _resolve_modes(df: DataFrame, decisions: list[ColumnDecision], targets: list[tuple[str, list[str]]]) -> list[ColumnDecision]:
    if not targets:
        return decisions
    modes = column_modes(df, targets)
    out = []
    for d in decisions:
        if d.action == "fill_mode":
            value = modes.get(d.column)
            d = ColumnDecision(**{**d.__dict__, "action": "fill_mode" if value is not None else "unfillable", "fill_value": value})
        out.append(d)
    return out


def plan_null_policy(
    df: DataFrame,
    threshold_pct: float = DEFAULT_THRESHOLD_PCT,
    nan_as_null: bool = True,
) -> NullPlan:
    """The rule's decisions as a fixed point.

    Drops only remove rows, so a column's current null count can only fall as more earlier
    columns are dropped. Start with no drops; in one aggregate pass compute, for every column,
    its null count, sum and non-null count over the rows alive under the drops decided so far
    (for earlier columns only); add every column now below the threshold; repeat for the columns behind a
    new drop until there are none. The set never exceeds the true one and its fixed point is exactly the
    sequential rule's (each pass is one scan, pruned to the columns that can still change; typically one or two).
    """
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, FLOATING_TYPES)] if nan_as_null else []
    flagged = df.withColumns({f"_isnan_{i}": F.isnan(c) for i, c in enumerate(floating)}) if floating else df
    prepared = nan_to_null(flagged) if nan_as_null else flagged
    fields = df.schema.fields
    numeric = {i for i, f in enumerate(fields) if is_numeric(f.dataType)}
    drops: set[int] = set()
    passes, n, nan_columns = 0, 0, None
    nulls: dict[int, int] = {}
    sums: dict[int, tuple] = {}  # of numeric columns: sum, non-null count
    pending = list(range(len(fields)))
    while pending or not passes:
        passes += 1
        aggs = []
        if nan_columns is None:
            aggs = [F.count(F.lit(1)).alias("_n"), *[F.count_if(f"_isnan_{i}").alias(f"_nan{i}") for i in range(len(floating))]]
        for j in pending:
            f, alive = fields[j], _alive([fields[d].name for d in sorted(drops) if d < j])
            aggs.append(F.count_if(F.col(f.name).isNull() & alive).alias(f"_k{j}"))
            if j in numeric:
                aggs.append(F.sum(F.when(alive, F.col(f.name).cast("double"))).alias(f"_s{j}"))
                aggs.append(F.count(F.when(alive, F.col(f.name))).alias(f"_c{j}"))
        row = prepared.agg(*aggs).collect()[0]  # one row
        if nan_columns is None:
            n = row["_n"]
            nan_columns = frozenset(c for i, c in enumerate(floating) if row[f"_nan{i}"] > 0)
        for j in pending:
            nulls[j] = row[f"_k{j}"]
            if j in numeric:
                sums[j] = (row[f"_s{j}"], row[f"_c{j}"])
        new = {j for j in range(len(fields)) if _below(nulls[j], n, threshold_pct)} - drops
        drops |= new
        # a new drop changes only what stands behind it: null counts that are not 0, and sums
        pending = [j for j in range(len(fields)) if any(d < j for d in new) and (nulls[j] or j in numeric)]
    decisions: list[ColumnDecision] = []
    mode_targets: list[tuple[str, list[str]]] = []
    means: dict[str, object] = {}
    for j, f in enumerate(fields):
        total, known = sums.get(j, (None, 0))
        mean = total / known if known else None
        if mean is not None and math.isfinite(mean):
            means[f.name] = _mean_fill(mean, f.dataType)
        d = _decide(f, j + 1, nulls[j], n, j in drops, j in numeric, mean)
        decisions.append(d)
        if d.action == "fill_mode":
            mode_targets.append((f.name, [fields[x].name for x in sorted(drops) if x < j]))
    decisions = _resolve_modes(prepared, decisions, mode_targets)
    return NullPlan(n_rows=n, decisions=decisions, nan_as_null=nan_as_null, extra={"passes": passes}, nan_columns=nan_columns, means=means)


def plan_null_policy_sequential(df: DataFrame, threshold_pct: float = DEFAULT_THRESHOLD_PCT, nan_as_null: bool = True) -> NullPlan:
    """The column-by-column form of the rule: one aggregate per column with nulls.

    The reference semantics in property tests.
    """
    current = nan_to_null(df) if nan_as_null else df
    fields = current.schema.fields
    first = current.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(f.name).isNull()).alias(f"_k{i}") for i, f in enumerate(fields)]).collect()[0]
    n = first["n"]
    decisions: list[ColumnDecision] = []
    drops: list[str] = []
    for i, f in enumerate(fields):
        if first[f"_k{i}"] == 0:  # a column without nulls never gains any
            decisions.append(_decide(f, i + 1, 0, n, False, is_numeric(f.dataType), None))
            continue
        frame = current.filter(_alive(drops)) if drops else current
        stats = frame.agg(
            F.count_if(F.col(f.name).isNull()).alias("k"),
            (F.avg(F.col(f.name).cast("double")) if is_numeric(f.dataType) else F.lit(None)).alias("mean"),
        ).collect()[0]
        d = _decide(f, i + 1, stats["k"], n, _below(stats["k"], n, threshold_pct), is_numeric(f.dataType), stats["mean"])
        if d.action == "drop":
            drops.append(f.name)
        elif d.action == "fill_mode":
            value = column_modes(current, [(f.name, list(drops))])[f.name]
            d = ColumnDecision(**{**d.__dict__, "action": "fill_mode" if value is not None else "unfillable", "fill_value": value})
        decisions.append(d)
    return NullPlan(n_rows=n, decisions=decisions, nan_as_null=nan_as_null, method="sequential")


def apply_null_policy(df: DataFrame, threshold_pct: float = DEFAULT_THRESHOLD_PCT, nan_as_null: bool = True) -> DataFrame:
    """Plan from the data, then return the cleaned frame."""
    return plan_null_policy(df, threshold_pct, nan_as_null).apply(df)


def _null_counts(df: DataFrame, columns: list[str]) -> dict[str, int]:
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).collect()[0]
    return {c: row[c] for c in columns}


def fill_mean(df: DataFrame, columns: list[str] | None = None, nan_as_null: bool = True) -> DataFrame:
    """Fill numeric columns by their mean (integer columns truncate). One aggregate job."""
    prepared = nan_to_null(df) if nan_as_null else df
    types = {f.name: f.dataType for f in prepared.schema.fields}
    cols = columns or [c for c, t in types.items() if is_numeric(t)]
    if not cols:
        return prepared
    row = prepared.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols]).collect()[0]
    fills = {c: _mean_fill(row[c], types[c]) for c in cols if row[c] is not None}
    return prepared.withColumns({c: F.coalesce(F.col(c), _literal(v, types[c])) for c, v in fills.items()})


def fill_mode(df: DataFrame, columns: list[str] | None = None, nan_as_null: bool = True) -> DataFrame:
    """Fill columns by their mode (non-null, ties to the smallest)."""
    prepared = nan_to_null(df) if nan_as_null else df
    types = {f.name: f.dataType for f in prepared.schema.fields}
    cols = columns or list(types)
    with_nulls = [c for c, k in _null_counts(prepared, cols).items() if k > 0]
    modes = column_modes(prepared, [(c, []) for c in with_nulls])
    return prepared.withColumns({c: F.coalesce(F.col(c), _literal(v, types[c])) for c, v in modes.items() if v is not None})


def drop_sparse_nulls(df: DataFrame, threshold_pct: float = DEFAULT_THRESHOLD_PCT, nan_as_null: bool = True) -> DataFrame:
    """drop rows null in any column whose null share (of the input) is below the threshold."""
    prepared = nan_to_null(df) if nan_as_null else df
    row = prepared.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in prepared.columns]).collect()[0]
    n = row["_n"]
    sparse = [c for c in prepared.columns if row[c] > 0 and n and row[c] / n * 100.0 < threshold_pct]
    if not sparse:
        return prepared
    return prepared.filter(_alive(sparse))
