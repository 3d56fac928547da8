"""Pairwise Pearson correlation (A5) and long -> wide pivot.

The reference ran one job per ordered pair (22^2 = 484). Here one aggregate finds each column's
count, mean and variance, and a second one sums the centred products of the unordered pairs, over
the same scan and without generating rows: as many pairs per aggregate as whole-stage codegen takes,
the aggregates side by side in a union (column pruning gives each its own columns only).
Pairwise-complete: a pair with nulls on either side takes the moments of the rows where both are
present. corr = cov / sqrt(var_x * var_y), null when either side is constant or no row is complete.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripspark.schema import numeric_columns

# aggregate buffer fields of a pair with nulls: covar_pop (n, x avg, y avg, co-moment) + 2 x var_pop (n, avg, m2)
_FIELDS_WITH_NULLS = 10


def correlation_long(df: DataFrame, columns: list[str] | None = None, pairs_per_block: int | None = None) -> DataFrame:
    """feature1, feature2, corr_value for every ordered pair (diagonal included), also for an empty frame."""
    from tripspark.operators.profile import codegen_field_budget

    cols = columns or numeric_columns(df)
    budget = codegen_field_budget(df) - 2
    stats = {}
    per = max(1, budget // 7)  # count, mean, var_pop
    for k in range(0, len(cols), per):
        part = cols[k : k + per]
        row = df.agg(
            F.count(F.lit(1)).alias("n"),
            *[e for q, c in enumerate(part) for x in [F.col(c).cast("double")] for e in (F.count(x).alias(f"c{q}"), F.avg(x).alias(f"m{q}"), F.var_pop(x).alias(f"v{q}"))],
        ).first()  # one row
        stats |= {c: (row["n"], row[f"c{q}"], row[f"m{q}"], row[f"v{q}"]) for q, c in enumerate(part)}
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    full = [(i, j) for i, j in pairs if all(stats[cols[x]][0] == stats[cols[x]][1] for x in (i, j))]
    gaps = [p for p in pairs if p not in set(full)]
    size_full, size_gaps = pairs_per_block or budget, pairs_per_block or max(1, budget // _FIELDS_WITH_NULLS)
    blocks = [_full_block(df, cols, stats, full[k : k + size_full]) for k in range(0, len(full), size_full)]
    blocks += [_gaps_block(df, cols, gaps[k : k + size_gaps]) for k in range(0, len(gaps), size_gaps)]
    return _mirror(reduce(DataFrame.unionByName, blocks), cols)


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _number(value: float | None) -> str:
    return "CAST(NULL AS DOUBLE)" if value is None else f"CAST('{float(value)!r}' AS DOUBLE)"


def _pair_rows(totals: DataFrame, pairs: list[tuple[int, int]], moments) -> DataFrame:
    """The one row of totals -> a row per pair. As SQL text: building thousands of column objects costs more than the query."""
    entries = [f"struct({i} AS i, {j} AS j, {cov} AS cov, {vx} AS vx, {vy} AS vy)" for q, (i, j) in enumerate(pairs) for cov, vx, vy in [moments(q, i, j)]]
    return totals.selectExpr(f"inline(array({', '.join(entries)}))")


def _full_block(df: DataFrame, cols: list[str], stats: dict, pairs: list[tuple[int, int]]) -> DataFrame:
    """Pairs of columns without nulls: the sum of (x - mean x) * (y - mean y); the variances are known."""
    centred = [f"(CAST({_name(c)} AS DOUBLE) - {_number(stats[c][2])})" for c in cols]

    def moments(q: int, i: int, j: int) -> tuple[str, str, str]:
        n, _, _, vx = stats[cols[i]]
        cov = _number(vx) if i == j else f"try_divide(s{q}, {_number(n)})"
        return cov, _number(vx), _number(stats[cols[j]][3])

    totals = df.agg(*[F.expr(f"sum({centred[i]} * {centred[j]}) AS s{q}") for q, (i, j) in enumerate(pairs)])
    return _pair_rows(totals, pairs, moments)


def _gaps_block(df: DataFrame, cols: list[str], pairs: list[tuple[int, int]]) -> DataFrame:
    """Pairs with nulls: the moments over the rows where both sides are present."""
    aggs = []
    for q, (i, j) in enumerate(pairs):
        a, b = _name(cols[i]), _name(cols[j])
        x, y = (f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN CAST({side} AS DOUBLE) END" for side in (a, b))
        aggs += [F.expr(f"covar_pop({x}, {y}) AS c{q}"), F.expr(f"var_pop({x}) AS x{q}"), F.expr(f"var_pop({y}) AS y{q}")]
    return _pair_rows(df.agg(*aggs), pairs, lambda q, i, j: (f"c{q}", f"x{q}", f"y{q}"))


def _mirror(moments: DataFrame, cols: list[str]) -> DataFrame:
    corr = F.try_divide(F.col("cov"), F.nullif(F.sqrt(F.col("vx") * F.col("vy")), F.lit(0.0)))
    one = F.struct(F.col("i").alias("a"), F.col("j").alias("b"), corr.alias("c"))
    mirror = F.struct(F.col("j").alias("a"), F.col("i").alias("b"), corr.alias("c"))
    both_orders = moments.select(
        F.explode(F.when(F.col("i") == F.col("j"), F.array(one)).otherwise(F.array(one, mirror))).alias("e")
    )
    names = F.array(*[F.lit(c) for c in cols])
    return both_orders.select(
        F.element_at(names, F.col("e.a") + 1).alias("feature1"),
        F.element_at(names, F.col("e.b") + 1).alias("feature2"),
        F.col("e.c").alias("corr_value"),
    )


def pivot_wide(long_df: DataFrame, index: str, columns: str, values: str, column_values: list[str]) -> DataFrame:
    """Long -> wide: one row per ``index``, one column per listed value of ``columns``.

    The column values are passed explicitly, so Spark does not run a distinct job to find them.
    Each cell holds one value, so ``max`` picks it deterministically (``first`` is not).
    """
    return long_df.groupBy(index).pivot(columns, column_values).agg(F.max(values))


def correlation_wide(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    cols = columns or numeric_columns(df)
    return pivot_wide(correlation_long(df, cols), "feature1", "feature2", "corr_value", cols)
