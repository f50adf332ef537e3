"""Grouped aggregates used by the reports (AG-01 .. AG-10, JN-01, SO-01/02).

Every aggregate here is algebraic or has a bounded buffer, so Catalyst runs a
partial aggregate before the shuffle and a hot key costs one row per map task
in the exchange, not one row per input row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.episodes import proportion
from .selection import exact_quantiles

#: Types of columns with so few values that a histogram of them is small.
_COUNTED = ("tinyint", "smallint", "int")


def group_count(df: DataFrame, keys: list[str], name: str = "count") -> DataFrame:
    """AG-01."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def quartile_values(df: DataFrame, col: str, probs=(0.25, 0.5, 0.75),
                    err: float = 0.0, counted: bool | None = None) -> DataFrame:
    """AG-02: one-row frame with column ``q`` = array of quantiles.

    ``err == 0`` gives exact lower quantiles (the smallest value whose
    cumulative share reaches p; the same number ``approxQuantile(.., 0)``
    returns): of a counted column lazily from a value histogram, one row per
    distinct value, and of any other by distributed selection (a few jobs
    that run now). By default a column is counted if it is an int or smaller,
    as move counts are; say ``counted=False`` of an int column with many
    values. ``err > 0`` uses the mergeable ``percentile_approx`` sketch with
    accuracy ``1/err``.
    """
    probs = list(probs)
    if err > 0:
        arr = F.array(*[F.lit(float(p)) for p in probs])
        return df.agg(F.percentile_approx(col, arr, int(round(1 / err))).alias("q"))
    kind = dict(df.dtypes)[col]
    if not (kind in _COUNTED if counted is None else counted):
        found = exact_quantiles(df, col, probs)
        return df.sparkSession.createDataFrame([(None if None in found else found,)], f"q array<{kind}>")
    hist = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_c"))
    cum = hist.select(
        col,
        F.sum("_c").over(Window.orderBy(col).rowsBetween(Window.unboundedPreceding, 0)).alias("_cum"),
        F.sum("_c").over(Window.partitionBy()).alias("_n"),
    )
    return cum.agg(F.array(*[
        F.min(F.when(F.col("_cum") >= F.lit(float(p)) * F.col("_n"), F.col(col)))
        for p in probs
    ]).alias("q"))


def quartile_thresholds(df: DataFrame, col: str, err: float = 0.0) -> list[Column]:
    """AG-02 as lazy scalar subqueries (no driver round trip, no join)."""
    q = quartile_values(df, col, err=err).scalar()
    return [F.get(q, i) for i in range(3)]


def quartiles(df: DataFrame, col: str, err: float = 0.0) -> list[float]:
    """AG-02 as Python numbers (an action), like ``approxQuantile``."""
    row = quartile_values(df, col, err=err).first()
    return list(row["q"]) if row and row["q"] is not None else []


def win_rate(df: DataFrame, keys: list[str], result_col: str = "result") -> DataFrame:
    """AG-03/AG-04 (+JN-01 semantics): games, wins and their ratio per key in
    one pass. The reference joins a total table to a wins table; this is the
    same numbers without the join, except that a null key keeps its wins."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_games"),
        F.count_if(F.col(result_col) == "Win").alias("wins"),
    ).withColumn("win_rate", F.try_divide(F.col("wins"), F.col("total_games")))


def win_rate_join(totals: DataFrame, wins: DataFrame, keys: list[str]) -> DataFrame:
    """JN-01: the reference's form: left join of pre-aggregated totals and
    wins, missing wins -> 0 (a null key never matches). Both sides are small
    aggregates; AQE turns the join into a broadcast at run time when a side's
    measured size allows it."""
    return (totals.join(wins, keys, "left").fillna(0, subset=["wins"])
                  .withColumn("win_rate", F.try_divide(F.col("wins"), F.col("total_games"))))


def unique_values(col: str) -> Column:
    """AG-05: sorted distinct values (collect_set order is undefined)."""
    return F.sort_array(F.collect_set(col))


def strategy_profile(df: DataFrame, keys: list[str], denom: int | str = 500,
                     moves_col: str = "n_moves") -> DataFrame:
    """AG-06: count, percentage and the set of move counts per group.

    ``denom``: a constant (the reference's chunk size 500), ``"total"`` (all
    rows, a scalar subquery) or ``"group"`` (share within the group of the
    leading keys, e.g. of its chunk: a window over the aggregated rows,
    whose partitions hold one row per level)."""
    out = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("count"),
        unique_values(moves_col).alias("unique_moves"),
    )
    if denom == "total":
        d = df.agg(F.count(F.lit(1))).scalar()
    elif denom == "group":
        d = F.sum("count").over(Window.partitionBy(*keys[:-1]))
    elif isinstance(denom, (int, float)):
        d = F.lit(denom)
    else:
        raise ValueError("denom must be a number, 'total' or 'group'")
    return out.select(*keys, "count", proportion(F.col("count"), d).alias("proportion"),
                      "unique_moves")


def hit_stats(df: DataFrame, keys: list[str], col: str = "n_moves") -> DataFrame:
    """AG-07/AG-08: sample variance, exact interpolated quartiles and the set
    of values. ``percentile`` keeps one counter per distinct value, bounded
    here because move counts take at most n_hands values."""
    return df.groupBy(*keys).agg(
        F.var_samp(col).alias("hits_variance"),
        F.percentile(col, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("hits_quartiles"),
        unique_values(col).alias("unique_hits"),
    )


def pivot_report(df: DataFrame, index: list[str], column: str, value: str,
                 values: list, names: list[str] | None = None) -> DataFrame:
    """AG-10: keys x levels. The level list is fixed, so no extra job runs to
    discover it and the output schema is stable."""
    out = df.groupBy(*index).pivot(column, list(values)).agg(F.first(value))
    if names:
        out = out.withColumnsRenamed({str(v): n for v, n in zip(values, names)})
    return out


def top_n(df: DataFrame, n: int, keys: list[Column | str]) -> DataFrame:
    """SO-02: top n by keys (TakeOrderedAndProject: each task keeps n rows).
    Give keys that form a total order for a deterministic result."""
    return df.orderBy(*keys).limit(n)
