"""Profiling and data-audit operators (P1-P17).

Every profile is one aggregation pass (partial aggregation map-side, a tiny
shuffle of partial results). Totals for shares come from a scalar subquery,
not a single-partition window, so a high-cardinality column never funnels
its groups into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from narrata.functions import text as T
from narrata.functions.numeric import round6
from narrata.operators.quantiles import quantile_values


def null_counts(df: DataFrame, cols=None) -> DataFrame:
    """``(column_name, null_count)`` for every column, in one pass."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], cols, "column_name", "null_count")


def row_count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count("*").alias("row_count")).select(
        F.lit(name).alias("stage"), "row_count")


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Frequency of each non-NULL value, most frequent first (ties by value)."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count("*").alias("count"))
            .orderBy(F.col("count").desc(), F.col(col)))


def value_shares(df: DataFrame, col: str) -> DataFrame:
    """value_counts plus ``share`` = count / non-NULL total (scalar subquery)."""
    vc = value_counts(df, col)
    total = vc.agg(F.sum("count")).scalar()
    return vc.select(col, "count", round6(F.col("count") / total).alias("share"))


def length_stats(df: DataFrame, col: str) -> DataFrame:
    return df.agg(round6(F.avg(col)).alias("mean"), F.max(col).alias("max"))


def describe(df: DataFrame, col: str) -> DataFrame:
    """count, mean, sample std, min, quartiles (linear interpolation), max.

    The quartiles are exact and searched with bounded state (see
    ``quantiles``), so the column may have any number of distinct values.
    """
    x = F.col(col)
    quartiles = dict(zip(("p25", "p50", "p75"), quantile_values(df, col, [0.25, 0.5, 0.75]), strict=True))
    return df.agg(
        F.count(x).alias("count"),
        round6(F.avg(x)).alias("mean"),
        round6(F.stddev_samp(x)).alias("std"),
        F.min(x).cast("double").alias("min"),
        *(round6(F.lit(v).cast("double")).alias(name) for name, v in quartiles.items()),
        F.max(x).cast("double").alias("max"))


def threshold_counts(df: DataFrame, col: str, threshold: int) -> DataFrame:
    """Rows strictly over and strictly under a threshold (equal counts in neither)."""
    x = F.col(col)
    return df.agg(F.count_if(x > threshold).alias("over"),
                  F.count_if(x < threshold).alias("under"))


# ---------------------------------------------------------------------------
# Word-count bins [0,100), [100,300), [300,600), [600,1000),
# [1000, inf) and their labels (the third label reads 301-600 but starts at 300).
LENGTH_EDGES = (0, 100, 300, 600, 1000)
LENGTH_LABELS = ("<100", "100-300", "301-600", "601-1000", ">1000")
# ---------------------------------------------------------------------------


def bin_index(c, edges=LENGTH_EDGES):
    """0-based index of the half-open bin [edges[i], edges[i+1]); last bin open."""
    x = F.col(c) if isinstance(c, str) else c
    expr = None
    for i in range(len(edges) - 1, -1, -1):
        cond = x >= edges[i]
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr


def bin_counts(df: DataFrame, col: str, edges=LENGTH_EDGES, labels=LENGTH_LABELS) -> DataFrame:
    """Frequency per labelled bin, empty bins kept with 0.

    One global aggregate of conditional counts (one per bin, partial
    aggregation map-side) expanded into one row per bin. No join: a join
    against the label table would let the optimizer infer a NOT NULL filter
    on the bin and push the bin expression down to the scan.
    """
    b = bin_index(col, edges)
    counts = df.select(b.alias("_bin")).agg(
        *[F.count_if(F.col("_bin") == i).alias(f"_c{i}") for i in range(len(labels))])
    rows = F.array(*[F.struct(F.lit(i).alias("bin_order"), F.lit(lab).alias("bin"),
                              F.col(f"_c{i}").cast("bigint").alias("frequency"))
                     for i, lab in enumerate(labels)])
    return counts.select(F.inline(rows))


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Equal-width histogram between min and max, last bin closed; empty bins kept.

    The bounds are one scalar aggregate. Where all values are equal the width
    is 0 and every row is in bin 0; without any value there are no bins.
    """
    spark = df.sparkSession
    vals = df.select(F.col(col).cast("double").alias("_x")).filter(F.col("_x").isNotNull())
    ends = vals.agg(F.struct(F.min("_x").alias("lo"), F.max("_x").alias("hi"))).scalar()
    lo, width = ends["lo"], (ends["hi"] - ends["lo"]) / F.lit(float(bins))
    place = F.coalesce(F.floor(F.try_divide(F.col("_x") - lo, width)), F.lit(0))
    counts = (vals.select(F.least(place, F.lit(bins - 1)).cast("int").alias("bin"))
              .groupBy("bin").agg(F.count("*").alias("count")))
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (grid.join(counts, "bin", "left")
            .select("bin",
                    round6(lo + F.col("bin") * width).alias("lower"),
                    round6(lo + (F.col("bin") + 1) * width).alias("upper"),
                    F.coalesce("count", F.lit(0)).cast("bigint").alias("count"))
            .filter(F.col("lower").isNotNull()))


def text_audit(df: DataFrame, col: str) -> DataFrame:
    """Rows holding characters outside letters/whitespace, and rows holding upper case."""
    x = F.col(col)
    return df.agg(
        F.count_if(x.rlike("[^a-zA-Z" + T.PY_WS_CLASS + "]")).alias("special_char_rows"),
        F.count_if(x.rlike("[A-Z]")).alias("uppercase_rows"))


def wordcount_audit(df: DataFrame, stored: str, text_col: str) -> DataFrame:
    """Recount words and compare with a stored count (NULL on either side mismatches)."""
    new = T.word_count(text_col)
    mismatch = ~F.col(stored).eqNullSafe(new) | F.col(stored).isNull()
    return df.agg(F.count_if(mismatch).alias("mismatches"),
                  round6(F.avg(stored)).alias("original_mean"),
                  round6(F.avg(new)).alias("new_mean"))


def first_rows(df: DataFrame, order_col: str, n: int) -> DataFrame:
    """First n rows by an explicit key (TakeOrderedAndProject, no global sort)."""
    return df.orderBy(order_col).limit(n)


def examples_per_class(df: DataFrame, class_col: str, order_col: str, n: int) -> DataFrame:
    """First n rows of each class by ``order_col``.

    ``row_number() <= n`` is planned as a WindowGroupLimit, which trims every
    class to n rows per partition before the shuffle, so a hot class never
    moves more than n rows per partition.
    """
    w = Window.partitionBy(class_col).orderBy(order_col)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct non-NULL values."""
    return df.select(col).filter(F.col(col).isNotNull()).distinct().orderBy(col)


def distinct_in_order(df: DataFrame, col: str, key: str) -> DataFrame:
    """Distinct non-NULL values in order of appearance, with the smallest key they appear with."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col)
            .agg(F.min(key).alias("first_key")).orderBy("first_key", col))


def validate(df: DataFrame, required, target: str | None = None) -> DataFrame:
    """Raise when a required column is missing or the target holds a NULL.

    The schema check is free (driver metadata); the NULL probe is a
    ``limit(1)`` job that stops at the first offending row.
    """
    absent = [c for c in required if c not in df.columns]
    if absent:
        raise ValueError(f"no such columns: {', '.join(absent)}")
    if target is not None and not df.filter(F.col(target).isNull()).limit(1).isEmpty():
        raise ValueError(f"column {target!r} holds nulls")
    return df.select(*required)
