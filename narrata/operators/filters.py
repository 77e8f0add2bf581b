"""Row and column filters (F1-F9), with pandas' NULL semantics made explicit.

Predicates are native Column expressions so they push into the parquet scan
where they reference scan columns. Class-frequency filters aggregate first
(one small row per class, written once so that its size is known) and
semi/anti-join back: a broadcast below the session's threshold, a join with
skew splitting beyond it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from narrata.operators import profile as P
from narrata.operators.labels import class_map


def dropna_subset(df: DataFrame, cols) -> DataFrame:
    return df.na.drop(how="any", subset=list(cols))


def dropna_any(df: DataFrame) -> DataFrame:
    return df.na.drop(how="any")


def dropna_columns(df: DataFrame) -> DataFrame:
    """Drop every column holding at least one NULL (one aggregate pass decides)."""
    counts = P.null_counts(df).filter(F.col("null_count") == 0).select("column_name")
    keep = {r["column_name"] for r in counts.collect()}  # one row per column: schema-sized
    return df.select(*[c for c in df.columns if c in keep])


def exclude_label(df: DataFrame, col: str, value) -> DataFrame:
    """``col != value`` that keeps NULL rows, as pandas does."""
    return df.filter(~F.col(col).eqNullSafe(F.lit(value)))


def not_in_values(df: DataFrame, col: str, values) -> DataFrame:
    """``~isin(values)`` that keeps NULL rows."""
    return df.filter(~F.coalesce(F.col(col).isin(list(values)), F.lit(False)))


def in_values(df: DataFrame, col: str, values) -> DataFrame:
    return df.filter(F.col(col).isin(list(values)))


def length_cap(df: DataFrame, col: str, max_value: int) -> DataFrame:
    return df.filter(F.col(col) <= max_value)


def class_sizes(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("_class_n"))


def keep_frequent(df: DataFrame, col: str, more_than: int) -> DataFrame:
    """Keep rows whose class occurs more than ``more_than`` times (NULL class dropped)."""
    frequent = class_map(class_sizes(df, col).filter(F.col("_class_n") > more_than).select(col))
    return df.join(frequent, col, "left_semi")


def oversized_classes(df: DataFrame, col: str, max_size: int) -> DataFrame:
    """Classes with more than ``max_size`` rows."""
    return class_sizes(df, col).filter(F.col("_class_n") > max_size).select(col)


def outside_oversized(df: DataFrame, col: str, max_size: int) -> DataFrame:
    """Rows not in an oversized class; NULL-class rows are kept (pandas ``~isin``)."""
    return df.join(class_map(oversized_classes(df, col, max_size)), col, "left_anti")
