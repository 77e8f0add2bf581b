"""Label encoding, decoding and class weights (J1-J3, L1-L5).

The label table holds one row per distinct class (a handful to a few
hundred); it is built from an aggregate, so only class names, never data
rows, reach the single ordered window that numbers them. Class tables are
written once before they are joined (``class_map``): the planner then knows
their size, broadcasts a small one without moving a data row, and joins one
beyond the broadcast threshold by exchanges that AQE splits at hot classes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from narrata.functions.numeric import round6
from narrata.sources import io as IO


def class_map(table: DataFrame) -> DataFrame:
    """A class-sized table ready to be joined to data rows."""
    return IO.materialize(table, table.sparkSession, "class-map")


def label_table(df: DataFrame, col: str, code_col: str = "code") -> DataFrame:
    """Sorted distinct non-NULL labels numbered 0..k-1 (LabelEncoder order)."""
    distinct = df.select(col).filter(F.col(col).isNotNull()).distinct()
    return distinct.withColumn(code_col, (F.row_number().over(Window.orderBy(col)) - 1).cast("int"))


def encode_labels(df: DataFrame, col: str, table: DataFrame, code_col: str = "code") -> DataFrame:
    """Attach the code of each row's label (rows with unknown/NULL labels drop)."""
    return df.join(class_map(table.select(col, code_col)), col)


def decode_labels(df: DataFrame, code_col: str, table: DataFrame, label_col: str,
                  out_col: str) -> DataFrame:
    t = class_map(table.select(F.col(code_col), F.col(label_col).alias(out_col)))
    return df.join(t, code_col, "left")


def class_counts(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("count"))


def class_weights(df: DataFrame, col: str) -> DataFrame:
    """Per class: count, balanced weight ``n / (k * count)`` and inverse share ``n / count``."""
    counts = class_counts(df, col)
    n = counts.agg(F.sum("count")).scalar()
    k = counts.agg(F.count("*")).scalar()
    return counts.select(
        col, "count",
        round6(n / (k * F.col("count"))).alias("balanced_weight"),
        round6(n / F.col("count")).alias("inverse_share_weight"))


def sample_weights(df: DataFrame, col: str, weight_col: str = "weight") -> DataFrame:
    """Per-row weight ``1 / count(class)`` (rows with a NULL class get none)."""
    counts = class_map(class_counts(df, col))
    return df.join(counts, col, "left").withColumn(
        weight_col, round6(F.lit(1.0) / F.col("count"))).drop("count")
