"""Sources and sinks (S1-S3): CSV stages with explicit schemas, parquet stages,
and the shared folder for written intermediate tables and models.

Everything written goes under the cluster's shared checkpoint folder
(``spark.checkpoint.dir``), never a machine-local temp folder, so any executor
(or a restarted driver) can read it back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as TY

from narrata.session import checkpoint_dir

COMPLAINT_SCHEMA = TY.StructType([
    TY.StructField("complaint_id", TY.LongType(), False),
    TY.StructField("narrative", TY.StringType(), True),
    TY.StructField("product", TY.StringType(), True),
    TY.StructField("company", TY.StringType(), True),
    TY.StructField("issue", TY.StringType(), True),
    TY.StructField("response", TY.StringType(), True),
])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder."""
    return "/".join([checkpoint_dir(spark).rstrip("/"), "narrata", name])


def read_complaints(spark: SparkSession, path: str, schema: TY.StructType = COMPLAINT_SCHEMA) -> DataFrame:
    """Header CSV with quoted multi-line narratives, read with an explicit schema."""
    return (spark.read.schema(schema)
            .option("header", True).option("multiLine", True)
            .option("quote", '"').option("escape", '"')
            .option("mode", "FAILFAST")
            .csv(path))


def write_stage(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Overwrite a stage as parquet (default) or header CSV (quotes doubled)."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    elif fmt == "parquet":
        w.parquet(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")


def materialize(df: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    """Write a DataFrame to a folder of its own in the shared folder and read it back.

    Cuts lineage, survives executor loss, keeps column pruning, and tells the
    planner the table's size: a small one is broadcast by the session's
    threshold, a large one is joined by exchanges that AQE can split.
    """
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    write_stage(df, path, "parquet")
    return spark.read.schema(df.schema).parquet(path)
