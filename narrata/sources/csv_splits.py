"""Multi-line CSV files read by many tasks (S1).

Spark's reader takes a multi-line CSV file whole, in one task, because a line
break inside quotes can't be told from the end of a record without all the
quotes before it. Only their number modulo two matters, so files are read as
lines, in splits; the quotes are counted per split, and a prefix sum over the
splits (a row for each) says which lines begin a record.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as TY

from narrata.sources import io as IO

LINES = ("file string, block long, seq long, value string, odd boolean, before int, start0 long, start1 long")


def _last_true(flags: np.ndarray, seq: np.ndarray, carried: int) -> np.ndarray:
    """For each line the ``seq`` of the last line up to it whose flag is set; ``carried`` (-1: none) before the first."""
    return np.maximum.accumulate(np.where(flags, seq, carried)) if len(seq) else seq


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of splits, in order, with the parity of the quotes before them in their split.

    ``start0`` and ``start1`` are the last lines up to this one that begin a
    record if the split begins outside of quotes, and inside of them.
    """
    at, n, parity, last = None, 0, 0, [-1, -1]
    for batch in batches:
        if not batch.num_rows:
            continue
        file, block = batch.column("file"), batch.column("block").to_numpy()
        value = batch.column("value")
        odd = (pc.count_substring(value, '"').to_numpy(zero_copy_only=False) & 1).astype(np.int8)
        codes = file.dictionary_encode().indices.to_numpy()
        cuts = np.flatnonzero((np.diff(block) != 0) | (np.diff(codes) != 0)) + 1
        seq, before = np.empty(len(block), np.int64), np.empty(len(block), np.int32)
        starts = np.empty((2, len(block)), np.int64)
        for a, b in zip([0, *cuts], [*cuts, len(block)], strict=True):
            key = (file[int(a)].as_py(), int(block[a]))
            if key != at:
                at, n, parity, last = key, 0, 0, [-1, -1]
            seq[a:b] = n + np.arange(b - a)
            sums = parity + np.cumsum(odd[a:b], dtype=np.int64)
            before[a:b] = (sums - odd[a:b]) & 1
            for p in (0, 1):
                starts[p, a:b] = _last_true(before[a:b] == p, seq[a:b], last[p])
                last[p] = int(starts[p, b - 1])
            n, parity = n + int(b - a), int(sums[-1] & 1)
        yield pa.RecordBatch.from_arrays(
            [file, batch.column("block"), pa.array(seq), value, pa.array(odd.astype(bool)), pa.array(before),
             *(pa.array(starts[p], mask=starts[p] < 0) for p in (0, 1))],
            names=["file", "block", "seq", "value", "odd", "before", "start0", "start1"])


def read_csv_splits(spark: SparkSession, path: str, schema: TY.StructType, header: bool = True) -> DataFrame:
    """Rows of CSV files whose quoted values may hold line breaks; a file is read by as many tasks as it has splits.

    Values that hold a comma, a quote or a line break are quoted and quotes in
    them doubled (RFC 4180, as ``write_stage`` writes them); lines end with
    ``\\n`` or ``\\r\\n``. The first record of each file is its header. Empty
    lines between records are left out, empty files have no rows, empty values
    are null (as in Spark's reader); a value that doesn't fit its type, or a
    quote left open at the end of a file, is an error. Only lines of records
    that have several are shuffled, by record.
    """
    lines = (spark.read.option("lineSep", "\n").text(path)
             .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"))
    # splits may be cut otherwise by a second scan, so the lines are written with their places
    lines = IO.materialize(lines.mapInArrow(_lines, LINES), spark, f"csv-{uuid.uuid4().hex}/lines")

    # a row for each split: whether it begins inside of quotes, and the record that is open there
    splits = lines.groupBy("file", "block").agg(
        F.sum(F.col("odd").cast("long")).alias("quotes"), F.max("start0").alias("last0"), F.max("start1").alias("last1"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.pmod(F.coalesce(F.sum("quotes").over(earlier), F.lit(0)), F.lit(2)).cast("int")
    splits = splits.withColumn("inside", inside)
    last = F.when(F.col("inside") == 0, F.col("last0")).otherwise(F.col("last1"))
    owner = F.when(last.isNotNull(), F.struct(F.col("block").alias("b"), last.alias("s")))
    splits = IO.materialize(
        splits.withColumn("owner", owner).withColumn("open", F.last("owner", ignorenulls=True).over(earlier))
        .select("file", "block", "inside", "quotes", "open"), spark, f"csv-{uuid.uuid4().hex}/splits")
    unclosed = splits.groupBy("file").agg(F.sum("quotes").alias("n")).filter("n % 2 = 1").select("file").first()
    if unclosed is not None:
        raise ValueError(f"a quote is left open in {unclosed.file}")

    placed = lines.join(splits.drop("quotes"), ["file", "block"])
    start = F.when(F.col("inside") == 0, F.col("start0")).otherwise(F.col("start1"))
    own = F.when(start.isNotNull(), F.struct(F.col("block").alias("b"), start.alias("s"))).otherwise(F.col("open"))
    alone = (F.col("before") == F.col("inside")) & ~F.col("odd")
    placed = placed.select("file", "block", "seq", "value", own.alias("own"), alone.alias("alone"))
    parts = F.array_sort(F.collect_list(F.struct("block", "seq", "value")))
    several = placed.filter(~F.col("alone")).groupBy("file", "own").agg(
        F.array_join(F.transform(parts, lambda x: x["value"]), "\n").alias("record"))
    records = placed.filter("alone").select("own", F.col("value").alias("record")).unionByName(several.select("own", "record"))
    if header:
        records = records.filter((F.col("own.b") > 0) | (F.col("own.s") > 0))
    record = F.regexp_replace("record", "\r$", "")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    options = {"mode": "FAILFAST", "quote": '"', "escape": '"', "multiLine": "true"}
    return (records.select(record.alias("record")).filter("record <> ''")
            .select(F.from_csv("record", ddl, options).alias("row")).select("row.*"))
