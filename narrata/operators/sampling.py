"""Reproducible sampling, splits and folds (L6-L11) by hash order.

Every random pick is replaced by an order on ``h = md5(seed || ':' || id)``,
which is independent of partitioning, so the same rows are chosen however
the data is split across executors (and an SQL engine picks the same rows).

Exact per-class rank at scale (``exact_rank``): a class may hold a third of
all rows, so a window partitioned by class alone would put that third in one
task. Rows are instead bucketed by the first ``bucket_chars`` hex digits of
``h`` (16^4 = 65,536 buckets per class by default). A small count table per
(class, bucket) gives each bucket its offset (prefix sum in hash order) and
the rank is ``offset + row_number()`` inside (class, bucket). The class is
made a key that is never null, so the join with the count table and the
window share one exchange of the rows. For "rank <= n" picks, buckets starting at or past
n are dropped before the window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from narrata.sources import io as IO

TWO_POW_52 = 4503599627370496.0


def hash_key(seed, id_col) -> Column:
    idc = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(F.lit(str(seed)), F.lit(":"), idc.cast("string")))


def unit_uniform(hex_col, start: int = 1) -> Column:
    """[0, 1) from 13 hex digits (52 bits) of an md5 string starting at ``start`` (1-based)."""
    return F.conv(F.substring(hex_col, start, 13), 16, 10).cast("double") / F.lit(TWO_POW_52)


def _class_key(by: str) -> Column:
    """The class as a key that is never null, so that join and window share one partitioning."""
    return F.coalesce(F.concat(F.lit("v"), F.col(by).cast("string")), F.lit("n"))


def _prefix(df: DataFrame) -> str:
    """Underscores that no column of the table begins with, for the names of work columns."""
    return "_" * (1 + max((len(c) - len(c.lstrip("_")) for c in df.columns), default=0))


def _new_column(df: DataFrame, name: str) -> str:
    if name in df.columns:
        raise ValueError(f"the table has a column {name!r} already")
    return name


def _bucket_offsets(d: DataFrame, p: str) -> DataFrame:
    counts = d.groupBy(f"{p}k", f"{p}b").agg(F.count("*").alias(f"{p}bn"))
    before = Window.partitionBy(f"{p}k").orderBy(f"{p}b").rowsBetween(Window.unboundedPreceding, -1)
    return (counts
            .withColumn(f"{p}off", F.coalesce(F.sum(f"{p}bn").over(before), F.lit(0)))
            .withColumn(f"{p}class_n", F.sum(f"{p}bn").over(Window.partitionBy(f"{p}k"))))


def _with_offsets(df: DataFrame, by: str, id_col: str, seed, bucket_chars: int) -> tuple[DataFrame, str]:
    """Rows with their class key, hash, bucket, and the bucket's offset and class size; and the work columns' prefix.

    The offsets (at most classes x 65,536 rows) are written once, so the
    planner knows their size; rows are exchanged by (class, bucket) at most
    once, for the join or for the rank window after it.
    """
    p = _prefix(df)
    d = (df.withColumn(f"{p}k", _class_key(by)).withColumn(f"{p}h", hash_key(seed, id_col))
         .withColumn(f"{p}b", F.substring(f"{p}h", 1, bucket_chars)))
    offsets = IO.materialize(_bucket_offsets(d, p), df.sparkSession, "bucket-offsets")
    return d.join(offsets, [f"{p}k", f"{p}b"]), p


def _rank_in_bucket(j: DataFrame, p: str) -> DataFrame:
    w = Window.partitionBy(f"{p}k", f"{p}b").orderBy(f"{p}h")
    return j.withColumn(f"{p}rank", F.col(f"{p}off") + F.row_number().over(w))


def exact_rank(df: DataFrame, by: str, id_col: str, seed=42, bucket_chars: int = 4,
               rank_col: str = "rank") -> DataFrame:
    """All rows and columns, and the 1-based rank of each row within its class in hash order (see module doc)."""
    _new_column(df, rank_col)
    j, p = _with_offsets(df, by, id_col, seed, bucket_chars)
    return _rank_in_bucket(j, p).select(*df.columns, F.col(f"{p}rank").alias(rank_col))


def rank_at_most(df: DataFrame, by: str, id_col: str, limit: Column, seed=42,
                 bucket_chars: int = 4) -> DataFrame:
    """Rows whose hash-order rank within the class is <= ``limit`` (a Column)."""
    j, p = _with_offsets(df, by, id_col, seed, bucket_chars)
    j = _rank_in_bucket(j.filter(F.col(f"{p}off") < limit), p)
    return j.filter(F.col(f"{p}rank") <= limit).select(*df.columns)


def quota_sample(df: DataFrame, col: str, quotas: dict, id_col: str, seed=42) -> DataFrame:
    """n rows of each listed class (all rows if it has fewer) plus every other row.

    Rows of unlisted classes, NULL included, are kept whole.
    """
    listed = list(quotas)
    qmap = F.create_map(*[x for k, v in quotas.items() for x in (F.lit(k), F.lit(int(v)))])
    chosen = rank_at_most(df.filter(F.col(col).isin(listed)), col, id_col, qmap[F.col(col)], seed)
    rest = df.filter(~F.coalesce(F.col(col).isin(listed), F.lit(False)))
    return chosen.unionByName(rest)


def cap_per_class(df: DataFrame, col: str, n: int, id_col: str, seed=42) -> DataFrame:
    """At most n rows per class in one pass (classes under n are kept whole)."""
    return rank_at_most(df, col, id_col, F.lit(int(n)), seed)


def stratified_split(df: DataFrame, col: str, id_col: str, train_frac: float = 0.8,
                     seed=42, split_col: str = "split") -> DataFrame:
    """``train`` for hash-rank <= floor(train_frac * class size), else ``test``."""
    _new_column(df, split_col)
    j, p = _with_offsets(df, col, id_col, seed, 4)
    thr = F.floor(F.lit(float(train_frac)) * F.col(f"{p}class_n"))
    part = F.when(F.col(f"{p}rank") <= thr, F.lit("train")).otherwise(F.lit("test"))
    return _rank_in_bucket(j, p).select(*df.columns, part.alias(split_col))


def three_way_split(df: DataFrame, id_col: str, fracs=(0.6, 0.2, 0.2), seed=42,
                    split_col: str = "split") -> DataFrame:
    """Unstratified train/validation/test by a per-row hash threshold (no shuffle)."""
    _new_column(df, split_col)
    u = unit_uniform(hash_key(seed, id_col))
    a = float(fracs[0])
    b = float(fracs[0] + fracs[1])
    return df.withColumn(split_col, F.when(u < a, F.lit("train"))
                         .when(u < b, F.lit("validation")).otherwise(F.lit("test")))


def stratified_folds(df: DataFrame, col: str, id_col: str, k: int = 5, seed=42,
                     fold_col: str = "fold") -> DataFrame:
    """Fold number ``(rank - 1) mod k`` per class: class counts per fold differ by <= 1."""
    _new_column(df, fold_col)
    rank = _prefix(df) + "rank"
    r = exact_rank(df, col, id_col, seed, rank_col=rank)
    return r.select(*df.columns, F.pmod(F.col(rank) - 1, F.lit(k)).cast("int").alias(fold_col))


def balanced_resample(df: DataFrame, col: str, id_col: str, draws: DataFrame, draw_col: str,
                      seed=42) -> DataFrame:
    """Draws with replacement where every class has equal total weight.

    This is sampling by per-row weight ``1/count(class)``: each class carries
    mass 1/k, and inside a class every row is equally likely. Draw ``j``
    picks class ``floor(u1 * k)`` (classes in sorted order) and then the row
    of hash-rank ``1 + floor(u2 * count)``, with u1, u2 from
    ``md5(seed || ':draw:' || j)``. Draws and ranked rows meet in one
    equi-join on (class, rank).
    """
    rows = df.filter(F.col(col).isNotNull()).select(*dict.fromkeys([id_col, col]))
    ranked = exact_rank(rows, col, id_col, seed, rank_col="_rank")
    # class sizes from a separate map-side-combined count (one row per class),
    # not from the ranked frame, so the rank windows run once
    classes = rows.groupBy(col).agg(F.count("*").alias("_cnt"))
    # one row per class: the only rows of the unpartitioned window
    classes = classes.withColumn("_cidx", (F.row_number().over(Window.orderBy(col)) - 1).cast("long"))
    k = classes.agg(F.count("*")).scalar()
    hd = F.md5(F.concat(F.lit(str(seed)), F.lit(":draw:"), F.col(draw_col).cast("string")))
    d = draws.select(F.col(draw_col), hd.alias("_hd"))
    d = d.withColumn("_cidx", F.floor(unit_uniform("_hd", 1) * k).cast("long"))
    d = d.join(IO.materialize(classes, df.sparkSession, "class-map"), "_cidx").withColumn(
        "_rank", (F.lit(1) + F.floor(unit_uniform("_hd", 14) * F.col("_cnt"))).cast("long"))
    picked = d.select(draw_col, col, "_rank").join(
        ranked.select(col, "_rank", id_col), [col, "_rank"])
    return picked.select(draw_col, id_col, col)


#: Parts that all weight is cut into; a row with one part or more is heavy, so there are no more heavy rows than parts.
WEIGHT_PARTS = 1 << 16
WEIGHT_UNIT = 1e6


def weighted_draws(df: DataFrame, weight_col: str, id_col: str, draws: DataFrame, draw_col: str, seed=42) -> DataFrame:
    """Draws with replacement in which a row's chance is its weight: ``draw_col`` and the drawn ``id_col``.

    Weights count in millionths; null, negative and not-a-number weights are
    none, and a table without weight draws nothing. All weight lies on a line:
    first the heavy rows (one part in ``WEIGHT_PARTS`` or more), then buckets
    of the other rows by the hash of their id, each bucket's rows in the order
    of (hash, id). A draw is the place floor(u * total) on that line. It finds
    its heavy row or bucket through equal cells of the line (an equi-join of a
    bounded table), so a row with a third of the weight never gathers its
    draws in one task, and its row by one window over the bucket's rows and
    draws. Ids are taken to be distinct; a null id is drawn like others.
    """
    spark = df.sparkSession
    weight = F.col(weight_col).cast("double")
    units = F.when((weight > 0) & ~F.isnan(weight), F.floor(weight * F.lit(WEIGHT_UNIT) + F.lit(0.5))).otherwise(0).cast("long")
    rows = df.select(F.col(id_col).alias("id"), units.alias("units"), F.coalesce(hash_key(seed, id_col), F.lit("")).alias("h"))
    rows = IO.materialize(rows.filter("units > 0"), spark, "weighted-rows")
    total = rows.agg(F.sum(F.col("units").cast("decimal(38,0)"))).first()[0]
    d = F.md5(F.concat(F.lit(str(seed)), F.lit(":draw:"), F.col(draw_col).cast("string")))
    if not total:
        return draws.join(rows.select(F.col("id").alias(id_col)), F.lit(False)).select(draw_col, id_col)
    total = int(total)
    if total >= 1 << 62:
        raise ValueError("the weights' sum in millionths doesn't fit 62 bits")
    heavy = F.col("units") * F.lit(WEIGHT_PARTS).cast("decimal(20,0)") >= F.lit(total)
    bucket = F.substring("h", 1, 4)
    # the line: at most WEIGHT_PARTS heavy rows and 65,536 buckets, in one window
    stretches = rows.filter(heavy).select(F.lit(0).alias("kind"), F.col("h").alias("key"), "id", "units").unionByName(
        rows.filter(~heavy).groupBy(bucket.alias("key")).agg(F.sum("units").alias("units")).select(
            F.lit(1).alias("kind"), "key", F.lit(None).cast(dict(rows.dtypes)["id"]).alias("id"), "units"))
    line = Window.orderBy("kind", "key", "id").rowsBetween(Window.unboundedPreceding, 0)
    cell = -(-total // WEIGHT_PARTS)
    stretches = stretches.withColumn("hi", F.sum("units").over(line)).withColumn("lo", F.col("hi") - F.col("units"))
    cells = F.sequence(F.expr(f"lo DIV {cell}"), F.expr(f"(hi - 1) DIV {cell}"))
    stretches = IO.materialize(stretches.withColumn("cell", F.explode(cells)).drop("units"), spark, "weighted-line")
    place = F.least(F.floor(unit_uniform(d) * F.lit(float(total))).cast("long"), F.lit(total - 1))
    drawn = draws.select(F.col(draw_col).alias("draw"), place.alias("at")).withColumn("cell", F.expr(f"at DIV {cell}"))
    met = drawn.join(stretches, "cell").filter("at >= lo AND at < hi")
    met = IO.materialize(met.select("draw", "kind", "key", "id", (F.col("at") - F.col("lo")).alias("at")), spark, "weighted-draws")
    # light rows and the draws of their bucket on one line; a draw takes the last row that begins at or before it
    within = Window.partitionBy("key").orderBy("h", "id").rowsBetween(Window.unboundedPreceding, 0)
    light = rows.filter(~heavy).withColumn("key", bucket).withColumn("at", F.sum("units").over(within) - F.col("units"))
    none = F.lit(None)
    both = light.select("key", "at", F.struct("id").alias("row"), none.cast(dict(met.dtypes)["draw"]).alias("draw"),
                        F.lit(0).alias("is_draw")).unionByName(
        met.filter("kind = 1").select("key", "at", none.cast(f"struct<id:{dict(rows.dtypes)['id']}>").alias("row"), "draw",
                                      F.lit(1).alias("is_draw")))
    before = Window.partitionBy("key").orderBy("at", "is_draw").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("row", F.last("row", ignorenulls=True).over(before)).filter("is_draw = 1")
    return met.filter("kind = 0").select(F.col("draw").alias(draw_col), F.col("id").alias(id_col)).unionByName(
        found.select(F.col("draw").alias(draw_col), F.col("row.id").alias(id_col)))
