"""K-d tree sharding: weighted median splits along the widest metadata dimension (operator 8).

The root holds all rows. A node of L leaves is split along the dimension in
which its rows spread widest (relative to the whole table) so that its halves
hold bytes as their numbers of leaves, until every leaf holds the target
bytes. Medians are found by histograms: all nodes of a level at once, each
round narrows every node's search to one of 1024 bins, and only the bins'
sums reach the driver. Rows that tie in the dimension are split by a hash of
id and text, and repeated rows by a hash of their row number, so a value or a
row that makes up a third of all rows is cut like any other.

Only built-in functions run on the executors; the tree (one split less than
shards) becomes a CASE expression.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from narrata.sources import io as IO

SHARDS = 40
ROW_BYTES = 16
BINS = 1024
#: Groups of a shard in which slots are counted (a shard's rows are never in one task).
SLOT_GROUPS = 4096
_HASH_RANGE = 1 << 62


@dataclass
class Node:
    """A node of the tree; ``first`` and ``leaves`` say which shards it becomes."""

    name: int
    first: int
    leaves: int
    dim: str | None = None
    value: int = 0
    tie: int = 0
    copy: int = 0
    left: Node | None = None
    right: Node | None = None


@dataclass
class _Search:
    """The place of a split: ids of ``dim`` from ``low`` on, then of the hash among rows of ``value``, then of the
    copies' hash among rows of ``value`` and ``tie``."""

    node: Node
    dim: str
    low: int
    high: int
    target: float
    before: int = 0
    value: int | None = None
    tie: int | None = None
    done: bool = False

    @property
    def step(self) -> int:
        return max(1, -(-(self.high - self.low + 1) // BINS))

    def settle(self, at: int) -> None:
        """Rows before ``at`` in the order (value, tie, copy) go left."""
        n = self.node
        n.dim, self.done = self.dim, True
        found = [x for x in (self.value, self.tie, at) if x is not None]
        n.value, n.tie, n.copy = (*found, 0, 0)[:3]

    def narrow(self, bins: list[tuple[int, int, int]]) -> None:
        """Go to the bin that holds the target; bins are (number, bytes, rows) in order."""
        for number, size, rows in bins:
            if self.before + size >= self.target or number == bins[-1][0]:
                low = self.low + number * self.step
                high = min(low + self.step - 1, self.high)
                if rows == 1 or low == high and self.tie is not None:  # to the side that is nearer to the target
                    self.settle(high + 1 if self.target - self.before >= size / 2 else low)
                elif low == high and self.value is None:  # ties: on to the hash
                    self.value, self.low, self.high = low, 0, _HASH_RANGE
                elif low == high:  # the same id and text again and again: on to the copies
                    self.tie, self.low, self.high = low, 0, _HASH_RANGE
                else:
                    self.low, self.high = low, high
                return
            self.before += size


def _node_column(node: Node, dims: dict[str, Column], tie: Column, copy: Column) -> Column:
    if node.dim is None:
        return F.lit(node.name)
    v = dims[node.dim]
    goes_left = (v < node.value) | ((v == node.value) & ((tie < node.tie) | ((tie == node.tie) & (copy < node.copy))))
    return F.when(goes_left, _node_column(node.left, dims, tie, copy)).otherwise(_node_column(node.right, dims, tie, copy))


def _metadata(docs: DataFrame, dims: list[str]) -> dict[str, Column]:
    """Dimensions as whole numbers that keep their order: whole numbers as they are (64-bit ones quartered, so that
    differences fit), other numbers and times as 2**52 steps between their least and largest finite value (infinite
    and not-a-number values at the ends), texts by checksum, which has no order to keep. Nulls come first or are 0."""
    types = dict(docs.dtypes)
    wide = [c for c in dims if types[c] in ("float", "double", "date") or types[c].startswith(("decimal", "timestamp"))]

    def number(c: str) -> Column:
        x = F.col(c)
        return (F.unix_micros(x.cast("timestamp")) if types[c].startswith(("date", "timestamp")) else x).cast("double")
    finite = {c: F.when(~F.isnan(number(c)) & (F.abs(number(c)) < float("inf")), number(c)) for c in wide}
    ends = docs.agg(*(f(finite[c]).alias(f"{k}_{i}") for i, c in enumerate(wide) for k, f in (("lo", F.min), ("hi", F.max)))
                    ).first() if wide else None
    out = {}
    for c in dims:
        if types[c] == "string":
            out[c] = F.coalesce(F.crc32(F.col(c).cast("binary")), F.lit(-1)).cast("long")
        elif c in wide:
            lo, hi = (ends[f"{k}_{wide.index(c)}"] for k in ("lo", "hi"))
            half = (hi / 2 - lo / 2) if lo is not None and hi > lo else 1.0
            step = (number(c) / 2 - F.lit((lo or 0.0) / 2)) / F.lit(half)
            step = F.when(F.isnan(step), 1.0).otherwise(F.greatest(F.least(step, F.lit(1.0)), F.lit(0.0)))
            out[c] = F.when(number(c).isNull(), F.lit(-1)).otherwise(F.floor(step * F.lit(float(1 << 52)))).cast("long")
        elif types[c] == "bigint":
            out[c] = F.coalesce(F.shiftright(c, 2), F.lit(0)).cast("long")
        else:
            out[c] = F.coalesce(F.col(c).cast("long"), F.lit(0)).cast("long")
    return out


def _hash(*cols) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*cols), 2)


def thin_table(docs: DataFrame, dims: list[str]) -> DataFrame:
    """What sharding needs of each row, without the text; ``copy`` tells rows of one id and text apart (0: a single row)."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + ROW_BYTES
    meta = _metadata(docs, dims)
    rows = docs.select("doc_id", size.alias("size"),
                       F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
                       _hash("doc_id", "text").alias("tie"), F.monotonically_increasing_id().alias("nth"),
                       *(c.alias(f"dim_{i}") for i, c in enumerate(meta.values())))
    rows = IO.materialize(rows, docs.sparkSession, f"kd-{uuid.uuid4().hex}/numbered")  # row numbers stay as written
    again = IO.materialize(rows.groupBy("tie").agg(F.count("*").alias("n")).filter("n > 1"),
                           docs.sparkSession, f"kd-{uuid.uuid4().hex}/repeated")
    return rows.join(again, "tie", "left").withColumn(
        "copy", F.when(F.col("n").isNotNull(), _hash("tie", "nth")).otherwise(F.lit(0)).cast("long")).drop("n", "nth")


def grow_tree(rows: DataFrame, n_dims: int, shards: int, weight: Column) -> Node:
    """The tree of a thin table; ``weight`` is what the shards hold alike."""
    names = [f"dim_{i}" for i in range(n_dims)]
    dims = {c: F.col(c) for c in names}
    root = Node(0, 0, shards)
    active, made, widths = [root] if shards > 1 else [], 1, {}
    while active:
        placed = rows.select(_node_column(root, dims, F.col("tie"), F.col("copy")).alias("node"), *names, "tie", "copy",
                             weight.alias("weight"))
        wanted = placed.filter(F.col("node").isin([n.name for n in active]))
        spread = {r.node: r for r in wanted.groupBy("node").agg(
            F.sum("weight").alias("weight"), *(f(c).alias(f"{k}_{c}") for c in names for k, f in
                                               (("lo", F.min), ("hi", F.max)))).collect()}
        searches = []
        for node in active:
            r = spread.get(node.name)
            if r is None:  # no rows: any split will do
                node.dim = names[0]
                continue
            span = {c: r[f"hi_{c}"] - r[f"lo_{c}"] for c in names}
            widths = widths or {c: max(1, s) for c, s in span.items()}
            dim = max(names, key=lambda c: span[c] / widths[c])
            searches.append(_Search(node, dim, r[f"lo_{dim}"], r[f"hi_{dim}"],
                                    r["weight"] * (node.leaves // 2) / node.leaves))
        while todo := [s for s in searches if not s.done]:
            _round(rows.sparkSession, wanted, todo)
        below = []
        for node in active:
            left = node.leaves // 2
            node.left, node.right = Node(made, node.first, left), Node(made + 1, node.first + left, node.leaves - left)
            made += 2
            below += [n for n in (node.left, node.right) if n.leaves > 1]
        active = below
    return root


def _round(spark: SparkSession, wanted: DataFrame, todo: list[_Search]) -> None:
    """One histogram for all searches of a level: at most ``BINS`` sums for each reach the driver."""
    params = spark.createDataFrame(
        [(s.node.name, s.dim, s.low, s.high, s.step, s.value, s.tie) for s in todo],
        "node int, dim string, low long, high long, step long, value long, at_tie long")
    at = F.coalesce(*(F.when(F.col("dim") == c, F.col(c)) for c in sorted({s.dim for s in todo})))
    rows = wanted.join(F.broadcast(params), "node").withColumn("at", at)  # a row for each node of the level
    key = (F.when(F.col("value").isNull(), F.col("at")).when(F.col("at_tie").isNull(), F.col("tie"))
           .otherwise(F.col("copy")))
    found = (rows.filter(F.col("value").isNull() | (F.col("at") == F.col("value")))
             .filter(F.col("at_tie").isNull() | (F.col("tie") == F.col("at_tie")))
             .withColumn("key", key).filter(F.col("key").between(F.col("low"), F.col("high")))
             .withColumn("bin", F.expr("(key - low) div step"))
             .groupBy("node", "bin").agg(F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("rows")))
    bins: dict[int, list[tuple[int, int, int]]] = {}
    for r in found.collect():
        bins.setdefault(r.node, []).append((r.bin, r["weight"], r["rows"]))
    for s in todo:
        s.narrow(sorted(bins[s.node.name]))


def _leaves(node: Node) -> dict[int, int]:
    return {node.name: node.first} if node.dim is None else _leaves(node.left) | _leaves(node.right)


def shard_column(root: Node, dims: dict[str, Column], tie: Column, copy: Column) -> Column:
    """The shard of a row as an expression over its dimensions and hash."""
    shards = _leaves(root)
    if root.dim is None:
        return F.lit(0)
    names = F.create_map(*(F.lit(x) for pair in shards.items() for x in pair))
    return F.element_at(names, _node_column(root, dims, tie, copy))


def kd_shards(docs: DataFrame, shards: int = SHARDS, dims: tuple[str, ...] = ("doc_id", "source", "lang"),
              law: str = "bytes") -> DataFrame:
    """Shard and slot of every document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``docs`` needs ``doc_id``, ``text`` and the columns ``dims``; others are
    left out. ``law`` is ``bytes`` (shards of near-equal size; a size is the
    text's UTF-8 bytes plus 16, a null text's 16). Slots count a shard's rows
    from 0 without gaps. Nulls in a dimension come first (or count as 0);
    rows with the same id and text are cut by a hash of their row number, so a
    repeated row may lie in several shards; null and repeated ids are rows like
    others; an empty table gives no rows. Sizes aren't a
    dimension by default: a cut along them would leave leaves of a few huge
    texts, which no cut can make alike.
    """
    if law != "bytes":
        raise ValueError("k-d leaves hold equal bytes")
    spark = docs.sparkSession
    run = f"kd-{uuid.uuid4().hex}"
    rows = IO.materialize(thin_table(docs, list(dims)), spark, f"{run}/rows")
    names = {f"dim_{i}": F.col(f"dim_{i}") for i in range(len(dims))}
    root = grow_tree(rows, len(dims), shards, F.col("size"))
    group = F.pmod(F.col("tie").bitwiseXOR(F.col("copy")), F.lit(SLOT_GROUPS)).cast("int")
    placed = rows.select("doc_id", "size", "text_crc32", "tie", "copy", group.alias("grp"),
                         shard_column(root, names, F.col("tie"), F.col("copy")).alias("shard"))
    counts = placed.groupBy("shard", "grp").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("grp")  # at most SLOT_GROUPS rows a shard
    bases = IO.materialize(counts.select("shard", "grp", (F.sum("n").over(before) - F.col("n")).alias("base")),
                           spark, f"{run}/bases")
    nth = F.row_number().over(Window.partitionBy("shard", "grp").orderBy("tie", "doc_id", "text_crc32", "size", "copy"))
    return (placed.withColumn("nth", nth).join(bases, ["shard", "grp"])
            .select("doc_id", "size", "text_crc32", F.lit(law).alias("law"), "shard",
                    (F.col("base") + F.col("nth") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard")))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS,
                 dims: tuple[str, ...] = ("doc_id", "source", "lang")) -> None:
    """Write the documents themselves, a folder for each shard, several tasks and files a shard.

    The folders' ``shard`` takes the place of a column of that name.
    """
    rows = IO.materialize(thin_table(docs, list(dims)), docs.sparkSession, f"kd-{uuid.uuid4().hex}/rows")
    root = grow_tree(rows, len(dims), shards, F.col("size"))
    names = {f"dim_{i}": c for i, c in enumerate(_metadata(docs, list(dims)).values())}
    # copies draw the hash anew here: any of them may go to a copy's place
    tie, copy = _hash("doc_id", "text"), _hash(F.monotonically_increasing_id())
    own = {c: f"own_{i}" for i, c in enumerate(docs.columns)}
    rows = docs.select(*(F.col(c).alias(k) for c, k in own.items()), *(c.alias(k) for k, c in names.items()),
                       tie.alias("tie"), copy.alias("copy"))
    rows = rows.withColumn("shard", shard_column(root, {k: F.col(k) for k in names}, F.col("tie"), F.col("copy"))).withColumn(
        "spread", F.pmod(F.col("tie").bitwiseXOR(F.col("copy")), F.lit(16))).repartition("shard", "spread")
    kept = [F.col(k).alias(c) for c, k in own.items() if c != "shard"]
    rows.select(*kept, "shard").write.mode("overwrite").partitionBy("shard").parquet(path)


def op8_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` in 40 shards of near-equal bytes."""
    return kd_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"))
