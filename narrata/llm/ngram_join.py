"""N-gram Jaccard join: exact components of similar texts (operator 1).

A text is the set of hashes of its word shingles. Texts with one set form a
class, and only classes are compared:

1. every class signs the parts of its set (``shingle_parts``), so that two
   similar classes share a signature; signatures of one class only are dropped
   by a partial aggregate;
2. classes that share signatures, directly or by others, form a cluster;
3. the texts of a cluster meet in blocks of bounded size, where a signature
   tree (``signature_tree``) finds and checks the similar pairs. A cluster of
   one block is done. In larger ones, blocks link what they hold, two texts of
   each component found carry links between blocks, and then only texts that
   are outside their cluster's largest component still have to meet the
   cluster's other blocks.

No step holds a key's rows in one task or lists the pairs of a group: a
signature of very many classes only yields its least class by aggregation,
and copies never meet.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from narrata.llm.batches import map_texts, row_chunks, text_buffer
from narrata.llm.components import components
from narrata.llm.shingle_parts import signatures
from narrata.llm.signature_tree import SignatureTree
from narrata.llm.words import LOWER, WHITE_SPACE, mix64, shingle_hashes, span_hashes, split_words
from narrata.sources import io as IO

SHINGLE = 4
SIMILAR = (85, 100)
#: An element in this share of all texts is frequent: it doesn't make a part strong. (Any set of frequent
#: elements gives the same links; the bound keeps the broadcast set below 2 MB.)
FREQUENT_SHARE = 0.001
MAX_FREQUENT = 200_000
#: A block holds so many elements or so many classes on average, whichever is more.
BLOCK_ELEMENTS = 16_000
BLOCK_CLASSES = 64
#: Units (blocks, then groups of them) whose largest components meet at once; blocks joined into one where all meet.
CARRIED_UNITS = 64
MEETING_BLOCKS = 4
#: Rows of a few longs (some 10 MB) that are broadcast to rows with texts; a larger table is joined by an exchange.
BROADCAST_ROWS = 250_000
#: Bits of a broadcast bitmap (16 MB at most; where rows outgrow it, more rows pass on to the exact join).
MAX_BITS = 1 << 27


# --- sets and their ids -------------------------------------------------------

def shingle_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted sets of all texts one after another, and their sizes."""
    raw, offsets = text_buffer(texts)
    starts, ends, rows = split_words(raw, offsets, WHITE_SPACE)
    hashes, many = shingle_hashes(span_hashes(LOWER[raw], starts, ends), np.bincount(rows, minlength=len(offsets) - 1), k)
    at = np.concatenate([[0], np.cumsum(many)]).tolist()
    sets = [np.unique(hashes[a:b]) for a, b in zip(at, at[1:])]
    return np.concatenate([np.zeros(0, np.uint64), *sets]), np.array([len(s) for s in sets], np.int64)


def set_ids(elements: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit id of each set: the scrambled sum of its scrambled elements."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(elements ^ np.uint64(0x5851F42D4C957F2D)))])
    end = np.cumsum(sizes)
    return mix64(total[end] - total[end - sizes] + sizes.astype(np.uint64)).view(np.int64)


SCAN_SCHEMA = "doc_id long, n long, node long, element long, seen long"


def _frequent_here(elements: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    values, counts = np.unique(elements, return_counts=True)
    keep = counts >= max(3, FREQUENT_SHARE * n_texts)
    return values[keep], counts[keep]


def _scan(k: int, text: str, doc_id: str):
    def counts_batch(held: list[np.ndarray], n_texts: int) -> pa.RecordBatch:
        values, counts = _frequent_here(np.concatenate(held), n_texts)
        none = pa.nulls(len(values), pa.int64())
        return pa.RecordBatch.from_arrays([none, none, none, pa.array(values.view(np.int64)), pa.array(counts)],
                                          names=names)

    names = ["doc_id", "n", "node", "element", "seen"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, n_texts = [], 0, 0
        for rows in row_chunks(batches, text):
            elements, sizes = shingle_sets(rows.column(text), k)
            ids = rows.column(doc_id)
            part = (sizes > 0) & np.array(ids.is_valid())
            none = pa.nulls(len(sizes), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(sizes), pa.array(set_ids(elements, sizes), mask=~part), none, none], names=names)
            held.append(elements)
            size, n_texts = size + len(elements), n_texts + len(sizes)
            if size >= 1 << 19:
                yield counts_batch(held, n_texts)
                held, size, n_texts = [], 0, 0
        if held:
            yield counts_batch(held, n_texts)
    return run


# --- signatures ---------------------------------------------------------------

def _sign(k: int, num: int, den: int, text: str, doc_id: str, frequent, wanted):
    """(sig, node) of every set, each set once for a task; only signatures in the bitmap ``wanted`` if given."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for rows in row_chunks(batches, text):
            rows = rows.filter(rows.column(doc_id).is_valid())
            elements, sizes = shingle_sets(rows.column(text), k)
            ids = set_ids(elements, sizes)
            new = np.zeros(len(sizes), bool)
            for i, x in enumerate(ids.tolist()):
                new[i] = sizes[i] > 0 and x not in done
                done.add(x)
            if len(done) > 1 << 18:  # bounded memory: a set may then sign again
                done = set()
            elements = elements[np.repeat(new, sizes)]
            sigs, of = signatures(elements, sizes[new], frequent.value, num, den)
            nodes = ids[new][of]
            if wanted is not None:
                keep = _in_bitmap(wanted.value, sigs)
                sigs, nodes = sigs[keep], nodes[keep]
            for at in range(0, len(sigs), 1 << 18):
                part = slice(at, at + (1 << 18))
                yield pa.RecordBatch.from_arrays([pa.array(sigs[part].view(np.int64)), pa.array(nodes[part])],
                                                 names=["sig", "node"])
    return run


# --- bitmaps: row filters of bounded size before an exact join ------------------

def bitmap(rows: DataFrame, column: str) -> np.ndarray:
    """Bits set for the values of a long column; built by the executors, at most 16 MB."""
    n = rows.count()
    bits = min(MAX_BITS, max(1 << 15, 1 << int(np.ceil(np.log2(64 * n + 1)))))
    place = F.pmod(F.col(column), F.lit(bits)) + 1
    parts = (rows.groupBy(F.bitmap_bucket_number(place).alias("part"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect())
    out = np.zeros((bits >> 15, 4096), np.uint8)
    for r in parts:
        out[r.part - 1] = np.frombuffer(r.bits, np.uint8)
    return out.ravel()


def _in_bitmap(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    place = (values.view(np.uint64) & np.uint64(8 * len(bits) - 1)).astype(np.int64)
    return (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def _only(wanted):
    """(doc_id, text) of rows in the bitmap; repeated rows of a task once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[tuple[int, int]] = set()
        for batch in batches:
            ids = batch.column("doc_id")
            keep = _in_bitmap(wanted.value, ids.fill_null(0).to_numpy()) & np.array(ids.is_valid())
            batch = batch.filter(pa.array(keep))
            rows = list(zip(batch.column("doc_id").to_pylist(), map(hash, batch.column("text").to_pylist()), strict=True))
            new = []
            for r in rows:
                new.append(r not in done)
                done.add(r)
            if len(done) > 1 << 18:  # bounded memory: a row may then come again
                done = set()
            yield batch.filter(pa.array(new, pa.bool_()))
    return run


def _sized(table: DataFrame) -> DataFrame:
    """A written table to be joined to texts: broadcast up to ``BROADCAST_ROWS`` rows of a few longs, else shuffled."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


# --- linking --------------------------------------------------------------------

LINK_SCHEMA = "cluster long, node long, label long"


def _link(k: int, num: int, den: int):
    """Task code: the components of a block; a label is the least label that a component held before."""
    def run(group: pa.Table) -> pa.Table:
        nodes, labels = group["node"].to_numpy(), group["label"].to_numpy()
        elements, sizes = shingle_sets(group["text"].combine_chunks(), k)
        # an id that stands for several texts brings them all: only the class's own set counts, and once
        own = np.flatnonzero(set_ids(elements, sizes) == nodes)
        own = own[np.unique(nodes[own], return_index=True)[1]]
        begin = np.cumsum(sizes) - sizes
        sets = [elements[begin[i]:begin[i] + sizes[i]] for i in own]
        found = SignatureTree(sets, labels[own], num, den).link()
        least = np.full(int(found.max(initial=-1)) + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, found, labels[own])
        cluster = group["cluster"][0].as_py()
        return pa.table({"cluster": np.full(len(own), cluster), "node": nodes[own], "label": least[found]})
    return run


def _meet(texts: DataFrame, groups: DataFrame, link) -> DataFrame:
    """Trees over groups (cluster, first, second, node, label) of nodes whose texts are joined to them."""
    rows = groups.join(texts.select("node", "text"), "node")
    return rows.groupBy("cluster", "first", "second").applyInArrow(link, LINK_SCHEMA)


def _relabel(spark: SparkSession, labels: DataFrame, found: DataFrame, name: str) -> DataFrame:
    """``labels`` (cluster, node, label) after the links of ``found``: labels that a node had and got are one."""
    edges = (found.withColumnRenamed("label", "b").join(labels.select("node", F.col("label").alias("a")), "node")
             .filter("a <> b").select("a", "b").distinct())
    merged = components(IO.materialize(edges, spark, f"{name}/edges"))
    merged = IO.materialize(merged, spark, f"{name}/merged")
    now = labels.join(merged.withColumnRenamed("node", "label"), "label", "left").select(
        "cluster", "node", F.coalesce("component", "label").alias("label"))
    return IO.materialize(now, spark, f"{name}/labels")


def _carry(spark: SparkSession, texts: DataFrame, labels: DataFrame, units: DataFrame, link, run: str) -> DataFrame:
    """Two texts of the largest component of every unit meet those of the other units of a group."""
    parts = (labels.join(units, ["cluster", "node"]).groupBy("cluster", "unit", "label")
             .agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("a"), F.max("node").alias("b")))
    best = parts.groupBy("cluster", "unit").agg(F.max(F.struct("n", "label", "a", "b")).alias("best"))
    groups = best.select("cluster", F.col("best.label").alias("label"),
                         F.explode(F.array_distinct(F.array("best.a", "best.b"))).alias("node"),
                         F.expr(f"unit div {CARRIED_UNITS}").alias("first"), F.lit(-1).cast("long").alias("second"))
    groups = IO.materialize(groups, spark, f"{run}/carriers")
    return _relabel(spark, labels, IO.materialize(_meet(texts, groups, link), spark, f"{run}/carried"), run)


def _link_large(spark: SparkSession, texts: DataFrame, labels: DataFrame, sizes: DataFrame, units: DataFrame, link,
                run: str) -> DataFrame:
    """Links between the blocks of clusters that have several; ``labels`` hold their components within blocks."""
    most, level = sizes.agg(F.max("blocks")).first()[0], 0
    while most > 1:  # from blocks to groups of blocks, to groups of those
        labels = _carry(spark, texts, labels, units, link, f"{run}/carry-{level}")
        units = units.withColumn("unit", F.expr(f"unit div {CARRIED_UNITS}"))
        most, level = -(-most // CARRIED_UNITS), level + 1
    # the largest component's texts are dealt into blocks, and so are the others; others meet every block
    counts = labels.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("n"))
    main = (counts.groupBy("cluster").agg(F.max(F.struct("n", "label")).alias("main"), F.sum("n").alias("n"))
            .join(sizes, "cluster").withColumn("blocks", F.ceil(F.col("blocks") / MEETING_BLOCKS))
            .select("cluster", F.col("main.label").alias("main"),
                    F.ceil(F.col("blocks") * F.col("main.n") / F.col("n")).alias("main_blocks"),
                    F.ceil(F.col("blocks") * (F.col("n") - F.col("main.n")) / F.col("n")).alias("other_blocks")))
    main = IO.materialize(main, spark, f"{run}/main")
    dealt = labels.join(main, "cluster").filter("other_blocks > 0")
    h = F.xxhash64(F.lit(7), F.col("node"))
    is_main = F.col("label") == F.col("main")
    dealt = dealt.select("cluster", "node", "label", "other_blocks", "main_blocks", F.when(
        is_main, -1 - F.pmod(h, F.col("main_blocks"))).otherwise(F.pmod(h, F.col("other_blocks"))).alias("own"))
    # a pair of blocks is (first, second): first of the others, second of the others from there on, or below 0 of the main
    others, b = F.sequence(F.lit(0).cast("long"), F.col("other_blocks") - 1), F.col("own")
    as_first = F.transform(others, lambda x: F.struct(F.least(x, b).alias("first"), F.greatest(x, b).alias("second")))
    with_main = F.transform(F.sequence(F.lit(1).cast("long"), F.col("main_blocks")),
                            lambda x: F.struct(b.alias("first"), (-x).alias("second")))
    of_main = F.transform(others, lambda x: F.struct(x.alias("first"), b.alias("second")))
    pairs = F.when(b < 0, of_main).otherwise(F.concat(as_first, with_main))
    groups = dealt.select("cluster", "node", "label", F.inline(pairs))
    return _relabel(spark, labels, IO.materialize(_meet(texts, groups, link), spark, f"{run}/met"), f"{run}/met")


def similar_components(docs: DataFrame, shingle: int = SHINGLE, similar: tuple[int, int] = SIMILAR,
                       doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, node, component, component_id) of every row; node is its set's id, component its component's.

    A text is the set of its distinct ``shingle``-word shingles (A-Z to lower
    case, words between white space; fewer words: all as one). Rows link when
    the Jaccard similarity of their sets is num/den or more, and a component's
    id is the least ``doc_id`` in it. All links count; none is estimated.

    Rows without words or text have no shingles and stay alone, as do rows
    without a ``doc_id``, whose component is null. Repeated rows are copies;
    rows that share an id but not a text are linked by their own texts. Sets
    are told apart by a 64-bit id (two of n sets share one with odds of about
    n**2 / 2**65). Other columns are left out.
    """
    spark, (num, den) = docs.sparkSession, similar
    run = f"ngram-join-{uuid.uuid4().hex}"
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    scan = IO.materialize(map_texts(texts, _scan(shingle, "text", "doc_id"), SCAN_SCHEMA), spark, f"{run}/scan")
    rows = scan.filter("n IS NOT NULL").select("doc_id", "n", "node")
    n_rows = rows.count()
    often = (scan.filter("element IS NOT NULL").groupBy("element").agg(F.sum("seen").alias("seen"))
             .filter(F.col("seen") >= FREQUENT_SHARE / 2 * n_rows).orderBy(F.desc("seen"), "element").limit(MAX_FREQUENT))
    frequent = np.sort(np.array([r.element for r in often.collect()], np.int64).view(np.uint64))
    held = spark.sparkContext.broadcast(frequent)
    classes = IO.materialize(
        rows.filter("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n")),
        spark, f"{run}/classes")

    # signatures of several classes, each with its least class
    signed = map_texts(texts, _sign(shingle, num, den, "text", "doc_id", held, None), "sig long, node long")
    shared = IO.materialize(
        signed.groupBy("sig").agg(F.min("node").alias("hub"), F.max("node").alias("last")).filter("hub <> last")
        .select("sig", "hub"), spark, f"{run}/shared")
    wanted = spark.sparkContext.broadcast(bitmap(shared, "sig"))
    again = map_texts(texts, _sign(shingle, num, den, "text", "doc_id", held, wanted), "sig long, node long")
    edges = again.join(shared, "sig").filter("hub <> node").select(F.col("hub").alias("a"), F.col("node").alias("b"))
    clusters = components(IO.materialize(edges.distinct(), spark, f"{run}/edges"))

    # members of clusters, dealt into blocks
    members = IO.materialize(clusters.withColumnRenamed("component", "cluster").join(classes, "node"),
                             spark, f"{run}/members")
    sizes = members.groupBy("cluster").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("classes")).select(
        "cluster", F.greatest(F.lit(1).cast("long"), F.floor(F.least(
            F.col("n") / BLOCK_ELEMENTS, F.col("classes") / BLOCK_CLASSES))).alias("blocks"))
    sizes = IO.materialize(sizes, spark, f"{run}/sizes")
    dealt = IO.materialize(
        members.join(sizes, "cluster").select("cluster", "node", "rep", F.pmod(F.xxhash64("node"), "blocks").alias("first")),
        spark, f"{run}/dealt")
    reps = spark.sparkContext.broadcast(bitmap(dealt, "rep"))
    member_texts = map_texts(texts, _only(reps), "doc_id long, text string").join(
        _sized(dealt), F.col("doc_id") == F.col("rep")).select("node", "cluster", "first", "text")
    member_texts = IO.materialize(member_texts, spark, f"{run}/texts")
    link = _link(shingle, num, den)
    in_blocks = (member_texts.withColumn("label", F.col("node")).groupBy("cluster", "first")
                 .applyInArrow(link, LINK_SCHEMA))
    labels = IO.materialize(in_blocks, spark, f"{run}/labels")
    large = IO.materialize(sizes.filter("blocks > 1"), spark, f"{run}/large-sizes")
    if not large.isEmpty():
        # only the texts of these clusters go through the exchanges of the meetings
        large_texts = IO.materialize(member_texts.join(large.select("cluster"), "cluster", "left_semi"),
                                     spark, f"{run}/large-texts")
        some = labels.join(large.select("cluster"), "cluster", "left_semi")
        some = IO.materialize(some, spark, f"{run}/large")
        units = dealt.join(large.select("cluster"), "cluster", "left_semi").select(
            "cluster", "node", F.col("first").alias("unit"))
        done = _link_large(spark, large_texts, some, large, units, link, run)
        labels = labels.join(large.select("cluster"), "cluster", "left_anti").unionByName(done)

    # from labels to the least doc_id, for every class and then for every row
    named = IO.materialize(labels.join(classes.select("node", "rep"), "node"), spark, f"{run}/named")
    least = IO.materialize(named.groupBy("label").agg(F.min("rep").alias("component")), spark, f"{run}/least")
    linked = named.join(least, "label").select("node", "label", "component")
    final = IO.materialize(classes.join(linked, "node", "left").select(
        "node", F.coalesce("label", "node").alias("component"), F.coalesce("component", "rep").alias("component_id")),
        spark, f"{run}/components")
    return rows.join(final, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), "node", "component",
        F.coalesce("component_id", "doc_id").alias("component_id"))


def _fresh(name: str, taken: list[str]) -> str:
    """A column name that the table doesn't have."""
    while name in taken:
        name = "_" + name
    return name


def _split_off(k: int, suspects, inside: bool, names: list[str]):
    """Rows whose id is in the bitmap, with their set's id, or the other rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in row_chunks(batches, "text"):
            ids = rows.column("doc_id")
            hit = _in_bitmap(suspects.value, ids.cast(pa.int64()).fill_null(0).to_numpy()) & np.array(ids.is_valid())
            rows = rows.filter(pa.array(hit == inside))
            if not inside:
                yield rows
            elif rows.num_rows:
                node = set_ids(*shingle_sets(rows.column("text"), k))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(node)], names=names)
    return run


def keep_one_of_each(docs: DataFrame, shingle: int = 5, similar: tuple[int, int] = (80, 100)) -> DataFrame:
    """``docs`` with one row of each component of similar texts, the one of the least ``doc_id``; all columns stay.

    Rows alone in their component, without shingles or without an id all stay.
    Only rows of components of several are looked at again and shuffled.
    """
    spark = docs.sparkSession
    run = f"keep-one-{uuid.uuid4().hex}"
    found = IO.materialize(similar_components(docs, shingle, similar).filter("node IS NOT NULL"), spark, f"{run}/found")
    several = IO.materialize(
        found.groupBy("component").agg(F.min(F.struct("doc_id", "node")).alias("stays"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1").select("component", "stays"), spark, f"{run}/several")
    # every row of these components: whether it stays, and whether it is there more than once
    suspects = IO.materialize(
        found.join(several, "component").groupBy("doc_id", "node")
        .agg(F.min("stays").alias("stays"), (F.count(F.lit(1)) > 1).alias("again"))
        .select(F.col("doc_id").alias("suspect_id"), F.col("node").alias("suspect_node"),
                (F.struct("doc_id", "node") == F.col("stays")).alias("stays"), "again"), spark, f"{run}/suspects")
    held = spark.sparkContext.broadcast(bitmap(suspects, "suspect_id"))
    node = _fresh("node", docs.columns)
    names = [_fresh(c, docs.columns) for c in suspects.columns]
    suspect_id, suspect_node, stays, again = map(F.col, names)
    alone = map_texts(docs, _split_off(shingle, held, False, []), docs.schema)
    schema = StructType([*docs.schema.fields, StructField(node, LongType())])
    seen = map_texts(docs, _split_off(shingle, held, True, [*docs.columns, node]), schema)
    met = seen.join(_sized(suspects.toDF(*names)), (F.col("doc_id") == suspect_id) & (F.col(node) == suspect_node), "left")
    out = alone.unionByName(met.filter(suspect_id.isNull() | (stays & ~again)).select(*docs.columns))
    if not suspects.filter("stays AND again").isEmpty():
        out = out.unionByName(met.filter(stays & again).dropDuplicates(names[:2]).select(*docs.columns))
    return out


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of ``documents`` by 4-word shingles at a Jaccard similarity of 0.85."""
    found = similar_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_shingles", "component_id")
