"""Token files: exact round trip of blocks and documents, starts in doc_id order."""

import os
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from hypothesis import given, settings
from hypothesis import strategies as st

from narrata.llm import token_files as TF
from narrata.llm.batches import BATCH_BYTES, map_texts
from narrata.llm.bpe import encoder
from narrata.sources import io as IO
from tests.conftest import SF_SMALL


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=700))
def test_blocks_round_trip(values):
    ids = np.array(values, np.uint32)
    stream = TF.encode_ids(ids)
    assert TF.decode_ids(stream).tolist() == values
    assert TF.decode_ids(stream, 1, 3).tolist() == values[128:384]


def expected(rows, end_id=TF.END_ID):
    """Brute force: documents in ascending order, the library's ids, running starts."""
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = encoder().tok.encode(text or "", add_special_tokens=False).ids + [end_id]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def digest(spark, docs):
    path = IO.scratch_path(spark, f"test-{uuid.uuid4().hex}")
    TF.write_token_files(docs, path)
    return path, sorted((tuple(r) for r in TF.token_file_digest(spark, path).collect()), key=lambda r: r[1])


def test_documents_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    path, got = digest(spark, docs)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got == expected(rows)
    ids = {r.doc_id: list(r.ids) for r in TF.read_token_files(spark, path).collect()}
    assert ids[rows[5][0]] == encoder().tok.encode(rows[5][1], add_special_tokens=False).ids + [2]


def test_edge_rows(spark):
    rows = [(5, None, 1), (None, "null id", 2), (3, "", 3), (9, "same", 4), (9, "same", 5), (-2, "word " * 40_000, 6),
            (7, "<|endoftext|> 漢字", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int").repartition(3)
    _, got = digest(spark, docs)
    assert got == expected([r[:2] for r in rows])


def test_empty_table(spark):
    _, got = digest(spark, spark.createDataFrame([], "doc_id long, text string"))
    assert got == []


def test_chunks_are_written_in_small_row_groups(spark):
    """A task's chunks were one row group of one page, held whole by the writer and by every reader."""
    docs = spark.range(40).selectExpr("id AS doc_id", "repeat('alpha zebra one ', 40000) || id AS text").coalesce(1)
    path = IO.scratch_path(spark, f"test-{uuid.uuid4().hex}")
    TF.write_token_files(docs, path)
    folder = path.removeprefix("file:")
    groups = []
    for name in sorted(n for n in os.listdir(folder) if n.endswith(".parquet")):
        meta = pq.ParquetFile(os.path.join(folder, name)).metadata
        groups += [(name, meta.row_group(i).num_rows) for i in range(meta.num_row_groups)]
    assert len(groups) > len({name for name, _ in groups})
    assert max(n for _, n in groups) <= TF.ROW_GROUP_CHUNKS
    got = TF.token_file_digest(spark, path).collect()
    assert sorted(r.doc_id for r in got) == list(range(40))
    assert max(r.start + r.n_tokens for r in got) == sum(r.n_ids for r in spark.read.parquet(path).collect())


def test_batches_of_long_rows_are_small(spark):
    """400 rows of any length were one Arrow batch."""
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "size"])

    rows = spark.range(0, 60, 1, 1).selectExpr("repeat('x', 1000000) AS text")
    got = map_texts(rows, sizes, "n long, size long").collect()
    assert sum(r.n for r in got) == 60
    assert max(r["size"] for r in got) < 2 * BATCH_BYTES
