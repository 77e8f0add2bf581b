"""Multi-line CSV files in splits against Spark's whole-file reader, and against the rows that were written."""

import random

import pytest

from narrata.sources import io as IO
from narrata.sources.csv_splits import read_csv_splits

SCHEMA = IO.TY.StructType([IO.TY.StructField("id", IO.TY.LongType()), IO.TY.StructField("a", IO.TY.StringType()),
                           IO.TY.StructField("b", IO.TY.StringType())])
KEY = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def splits_of(spark):
    before = spark.conf.get(KEY)
    yield lambda size: spark.conf.set(KEY, str(size))
    spark.conf.set(KEY, before)


def rows_of(df):
    return sorted(((r.id, r.a, r.b) for r in df.collect()), key=str)


def quoted(v):
    if v is None:
        return ""
    return '"' + v.replace('"', '""') + '"' if v == "" or any(c in v for c in ',"\n\r') else v


@pytest.mark.parametrize("size", [97, 1 << 20])
def test_records_of_any_split(spark, splits_of, tmp_path, size):
    rng = random.Random(size)
    words = ['plain', 'with "quotes"', 'two\nlines', 'a, comma', '"', '\n\n', 'é漢', 'one\r\ntwo', None, 'x' * 60]
    rows = []
    for f in range(3):
        own = [(f * 1000 + i, rng.choice(words), " ".join(w or "" for w in rng.choices(words, k=rng.randrange(1, 6))))
               for i in range(30)]
        if f == 2:  # a record over many splits
            own.append((2999, "long\n" * 80 + 'end "of" it', "b"))
        rows += own
        end = "\r\n" if f == 1 else "\n"
        text = end.join(["id,a,b", *(",".join([str(i), quoted(a), quoted(b)]) for i, a, b in own)]) + end * (f + 1)
        (tmp_path / f"part-{f}.csv").write_bytes(text.encode())
    (tmp_path / "part-empty.csv").write_bytes(b"")
    splits_of(size)
    got = read_csv_splits(spark, str(tmp_path), SCHEMA)
    assert rows_of(got) == sorted(((i, a or None, b or None) for i, a, b in rows), key=str)  # an empty value is null


def test_equal_to_the_whole_file_reader(spark, splits_of, tmp_path):
    rows = [(i, None if i % 7 == 0 else f'a {i}\n"b", {i % 5}', "" if i % 11 == 0 else f"t{i}") for i in range(150)]
    path = str(tmp_path / "out.csv")
    IO.write_stage(spark.createDataFrame(rows, SCHEMA).coalesce(1), path, "csv")
    want = rows_of(IO.read_complaints(spark, path, SCHEMA))
    splits_of(400)
    got = read_csv_splits(spark, path, SCHEMA)
    assert rows_of(got) == want
    assert got.columns == ["id", "a", "b"]
    assert spark.read.text(path).rdd.getNumPartitions() > 8


def test_faults(spark, tmp_path):
    (tmp_path / "open.csv").write_text('id,a,b\n1,"never closed,x\n2,b,c\n')
    with pytest.raises(ValueError, match="left open"):
        read_csv_splits(spark, str(tmp_path / "open.csv"), SCHEMA)
    (tmp_path / "type.csv").write_text("id,a,b\nnot a number,a,b\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv_splits(spark, str(tmp_path / "type.csv"), SCHEMA).collect()
    (tmp_path / "none.csv").write_text("id,a,b\n")
    assert read_csv_splits(spark, str(tmp_path / "none.csv"), SCHEMA).collect() == []
