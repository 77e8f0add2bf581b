import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from narrata.session import checkpoint_dir, get_session

    # small inputs on one machine: merge shuffle partitions up to a size instead of one for each core
    local = {"spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2m"}
    # a folder of the run's own; static settings are given before the session starts
    local["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="narrata-test-ckpt-")
    s = get_session("local[*]", 8, app_name="narrata-tests", extra=local)
    checkpoint_dir(s)
    yield s


def rows(df, *cols):
    cols = cols or df.columns
    return [tuple(r[c] for c in cols) for r in df.collect()]
