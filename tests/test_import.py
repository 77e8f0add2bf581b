"""The entry module imports under spark-submit's module path (pyspark as a zip) and
without the optional training-data subpackage."""

import glob
import os
import subprocess
import sys

import pyspark

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_imports_with_zipped_pyspark():
    lib = os.path.join(os.path.dirname(pyspark.__file__), "python", "lib")
    zips = [os.path.join(lib, "pyspark.zip"), *glob.glob(os.path.join(lib, "py4j-*.zip"))]
    code = ("import pyspark, __spark_entry__ as e; assert 'pyspark.zip' in pyspark.__file__; "
            "print(len(e.queries()), len(e.oracle_sql()))")
    env = {**os.environ, "PYTHONPATH": os.pathsep.join([*zips, REPO])}
    out = subprocess.run([sys.executable, "-B", "-c", code], env=env, cwd=REPO,
                         capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    n_queries, n_sql = map(int, out.stdout.split())
    assert n_queries >= 70 and n_sql >= 65


def test_stop_words_need_no_session():
    from narrata.functions.text import default_stopwords
    words = default_stopwords()
    assert len(words) == len(set(words)) == 181 and {"the", "don't", "ourselves"} <= set(words)


def test_core_queries_without_the_optional_subpackage():
    """Where the training-data operators, or a library that only they need, are missing, the others are registered."""
    for missing in ("ahocorasick", "narrata.llm", "corpus_pipeline"):
        code = (f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; q = e.queries(); "
                "print(len(q), len(e.oracle_sql()), sum(k.startswith('op') or k == 'pipeline' for k in q))")
        out = subprocess.run([sys.executable, "-B", "-c", code], cwd=REPO, capture_output=True, text=True, timeout=120)
        assert out.returncode == 0, out.stderr
        n_queries, n_sql, n_own = map(int, out.stdout.split())
        assert n_queries >= 75 and n_sql >= 70 and n_own == 0


def test_a_cluster_must_name_its_shared_folder():
    import pytest
    from narrata.session import checkpoint_dir

    class Context:
        master = "local-cluster[3,2,1000]"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())
