"""Where written tables go."""

import os
import pathlib
import subprocess
import sys
import tempfile
import textwrap

import pytest

from quern import session


def test_the_named_folder_is_used():
    code = """
        import os, sys
        from pyspark.sql import SparkSession
        from quern.session import shared_dir, stable
        named = sys.argv[1]
        spark = (SparkSession.builder.master("local[2]").config("spark.checkpoint.dir", named)
                 .config("spark.ui.enabled", "false").getOrCreate())
        assert shared_dir(spark) == named, shared_dir(spark)
        assert stable(spark.range(3)).count() == 3
        assert any(f.startswith("table-") for f in os.listdir(named)), os.listdir(named)
    """
    folder = tempfile.mkdtemp(prefix="quern-named-")
    done = subprocess.run(
        [sys.executable, "-c", textwrap.dedent(code), folder], capture_output=True, text=True, timeout=120
    )
    assert done.returncode == 0, done.stderr[-2000:]


def test_a_cluster_without_a_shared_folder_is_refused():
    class Cluster:
        class conf:
            @staticmethod
            def get(key, default):
                return default

        class sparkContext:
            master = "spark://host:7077"

            @staticmethod
            def getCheckpointDir():
                return None

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Cluster())


def test_scratch_tables_can_be_removed(spark):
    kept = session.stable(spark.range(3))
    folder = pathlib.Path("/" + kept.inputFiles()[0].removeprefix("file:").lstrip("/")).parent
    assert kept.count() == 3 and folder.is_dir()
    session.remove_scratch(spark)
    assert not folder.exists()


def test_task_functions_need_no_package_on_the_executors(data):
    code = """
        import sys
        sys.path.insert(0, sys.argv[1])
        from quern.plans.catalog import QUERIES
        import quern.plans
        from quern.session import local_session
        spark = local_session(2)
        for name in ("covariance_matrix", "map_partitions_with_index", "custom_aggregate", "logreg_sgd"):
            assert QUERIES[name](spark, sys.argv[2]).count() > 0
    """
    here = str(pathlib.Path(__file__).resolve().parent.parent)
    elsewhere = tempfile.mkdtemp(prefix="quern-cwd-")
    done = subprocess.run(
        [sys.executable, "-c", textwrap.dedent(code), here, data],
        capture_output=True, text=True, timeout=300, cwd=elsewhere,
        env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"},
    )
    assert done.returncode == 0, done.stderr[-2000:]


def test_kept_tables_are_written_once(spark, tmp_path):
    from quern.session import kept, remove_scratch, source_version

    source = str(tmp_path / "source")
    spark.range(3).write.parquet(source)
    calls = []

    def ask():
        table = spark.read.parquet(source)
        return kept(spark, ("n", source_version(table)), lambda path: (calls.append(path), table.write.parquet(path)))

    first = ask()
    assert ask() == first and len(calls) == 1 and spark.read.parquet(first).count() == 3
    spark.range(5).write.mode("overwrite").parquet(source)
    assert spark.read.parquet(ask()).count() == 5 and len(calls) == 2
    remove_scratch(spark)
    assert ask() == calls[1] and len(calls) == 2
    remove_scratch(spark, kept_too=True)
    assert spark.read.parquet(ask()).count() == 5 and len(calls) == 3
