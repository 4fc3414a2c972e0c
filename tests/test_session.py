from types import SimpleNamespace

import pytest

from starloom import session
from starloom.session import materialize, scratch_path, shared_folder


class FakeSpark:
    def __init__(self, setting=None, by_code=None, master="spark://host:7077"):
        self.conf = SimpleNamespace(get=lambda key, default=None: setting if key == "spark.checkpoint.dir" else default)
        self.sparkContext = SimpleNamespace(
            master=master, applicationId="app-1", getCheckpointDir=lambda: by_code
        )


def test_the_cluster_names_the_folder():
    assert shared_folder(FakeSpark("hdfs:///shared")) == "hdfs:///shared"
    assert shared_folder(FakeSpark(None, "s3a://b/c")) == "s3a://b/c"


def test_a_cluster_without_the_setting_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(FakeSpark())


def test_a_local_session_gets_one_folder_of_its_own():
    local = FakeSpark(master="local[2]")
    assert shared_folder(local) == shared_folder(local)
    session._local_folders.pop("app-1")


def test_materialize_reads_back_what_was_written(spark):
    df = materialize(spark.range(10, numPartitions=3), "numbers")
    assert df.count() == 10 and "FileScan parquet" in df._jdf.queryExecution().executedPlan().toString()
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
    assert scratch_path(spark, "a").startswith(spark.conf.get("spark.checkpoint.dir"))
