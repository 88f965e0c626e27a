"""The folder that lineage is cut into."""

from types import SimpleNamespace

import pytest

from tidemark.session import ensure_checkpoint_dir, scratch_path, settle


class Session:
    """As much of a session as the choice of a folder looks at."""

    def __init__(self, master, named=None):
        self.chosen = None
        self.conf = SimpleNamespace(get=lambda key, default: named or default)
        self.sparkContext = SimpleNamespace(
            master=master,
            getCheckpointDir=lambda: self.chosen,
            setCheckpointDir=lambda path: setattr(self, "chosen", path),
        )


def test_the_named_folder_is_used():
    session = Session("spark://host:7077", "hdfs:///shared")
    assert ensure_checkpoint_dir(session) == "hdfs:///shared" == session.chosen


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session("spark://host:7077"))


def test_local_sessions_get_a_folder_of_their_own():
    session = Session("local[2]")
    assert ensure_checkpoint_dir(session) == session.chosen == ensure_checkpoint_dir(session)


def test_scratch_paths_are_new_and_below_the_folder(spark):
    first, second = scratch_path(spark, "facts"), scratch_path(spark, "facts")
    assert first != second and first.startswith(ensure_checkpoint_dir(spark))


def test_settled_rows_no_longer_depend_on_their_source(spark):
    settled = settle(spark.range(5).filter("id > 1"))
    assert "Scan ExistingRDD" in settled._jdf.queryExecution().executedPlan().toString()
    assert settled.count() == 3
