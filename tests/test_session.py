from __future__ import annotations

import pytest

from headway.session import durable, scratch_path, shared_folder


class _Context:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class _Session:
    def __init__(self, master, settings=()):
        self.sparkContext, self.conf = _Context(master), dict(settings)


def test_the_named_folder_is_used():
    session = _Session("spark://host:7077", {"spark.checkpoint.dir": "s3a://shared/x/"})
    assert shared_folder(session) == "s3a://shared/x"
    assert session.sparkContext.folder is None


def test_a_cluster_needs_a_named_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(_Session("spark://host:7077"))


def test_a_local_session_makes_its_own():
    session = _Session("local[2]")
    assert shared_folder(session) == shared_folder(session) == session.sparkContext.folder


def test_paths_differ_and_results_are_reliable(spark):
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
    kept = durable(spark.range(5))
    assert kept.count() == 5
    assert kept.rdd.isCheckpointed() or "ExistingRDD" in (
        kept._jdf.queryExecution().executedPlan().toString()
    )
