"""Session settings and the shared scratch folder."""

from __future__ import annotations

from tephra import session


def test_prepare_applies_runtime_settings(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Denver")
    session.prepare(spark)
    for key, value in session.RUNTIME_CONF.items():
        assert spark.conf.get(key) == value


def test_shared_dir_comes_from_the_session_and_runs_are_unique(spark):
    root = session.shared_dir(spark)
    assert root == (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()).rstrip("/")
    assert spark.sparkContext.getCheckpointDir()
    a, b = session.run_dir(spark, "x"), session.run_dir(spark, "x")
    assert a != b and a.startswith(f"{root}/tephra/x-")


class _Cluster:
    """A session on a cluster that names no shared folder."""

    class sparkContext:  # noqa: N801
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class conf:  # noqa: N801
        get = staticmethod(lambda key, default=None: default)


def test_a_cluster_without_a_shared_folder_is_an_error():
    import pytest

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(_Cluster)


def test_submitted_shuffle_partitions_survive(spark):
    """The command line forces no shuffle setting off ``local``."""
    import argparse

    from tephra.__main__ import _session

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2000")
    try:
        args = argparse.Namespace(master=None, cmd="export", shuffle_partitions=None)
        assert _session(args).conf.get("spark.sql.shuffle.partitions") == "2000"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
