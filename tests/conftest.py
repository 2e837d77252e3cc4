from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tephra.session import build_session

    s = build_session(master="local[4]", app_name="tephra-tests", shuffle_partitions=8)
    # Tests name their own shared folder (a cluster would set spark.checkpoint.dir).
    if not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tephra-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from tephra.session import run_dir

    return run_dir(spark, "test")


def rows(df, *cols):
    """Collected rows as plain tuples (selected columns, in order)."""
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]
