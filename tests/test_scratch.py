"""Scratch files: one folder per application, removed on request."""

import os

from txprep import scratch
from txprep.scratch import clear_scratch, scratch_path


def test_scratch_is_removed_on_request(spark, tmp, monkeypatch):
    # a root of its own: other tests' files stay
    monkeypatch.setattr(scratch, "checkpoint_root", lambda spark: tmp)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and os.path.dirname(a) == os.path.dirname(b)
    other = os.path.join(tmp, "txprep", "another-application")
    os.makedirs(other)
    spark.range(10).write.parquet(a)
    assert clear_scratch(spark) and not os.path.exists(a) and os.path.exists(other)
    assert not clear_scratch(spark)
