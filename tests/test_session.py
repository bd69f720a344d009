"""Session helpers: shared checkpoint folder, fresh scratch paths, concurrent steps."""

import pytest

from cloudmarts.session import checkpoint_root, run_concurrently, scratch_path


def test_checkpoint_folder_comes_from_the_session(spark):
    root = checkpoint_root(spark)
    assert root == spark.sparkContext.getCheckpointDir().rstrip("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root + "/scratch/x-")


def test_run_concurrently_returns_by_name_and_raises(spark):
    got = run_concurrently(spark, {"a": lambda: spark.range(10).count(),
                                   "b": lambda: spark.range(5).count()})
    assert got == {"a": 10, "b": 5}

    def boom():
        raise RuntimeError("step failed")

    with pytest.raises(RuntimeError, match="step failed"):
        run_concurrently(spark, {"ok": lambda: 1, "bad": boom})
