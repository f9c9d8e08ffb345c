"""The shared checkpoint folder: taken from the session, set only when unset."""

from tidesync.session import ensure_checkpoint_dir, scratch_path


def test_checkpoint_dir_is_kept_and_scratch_lives_under_it(spark):
    current = spark.sparkContext.getCheckpointDir()
    assert current                                    # the test session has one (set or configured)
    assert ensure_checkpoint_dir(spark, fallback="/tmp/should-not-be-used") == current
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(current.rstrip("/")) and b.startswith(current.rstrip("/"))
