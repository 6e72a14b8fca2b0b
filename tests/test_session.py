"""Session contracts: scratch below the shared checkpoint folder."""

from starmart.session import ensure_checkpoint_dir, scratch_path


def test_scratch_lives_under_checkpoint_dir(spark):
    root = ensure_checkpoint_dir(spark)
    p = scratch_path(spark, "x")
    assert p.startswith(root.rstrip("/") + "/")
    assert scratch_path(spark, "x") != p          # a fresh folder per use
