"""The shared checkpoint folder is read from the session, never replaced."""

from wordloom.session import ensure_checkpoint_dir, scratch_path


def test_checkpoint_dir_is_kept(spark, tmp_path):
    sc = spark.sparkContext
    before = sc.getCheckpointDir()
    target = str(tmp_path / "shared")
    sc.setCheckpointDir(target)
    try:
        got = ensure_checkpoint_dir(spark)
        # Spark puts its own sub-folder under the folder it is given
        assert got == sc.getCheckpointDir() and "/shared/" in got
        assert scratch_path(spark, "x").startswith(got.rstrip("/"))
        assert ensure_checkpoint_dir(spark) == got
    finally:
        if before:
            sc.setCheckpointDir(before)


def test_working_tables_go_with_their_block(spark):
    """A table lives as long as the block it was written for."""
    import os

    from wordloom.session import working_tables, written

    files = lambda df: [f.removeprefix("file://") for f in df.inputFiles()]
    df = spark.range(10).repartition(3)
    with working_tables(spark):
        with working_tables(spark):
            inner, outer, ever = (files(written(df, "t", ends=n)) for n in (1, 2, None))
            assert all(map(os.path.exists, inner + outer + ever))
        assert not any(map(os.path.exists, inner)) and all(map(os.path.exists, outer + ever))
        try:
            with working_tables(spark):
                failed = files(written(df, "t"))
                raise KeyError
        except KeyError:
            assert not any(map(os.path.exists, failed))
    assert not any(map(os.path.exists, outer)) and all(map(os.path.exists, ever))
    assert written(df, "t").count() == 10
