from stellate.session import checkpoint_root, scratch_path, sizing_conf


def test_sizing_conf_scales_with_input():
    small = sizing_conf(10 << 20, 8)
    big = sizing_conf(100 << 40, 8000)
    assert small["spark.sql.shuffle.partitions"] == "16"  # at least two per core
    assert int(big["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)  # no cap
    assert big["spark.sql.files.maxPartitionBytes"] == str(256 << 20)


def test_checkpoint_root_reads_session(spark):
    root = checkpoint_root(spark)
    expected = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert root and root == expected
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root.rstrip("/"))


def test_scratch_scope_removes_intermediates(spark):
    import os

    from stellate.session import scratch_scope

    with scratch_scope(spark) as made:
        path = scratch_path(spark, "tmp")
        spark.range(3).write.parquet(path)
        assert made == [path]
    assert not os.path.exists(path.replace("file:", ""))


def test_exact_quantiles_leaves_no_intermediate(spark):
    import glob
    import os

    from stellate.operators.profile import exact_quantiles

    root = checkpoint_root(spark).replace("file:", "")
    before = set(glob.glob(os.path.join(root, "quantiles-*")))
    exact_quantiles(spark.range(10).selectExpr("CAST(id AS DOUBLE) AS v"), ["v"])
    assert set(glob.glob(os.path.join(root, "quantiles-*"))) == before


def test_size_session_follows_the_input(spark, tmp_dir):
    from stellate.session import input_bytes, size_session

    spark.range(1000).write.parquet(f"{tmp_dir}/t")
    n = input_bytes(spark, f"{tmp_dir}/t", f"{tmp_dir}/missing")
    assert n > 0
    keep = {k: spark.conf.get(k) for k in sizing_conf(n, 4)}
    try:
        size_session(spark, 10 << 40)
        # Set when the session was made, so it stays.
        assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == str(256 << 20)
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
