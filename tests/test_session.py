from dimetl.session import checkpoint_root, scratch_path


def test_scratch_lives_under_checkpoint_dir(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    root = checkpoint_root(spark)
    assert configured and configured.rstrip("/").split(":")[-1] in root
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root.rstrip("/"))


def test_runtime_conf_is_utc(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "dynamic"


def test_partitions_after_a_shuffle_are_small_whatever_the_count_of_the_session(spark):
    from dimetl.session import apply_runtime_conf

    apply_runtime_conf(spark)
    assert int(spark.conf.get("spark.sql.shuffle.partitions")) == 4
    assert int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum")) == 400
    wide = spark.range(0, 400_000, 1, 4).selectExpr("id", "cast(rand(1) as string) v", "cast(rand(2) as string) w", "cast(rand(3) as string) x", "cast(rand(4) as string) y")
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        # More partitions than the session's four: a partition's size is bounded, not its count.
        assert wide.repartition("id").rdd.getNumPartitions() > 8
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
