"""Session helpers: shared folder and partition sizing."""

from couponlens.session import MAX_BLOCKS, file_status, input_bytes, scale_conf, shared_dir


def test_shared_dir_comes_from_session(spark):
    d = shared_dir(spark)
    assert d == spark.sparkContext.getCheckpointDir()
    assert "couponlens-test-" in d


def test_scale_conf_at_100_tb():
    conf = scale_conf(100 << 40, total_cores=8000)
    split, reducers = int(conf["spark.sql.files.maxPartitionBytes"]), int(conf["spark.sql.shuffle.partitions"])
    maps = -(-(100 << 40) // split)
    assert (maps, reducers) == (50_000, 20_000) and maps * reducers <= MAX_BLOCKS
    assert conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == str(reducers)
    # 5 TB reach the first shuffle: 256 MB a reducer.
    assert (5 << 40) // reducers <= 300 << 20


def test_scale_conf_of_small_and_middling_inputs():
    assert scale_conf(10 << 20, total_cores=4)["spark.sql.shuffle.partitions"] == "8"
    middle = scale_conf(2 << 40, total_cores=400)
    assert middle["spark.sql.files.maxPartitionBytes"] == str(256 << 20) and middle["spark.sql.shuffle.partitions"] == "819"


def test_input_size_and_files_come_from_the_store(spark, tmp_path):
    (tmp_path / "a").write_text("12345")
    assert input_bytes(spark, str(tmp_path)) == 5 and [s[1] for s in file_status(spark, str(tmp_path))] == [5]
    assert file_status(spark, str(tmp_path / "none")) == []


def test_stored_tables_are_shared_across_sessions(spark):
    from couponlens.plans.stage import staged
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)
    a = staged(spark, ("stage-test",), build)
    other = spark.newSession()
    b = staged(other, ("stage-test",), build)
    assert len(calls) == 1 and a.count() == b.count() == 5
    assert b.sparkSession is other
