import pytest

from textgauge import session


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert named and session.shared_dir(spark) == named.rstrip("/")
    first, second = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    assert first.startswith(named) and first != second
    session.ensure_checkpoint_dir(spark)
    assert named in spark.sparkContext.getCheckpointDir()


def test_a_cluster_without_the_setting_is_refused(monkeypatch):
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())


def test_spread_leaves_large_inputs_alone(spark):
    many = spark.range(0, 100, 1, 50)
    assert session.spread(many) is many
    few = session.spread(spark.range(0, 100, 1, 1))
    assert few.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
