"""Session helpers: cluster sizing applied only where untuned; checkpoint folder read from the session."""

import pytest

from dimstar import session as S


def test_configure_leaves_a_set_shuffle_width_alone(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for width in ("200", "123"):
            spark.conf.set("spark.sql.shuffle.partitions", width)
            S.configure(spark)
            assert spark.conf.get("spark.sql.shuffle.partitions") == width
        S.configure(spark, shuffle_partitions=77)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "77"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_no_local_folder_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "local-cluster[3,2,3000]"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        S.ensure_checkpoint_dir(Session())


def test_checkpoint_folder_comes_from_the_session(spark):
    folder = S.ensure_checkpoint_dir(spark)
    assert folder == S.checkpoint_dir(spark)
    a, b = S.shared_folder(spark, "x"), S.shared_folder(spark, "x")
    assert a != b and a.startswith(folder.rstrip("/"))
