import pytest

from tidemark import session as S


def test_scratch_is_removed_at_the_end_of_its_scope(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "shared_dir", lambda _: str(tmp_path))
    outer = S.durable(spark.range(3))
    with S.scratch_scope(spark):
        assert S.durable(spark.range(5)).count() == 5
        assert len(list(tmp_path.iterdir())) == 2
    assert len(list(tmp_path.iterdir())) == 1 and outer.count() == 3


def test_a_cluster_must_name_its_shared_folder(spark, monkeypatch):
    monkeypatch.setattr(S, "_setting", lambda *_: None)
    local = S.shared_dir(spark)
    assert S.shared_dir(spark) == local

    class Cluster:
        class sparkContext:
            master = "yarn"

    with pytest.raises(RuntimeError):
        S.shared_dir(Cluster)


def test_sizes_and_settings(spark, tmp_path):
    spark.range(100_000).write.parquet(str(tmp_path / "t"))
    size = S.estimated_bytes(spark.read.parquet(str(tmp_path / "t")))
    assert 100_000 < size < 10_000_000
    joined = spark.read.parquet(str(tmp_path / "t")).alias("a").join(spark.read.parquet(str(tmp_path / "t")), "id")
    assert S.estimated_bytes(joined) == 2 * size
    assert S.cluster_settings(100 << 40)["spark.sql.shuffle.partitions"] == "409600"
