import pytest
from helpers import history, rows

from tidemark.sources.versions import content_hash, drop_data, hard_delete


def test_hard_delete_drops_every_row_of_a_marked_record(spark):
    df, fg = history(spark, [(1, 1, 1.0, 1, 1, False), (1, 2, None, 2, 2, True), (2, 1, 2.0, 1, 1, False)])
    assert rows(hard_delete(df, fg), "id") == [(2,)]


def test_content_hash_is_free_of_order(spark, tmp_path):
    df, _ = history(spark, [(i, i, float(i), i, i, False) for i in range(9)])
    assert content_hash(df).first() == content_hash(df.repartition(3)).first()
    assert content_hash(df).first() != content_hash(df.where("id > 0")).first()


def test_dropping_needs_confirmation(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    with pytest.raises(ValueError):
        drop_data(spark, path)
    drop_data(spark, path, confirm=True)
    assert not (tmp_path / "t").exists()
