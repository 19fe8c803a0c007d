"""Where stored tables go."""

import pytest

from courtline import session


class _Context:
    """Stands for a context on a cluster whose shared folder is not set."""

    master = "yarn"

    def getCheckpointDir(self):
        return None

    def getConf(self):
        return {}


class _Session:
    sparkContext = _Context()
    conf = {}


def test_unset_shared_folder_is_an_error_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(_Session())


def test_raw_tables_are_stored_when_asked_for_and_follow_their_input(spark, small_dir, tmp_path):
    import shutil

    from courtline.league import League
    from courtline.sources.league import TableStore
    store = TableStore()
    first = League.from_testdata(spark, small_dir, tables=store)
    assert first.stg["players"].count() > 0
    assert [k[-1] for k in store._tables] == ["players"]
    League.from_testdata(spark, small_dir, tables=store).stg["players"].count()
    assert len(store._tables) == 1
    copy = tmp_path / "sf"
    shutil.copytree(small_dir, copy)
    assert League.from_testdata(spark, str(copy), tables=store).stg["players"].count() == first.stg["players"].count()
    (spark.read.parquet(f"{copy}/customer.parquet").limit(10).toPandas()).to_parquet(tmp_path / "c.parquet")
    (copy / "customer.parquet").chmod(0o644)
    shutil.copy(tmp_path / "c.parquet", copy / "customer.parquet")
    assert League.from_testdata(spark, str(copy), tables=store).stg["players"].count() == 10
