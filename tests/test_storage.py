"""Work tables and small files."""

import pytest

from machpulse.sources import storage


def test_tables_of_a_finished_step_are_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "work_folder", lambda spark, name: str(tmp_path / name))
    with storage.passing_tables(spark):
        first = storage.stored(spark.range(3), "first")
        with storage.passing_tables(spark):
            storage.stored(spark.range(1), "inner")
        assert not (tmp_path / "inner").exists() and (tmp_path / "first").exists()
        kept = storage.stored(first.selectExpr("id * 2 AS id"), "kept", keep=True)
    assert not (tmp_path / "first").exists()
    assert sorted(r.id for r in kept.collect()) == [0, 2, 4]
    storage.stored(spark.range(1), "outside")
    assert (tmp_path / "outside").exists()


def test_tables_go_when_the_step_fails(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "work_folder", lambda spark, name: str(tmp_path / name))
    with pytest.raises(RuntimeError), storage.passing_tables(spark):
        storage.stored(spark.range(3), "half")
        raise RuntimeError
    assert not (tmp_path / "half").exists()


def test_empty_folders_are_pruned_up_to_the_root(spark, tmp_path):
    (tmp_path / "root" / "a" / "b").mkdir(parents=True)
    (tmp_path / "root" / "c").mkdir()
    storage.prune_empty(spark, str(tmp_path / "root" / "a" / "b"), str(tmp_path / "root"))
    assert not (tmp_path / "root" / "a").exists() and (tmp_path / "root" / "c").exists()
    storage.prune_empty(spark, str(tmp_path / "root" / "c"), str(tmp_path / "root"))
    assert not (tmp_path / "root").exists() and tmp_path.exists()


def test_text_files(spark, tmp_path):
    path = str(tmp_path / "new" / "x.json")
    storage.write_text(spark, path, '{"é": 1}\n')
    storage.write_text(spark, path, '{"é": 2}\n')
    assert storage.read_text(spark, path) == '{"é": 2}\n'
    assert storage.finished(spark, str(tmp_path / "none"), "x=") == {}
