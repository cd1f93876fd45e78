"""Working tables of a stage go when the next one begins, and not before."""

from pathlib import Path

from reelhouse.llm import common


def test_working_tables_go_with_the_next_stage(spark, tmp_path, monkeypatch):
    names = iter(range(100))
    monkeypatch.setattr(common, "shared_folder", lambda s, purpose: f"{tmp_path}/{purpose}-{next(names)}")
    first = common.stage(lambda s, docs, _: common.kept(docs.filter("id > 2"), "a"))
    second = common.stage(lambda s, docs, _: common.kept(docs.filter("id > 4"), "b"))
    outside = common.kept(spark.range(3), "c")
    found = first(spark, spark.range(9), "")
    [folder] = Path(tmp_path).glob("a-*")
    assert second(spark, found, "").count() == 4 and folder.exists()  # read unwritten: its table stays
    found.write.parquet(str(tmp_path / "out"))
    assert second(spark, spark.read.parquet(str(tmp_path / "out")), "").count() == 4
    assert not folder.exists()
    assert len(list(Path(tmp_path).glob("b-*"))) == 1
    assert outside.count() == 3  # what no stage has kept is left alone
