"""Committed writes: stopped, repeated, replacing and empty ones."""

import pytest

from cadenza.sources import commits


def rows(spark, *ids):
    return spark.createDataFrame([(i, f"g{i % 2}") for i in ids], "i int, g string")


def ids(spark, path):
    return sorted(r["i"] for r in commits.read(spark, path).collect())


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_appends_and_overwrites(spark, tmp_path, fmt):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        commits.read(spark, path)
    assert commits.write(rows(spark, 1, 2), path, "a", fmt=fmt)
    assert commits.write(rows(spark, 3), path, "b", fmt=fmt)
    assert not commits.write(rows(spark, 1, 2), path, "a", fmt=fmt)         # a retried batch
    assert ids(spark, path) == [1, 2, 3]
    before = commits.read(spark, path)
    assert commits.write(rows(spark, 9), path, "c", mode="overwrite", fmt=fmt)
    assert ids(spark, path) == [9]
    assert before.count() == 3                                              # an old reader goes on
    assert not commits.write(rows(spark, 3), path, "b", fmt=fmt)            # replaced, but known
    assert ids(spark, path) == [9]


def test_a_stopped_write_is_not_seen(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    commits.write(rows(spark, 1), path, "a")
    # stopped while rows are written
    bad = rows(spark, 2).selectExpr("i", "case when i = 2 then raise_error('killed') else g end as g")
    with pytest.raises(Exception, match="killed"):
        commits.write(bad, path, "b", mode="overwrite")
    assert ids(spark, path) == [1]
    # stopped between the rows and the commit
    real = commits._folder
    monkeypatch.setattr(commits, "_folder", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        commits.write(rows(spark, 2), path, "b")
    monkeypatch.setattr(commits, "_folder", real)
    assert ids(spark, path) == [1]
    # stopped while the manifest is written: its folder has no finished file
    (tmp_path / "t" / "commits" / "000000000002" / "_temporary").mkdir(parents=True)
    (tmp_path / "t" / "commits" / "000000000002" / "_temporary" / "part.json").write_text('{"version": 2, "live"')
    assert ids(spark, path) == [1]


def test_two_writers_from_one_manifest(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    commits.write(rows(spark, 1), path, "a")
    old = commits.manifest(spark, path)
    commits.write(rows(spark, 2), path, "b")
    monkeypatch.setattr(commits, "manifest", lambda *a: old)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        commits.write(rows(spark, 3), path, "c")
    monkeypatch.undo()
    assert ids(spark, path) == [1, 2]


def test_empty_writes_and_new_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not commits.write(rows(spark).limit(0), path, "none")
    assert commits.manifest(spark, path) == []
    assert commits.write(rows(spark, 1), path, "a", partition_by=["g"])
    assert commits.write(rows(spark, 2).selectExpr("i", "i * 2 as k"), path, "b")
    got = {r["i"]: r for r in commits.read(spark, path).collect()}
    assert got[1]["g"] == "g1" and got[1]["k"] is None and got[2]["k"] == 4 and got[2]["g"] is None
    assert commits.write(rows(spark).limit(0), path, "clear", mode="overwrite", allow_empty=True)
    assert commits.read(spark, path).count() == 0
