"""Updates that rewrite only the files they touch."""

import pytest
from pyspark.sql import functions as F

from plotloom.sources import versions as V

SCHEMA = "id int, name string, parent int"


def table_of(spark, path, rows=2000, files=20):
    frame = spark.range(rows).select(F.col("id").cast("int"), F.concat(F.lit("n"), "id").alias("name"), F.lit(0).alias("parent"))
    V.create(frame.repartitionByRange(files, "id"), path)
    return path


def updates(spark, *pairs):
    return spark.createDataFrame(list(pairs), "id int, parent int")


def test_only_files_that_hold_the_keys_are_written(spark, tmp_path):
    path = table_of(spark, str(tmp_path / "a table +1"))
    before = set(V.files(spark, path))
    new = V.update(spark, path, "one", updates(spark, (5, 9), (7, None), (99_999, 1)), "id", "parent")
    after = set(V.files(spark, path))
    assert len(before) == 20 and len(before - after) == 1 and after - before == set(new)
    got = {r["id"]: r["parent"] for r in V.read(spark, path).collect()}
    assert len(got) == 2000 and got[5] == 9 and got[7] is None and all(v == 0 for k, v in got.items() if k not in (5, 7))


def test_run_again_and_after_a_kill(spark, tmp_path, monkeypatch):
    path = table_of(spark, str(tmp_path), 100, 4)
    change = updates(spark, (3, 1), (90, 2))
    with monkeypatch.context() as patch:
        patch.setattr(V, "_commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            V.update(spark, path, "x", change, "id", "parent")
    assert V.read(spark, path).where("parent <> 0").count() == 0
    assert len(V.update(spark, path, "x", change, "id", "parent")) >= 1
    first = sorted(V.read(spark, path).collect())
    assert V.update(spark, path, "x", change, "id", "parent") == []
    assert sorted(V.read(spark, path).collect()) == first
    assert [r["parent"] for r in first if r["parent"]] == [1, 2]


def test_no_stored_key_writes_nothing(spark, tmp_path):
    path = table_of(spark, str(tmp_path), 10, 2)
    before = V.files(spark, path)
    assert V.update(spark, path, "none", updates(spark, (77, 1)), "id", "parent") == []
    assert V.files(spark, path) == before


def test_null_and_repeated_keys(spark, tmp_path):
    frame = spark.createDataFrame([(None, "a", 0), (None, "b", 0), (1, "c", 0), (1, "d", 0), (2, "e", 0)], SCHEMA)
    V.create(frame.repartition(3), str(tmp_path))
    V.update(spark, str(tmp_path), "u", updates(spark, (None, 5), (1, 6)), "id", "parent")
    got = sorted((r["name"], r["parent"]) for r in V.read(spark, str(tmp_path)).collect())
    assert got == [("a", 5), ("b", 5), ("c", 6), ("d", 6), ("e", 0)]


def test_two_writers_of_one_version(spark, tmp_path):
    path = table_of(spark, str(tmp_path), 10, 2)
    V._commit(spark, path, 1, "other", V.files(spark, path))
    with pytest.raises(Exception, match="already exists"):
        V._commit(spark, path, 1, "mine", V.files(spark, path))
