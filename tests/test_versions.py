"""Tables that are replaced while they are read."""

import threading

import pytest

from cartmill.sources import versions


def rows(spark, n):
    return spark.range(n).withColumnRenamed("id", "n")


def test_readers_see_the_old_rows_or_the_new(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.replace(rows(spark, 10), path)
    seen, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            seen.append(spark.read.schema("n long").parquet(versions.current(spark, path)).count())

    reader = threading.Thread(target=read)
    reader.start()
    for n in (20, 30, 40):
        versions.replace(rows(spark, n).repartition(3), path)
    stop.set()
    reader.join()
    assert set(seen) <= {10, 20, 30, 40} and seen == sorted(seen)


def test_the_version_before_stays_for_readers_that_have_begun(spark, tmp_path):
    path = str(tmp_path / "t")
    folders = [versions.replace(rows(spark, n), path) for n in (1, 2)]
    before = spark.read.parquet(folders[0])
    assert before.count() == 1
    versions.replace(rows(spark, 3), path)
    assert spark.read.parquet(folders[1]).count() == 2
    assert sorted(p.name for p in (tmp_path / "t").iterdir())[0] == folders[1].rsplit("/", 1)[1]


def test_a_version_that_broke_off_is_never_seen(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.replace(rows(spark, 5), path)
    rows(spark, 0).write.parquet(f"{path}/v000000002-0badbad0")
    assert spark.read.parquet(versions.current(spark, path)).count() == 5
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        versions.replace(rows(spark, 5).selectExpr("1 div (n - 3) AS n"), path)
    assert spark.read.parquet(versions.current(spark, path)).count() == 5
    versions.replace(rows(spark, 7), path)
    assert spark.read.parquet(versions.current(spark, path)).count() == 7


def test_rows_of_the_table_itself_and_tables_from_before_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    rows(spark, 4).write.parquet(path)
    assert versions.current(spark, path) == path
    versions.replace(spark.read.parquet(path).where("n > 0"), path)
    versions.replace(spark.read.parquet(versions.current(spark, path)).where("n > 1"), path)
    assert spark.read.parquet(versions.current(spark, path)).count() == 2
    assert not list((tmp_path / "t").glob("part-*"))
