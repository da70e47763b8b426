"""What queries leave on disk while they run."""

import glob
from datetime import date
from urllib.parse import urlparse

from conftest import SMALL
from pyspark.sql import functions as F

from cartmill.operators import partials
from cartmill.plans import catalog
from cartmill.session import CLEANUP, shuffles_dropped
from cartmill.sources import silver


def test_line_keys_leave_one_lake(spark, monkeypatch):
    """Lakes and tables that have been read for the last time are gone; the last one is read by the result."""
    lakes = []
    plain = catalog.work_folder

    def noted(session):
        lakes.append(plain(session))
        return lakes[-1]

    monkeypatch.setattr(catalog, "work_folder", noted)
    found = {r["loaded_by"]: r for r in catalog.QUERIES["line_key_unique"](spark, SMALL).collect()}
    assert found["run"]["lines"] == found["run"]["line_keys"] > found["file"]["lines"] == found["file"]["line_keys"] > 0
    assert len(lakes) == 3
    kept = [lake for lake in lakes if glob.glob(f"{urlparse(lake).path}/**/*.parquet", recursive=True)]
    assert len(kept) == 1 and not glob.glob(f"{urlparse(kept[0]).path}/bronze/**/*.parquet", recursive=True)


def test_numbers_counted_by_words(spark):
    numbers = [0, 63, 64, 64, -1, -64, -65, (1 << 63) - 1, -(1 << 63), 7 << 33, None, None]
    rows = spark.createDataFrame([(n,) for n in numbers], "n long")
    for part in (rows, rows.where("n > 60"), rows.where("n IS NULL"), rows.where("false")):
        counted = partials.count_numbers(part, "n", F.lit("x").alias("by"))
        expected = part.agg(F.lit("x"), F.count(F.lit(1)), F.count_distinct("n"), F.count_if(F.col("n").isNull()))
        assert [tuple(r) for r in counted.collect()] == [tuple(r) for r in expected.collect()]
        assert [t for _, t in counted.dtypes] == [t for _, t in expected.dtypes]


def test_shuffles_of_writes_go(spark, lake, monkeypatch):
    """The setting holds while silver is written, and is as it was after, also of writes within each other."""
    before, seen = spark.conf.get(CLEANUP, None), []
    plain = type(spark.range(1).write).parquet
    monkeypatch.setattr(type(spark.range(1).write), "parquet", lambda self, *a, **k: (seen.append(spark.conf.get(CLEANUP)), plain(self, *a, **k))[1])
    with shuffles_dropped(spark):
        silver.write(spark.range(5).groupBy("id").count(), lake, "numbers", date(2024, 1, 5))
        assert spark.conf.get(CLEANUP) == "true"
    assert seen == ["true"] and spark.conf.get(CLEANUP, None) == before
