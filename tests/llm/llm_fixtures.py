import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session", autouse=True)
def folder(spark, tmp_path_factory):
    """Written tables of these tests go to a folder of their own."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("written")))
    return spark.conf.get("spark.checkpoint.dir")


@pytest.fixture
def docs(spark):
    """Rows of (doc_id, text) with columns that clash with working and result names."""

    def make(texts, **columns):
        rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        extra = {"slot": "1", "SHARD": "'x'", "node": "2", "page": "3", "n": "4", "id": "5", "__key": "6", "map": "map('a', 1)"}
        return rows.selectExpr("*", *[f"{v} AS `{k}`" for k, v in {**extra, **columns}.items()])

    return make
