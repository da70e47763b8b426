"""Steps that many queries share do their work once a row, and in bounded numbers of tasks."""

import re
from datetime import date

import pytest
from conftest import SMALL

from cartmill.plans.catalog import QUERIES
from cartmill.sources import bronze, documents, tables


def _plan(rows):
    return rows._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("read,most", [(bronze.products, 6), (bronze.users, 14), (bronze.carts, 7)])
def test_members_of_elements_are_read_once(spark, read, most):
    elements = spark.createDataFrame([("d", 0, 0, "{}")], bronze.SCHEMA)
    assert _plan(read(elements)).count("try_variant_get(") <= most


@pytest.mark.parametrize("name", ["bronze_roundtrip", "bronze_documents_roundtrip", "reject_values"])
def test_checks_are_not_pushed_into_parsing(spark, name):
    assert "variant" not in _plan(QUERIES[name](spark, SMALL))


def test_small_ranges_share_a_task(spark, tmp_path):
    tables.table(spark, SMALL, "orders").selectExpr("concat('[', o_orderkey, ']') AS value").repartition(200).write.text(str(tmp_path / "x"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        found = documents._pieces(spark, str(tmp_path / "x"))
        assert found.rdd.getNumPartitions() == 3 * spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


#: The JVM runs larger methods without compiling them.
COMPILED = 8000


@pytest.fixture
def planned_at_once(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def _method_sizes(rows, capsys):
    rows.explain("codegen")
    return [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]


def test_reading_carts_is_compiled(spark, planned_at_once, tmp_path, capsys):
    spark.createDataFrame([("d", 0, 0, "{}")], bronze.SCHEMA).write.parquet(str(tmp_path / "x"))
    sizes = _method_sizes(bronze.carts(spark.read.schema(bronze.SCHEMA).parquet(str(tmp_path / "x"))), capsys)
    assert sizes and max(sizes) < COMPILED


def test_making_users_is_compiled(spark, planned_at_once, capsys):
    sizes = _method_sizes(tables.user_elements(spark, SMALL, faulty=True), capsys)
    assert sizes and max(sizes) < COMPILED


PLAIN = '{"id":5,"userId":7,"date":"2024-01-05T01:00:00+05:00","products":[{"productId":3,"quantity":2},{"quantity":1}]}'
READ_OTHERWISE = [
    PLAIN.replace('"id":5', '"id":"5"'),
    PLAIN.replace('"userId":7', '"userId":7.0'),
    PLAIN.replace("2024-01-05T01:00:00+05:00", "1/5/2024"),
    PLAIN.replace("2024-01-05T01:00:00+05:00", "Fri, 5 Jan 2024 10:00 pm"),
    PLAIN.replace('"quantity":1', '"x":[1]'),
]


def test_carts_read_either_way_are_equal(spark):
    elements = spark.createDataFrame([("d", 0, n, body) for n, body in enumerate([PLAIN, *READ_OTHERWISE])], bronze.SCHEMA)
    found = {}
    for row in bronze.carts(elements).collect():
        found.setdefault(row["pos"], []).append(tuple(row)[3:])
    assert len(found[0]) == 2 and all(rows == found[0] for rows in found.values())
    assert found[0][0][:5] == (5, 7, date(2024, 1, 5), 3, 2) and found[0][1][3:5] == (None, 1)


@pytest.mark.parametrize(
    "body,reasons",
    [
        (PLAIN.replace('"', "'"), "not JSON"),
        (PLAIN[:-1] + ',"x":NaN}', "not JSON"),
        (PLAIN.replace("2024-01-05", "2024-02-30"), "date: not a date"),
        (PLAIN.replace('"date"', '"day"'), "date: missing"),
    ],
)
def test_carts_that_are_no_strict_json_or_undated_are_kept(spark, body, reasons):
    rows = bronze.carts(spark.createDataFrame([("d", 0, 0, body)], bronze.SCHEMA)).collect()
    assert [(r["reason"], r["unreadable"], r["has_item"]) for r in rows] == [(reasons, body, False)]


def test_items_that_fit_no_type_keep_their_fault(spark):
    body = PLAIN.replace('"quantity":1', '"quantity":null').replace('"quantity":2', '"quantity":2.5')
    rows = bronze.carts(spark.createDataFrame([("d", 0, 0, body)], bronze.SCHEMA)).orderBy("nth").collect()
    assert [(r["quantity"], r["_faults"], r["_raw"]) for r in rows] == [
        (None, ["quantity: not a whole number"], '{"productId":3,"quantity":2.5}'),
        (None, None, None),
    ]


def test_independent_steps_run_at_once(spark):
    """Each waits for the other to have begun; an error comes when both have ended."""
    import threading

    from cartmill.session import at_once

    met, ended = threading.Barrier(2, timeout=20), []

    def step(n):
        met.wait()
        ended.append(n)
        return n

    assert at_once(lambda: step(1), lambda: step(2)) == [1, 2] and at_once() == []
    with pytest.raises(ZeroDivisionError):
        at_once(lambda: 1 // 0, lambda: ended.append(3))
    assert sorted(ended) == [1, 2, 3]
