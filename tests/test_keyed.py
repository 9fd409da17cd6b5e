import random

import pytest
from conftest import dicts

from rosterloom.sources import keyed
from rosterloom.sources.scratch import fresh_database

SCHEMA = "id int, `sub id` string, n int, at int"


@pytest.fixture
def name(spark):
    return f"{fresh_database(spark, 'keyed')}.kept"


def held(spark, name):
    return sorted((tuple(r) for r in spark.table(name).select("id", "sub id", "n", "at").collect()), key=str)


def test_changes_by_key_equal_a_dictionary(spark, name):
    """Five changes and a deletion, null keys among them, against a dictionary."""
    random.seed(4)
    key, expected = ["id", "sub id"], {}
    for step in range(5):
        rows = [(random.choice([None, 1, 2, 3, 4]), random.choice([None, "a", "b"]), random.randrange(9), random.randrange(3))
                for _ in range(12)]
        keyed.upsert(spark, name, spark.createDataFrame(rows, SCHEMA).repartition(3), key, ["at"])
        best = {}
        for row in rows:
            best[row[:2]] = max(best.get(row[:2], row), row, key=lambda r: (r[3], r[2]))
        expected |= best
        assert held(spark, name) == sorted(expected.values(), key=str)
    gone = [(None, "a"), (2, "b"), (2, "b"), (9, "a")]
    keyed.delete(spark, name, spark.createDataFrame(gone, "id int, `sub id` string"), key)
    assert held(spark, name) == sorted((r for k, r in expected.items() if k not in gone), key=str)


def test_a_reader_keeps_its_version_and_old_ones_go(spark, name):
    one = spark.createDataFrame([(1, "a", 1, 1)], SCHEMA)
    assert keyed.current_version(spark, name) == 0 and keyed.upsert(spark, name, one, ["id"]) == 1
    reader = spark.table(name)
    keyed.upsert(spark, name, one.selectExpr("id", "`sub id`", "n + 1 AS n", "at"), ["id"])
    assert reader.first()["n"] == 1 and spark.table(name).first()["n"] == 2
    keyed.upsert(spark, name, one, ["id"])
    tables = {t.name for t in spark.catalog.listTables(name.partition(".")[0])}
    assert tables == {"kept", "kept__v2", "kept__v3"}


def test_a_failed_or_late_change_leaves_the_table(spark, name):
    one = spark.createDataFrame([(1, "a", 1, 1)], SCHEMA)
    keyed.upsert(spark, name, one, ["id"])
    broken = one.selectExpr("raise_error('boom') AS id", "`sub id`", "n", "at")
    with pytest.raises(Exception, match="boom"):
        keyed.upsert(spark, name, broken.selectExpr("CAST(id AS int) AS id", "`sub id`", "n", "at"), ["n"])
    assert held(spark, name) == [(1, "a", 1, 1)]
    with pytest.raises(keyed.ConcurrentChange):
        keyed._swap(spark, name, one, 0)
    assert keyed.upsert(spark, name, one, ["id"]) > 1 and held(spark, name) == [(1, "a", 1, 1)]
    with pytest.raises(ValueError):
        keyed.upsert(spark, name, one.drop("n"), ["id"])
    with pytest.raises(ValueError):
        keyed.delete(spark, f"{name}_none", one, ["id"])
    assert dicts(spark.table(name))


def test_an_empty_change_changes_nothing(spark, name):
    none = spark.createDataFrame([], SCHEMA)
    keyed.upsert(spark, name, none, ["id"])
    assert held(spark, name) == []
    keyed.upsert(spark, name, spark.createDataFrame([(1, None, None, 1)], SCHEMA), ["id"])
    keyed.upsert(spark, name, none, ["id"])
    assert held(spark, name) == [(1, None, None, 1)]
