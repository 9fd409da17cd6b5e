"""The queries that have SQL, against it."""

import duckdb
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from checks.compare import connect, differences
from rosterloom.llm.queries import llm_queries, llm_sql

LARGER = SMALL.replace("0.001", "0.01")


@pytest.mark.parametrize("name", sorted(llm_sql()))
def test_query_equals_sql(spark, name):
    assert differences(llm_queries()[name](spark, LARGER), connect(LARGER), llm_sql()[name]) is None


def test_one_query_per_operator():
    assert [int(n[2:].split("_")[0]) for n in llm_queries()] == list(range(1, 14))


def test_quality_equals_sql_with_more_languages(spark, tmp_path):
    """A language without a word list, one with too few documents for a reference, and none at all."""
    number = F.pmod(F.xxhash64("doc_id"), F.lit(10))
    lang = F.when(number < 2, "xx").when(F.col("doc_id") % 97 == 0, "rare").when(number != 9, F.col("lang"))
    spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("lang", lang).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    found = llm_queries()["op5_quality_rules"](spark, str(tmp_path))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert found.where("class_distance IS NOT NULL").count() and differences(found, connection, llm_sql()["op5_quality_rules"]) is None
