"""Session settings that queries bring along."""

from conftest import SMALL

from rosterloom.registry import all_queries
from rosterloom.session import METHOD_LIMIT, limit_methods, setting


def test_queries_keep_generated_methods_small_enough_to_be_compiled(spark):
    key, limit = METHOD_LIMIT
    with setting(spark, key, "65535"):
        frame = all_queries()["b7_stg_payroll_main"](spark, SMALL)
        assert spark.conf.get(key) == limit
        assert frame.count() > 0


def test_a_limit_that_was_set_stays(spark):
    key, _ = METHOD_LIMIT
    with setting(spark, key, "4000"):
        limit_methods(spark)
        assert spark.conf.get(key) == "4000"
