"""Batch shuffles start with partitions for each core, so that a task's memory does not grow with the input."""

import re

from lyceum.queries import catalog
from lyceum.session import FIRST_PARTITIONS, PARTITION_SIZE, prepare


def test_batch_shuffles_start_with_many_partitions(spark):
    for name in ("details_default_version", "dws_trade_subject_user_order_window"):
        plan = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        found = re.findall(r"hashpartitioning\(.*?, (\d+)\)", plan)
        assert found and set(found) == {str(32 * spark.sparkContext.defaultParallelism)}
    # What other queries get is not changed by it, nor what the session chose.
    prepare(spark)
    assert FIRST_PARTITIONS not in spark.conf.getAll and PARTITION_SIZE not in spark.conf.getAll
    spark.conf.set(PARTITION_SIZE, "48m")
    catalog.QUERIES["details_default_version"](spark, "/root/testdata/sf0.001")
    prepare(spark)
    assert spark.conf.get(PARTITION_SIZE) == "48m"
    spark.conf.unset(PARTITION_SIZE)
