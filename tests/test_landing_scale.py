"""Landings: enough tasks, and each message worked out once."""

from pyspark.sql import functions as F

from tidemark.functions.cdc import landed_rows, parse_changes, to_message
from tidemark.sources.topics import spread


def test_few_partitions_are_spread_over_several_tasks_a_core(spark):
    cores = spark.sparkContext.defaultParallelism
    assert spread(spark.range(1000).coalesce(1)).rdd.getNumPartitions() >= 4 * cores
    assert spread(spark.range(1000).repartition(cores + 1)).rdd.getNumPartitions() >= 4 * cores


def test_no_filter_repeats_the_decoding_of_messages(spark):
    messages = spark.createDataFrame([('{"payload":{"op":"c"}}',)], "value STRING")
    landed = landed_rows(parse_changes(messages, "order_items"))
    plan = landed._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert filters and not any("conv(" in line for line in filters)
