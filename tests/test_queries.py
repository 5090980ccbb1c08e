"""Every registered query against its SQL, and the shape of some plans."""

import sys
from pathlib import Path

import pytest
from compare import connect, differences

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as driver  # noqa: E402

# The text operators have tests of their own.
QUERIES = {n: q for n, q in driver.queries().items() if n not in driver.text_queries}
ORACLES = driver.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) - set(driver.text_oracles)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, sf_dir, con, name):
    assert differences(QUERIES[name](spark, sf_dir), con, ORACLES[name]) == ""


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns and df.limit(1).count() == 1


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_versions_take_one_shuffle(spark, sf_dir):
    assert plan(QUERIES["dim_orders"](spark, sf_dir)).count("Exchange hashpartitioning") == 1
    assert plan(QUERIES["scd2_changelog_events"](spark, sf_dir)).count(
        "Exchange hashpartitioning") == 1


def test_fact_reads_only_its_columns(spark, sf_dir):
    text = plan(QUERIES["fact_order_items"](spark, sf_dir))
    assert "p_name" not in text and "c_name" not in text and "l_tax" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream") and n != "dim_orders_merged"))
def test_no_pairs_of_all_rows(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_constraints_read_each_table_once(spark, sf_dir):
    text = plan(QUERIES["dq_constraints"](spark, sf_dir))
    assert text.count("FileScan") == 9 and text.count("Exchange") == 2
    assert "SortAggregate" not in text


def test_delivery_counts_each_shipment_once(spark, sf_dir):
    counted = QUERIES["delivery_time_by_service"](spark, sf_dir).agg({"shipments": "sum"}).first()[0]
    facts = QUERIES["fact_shipment_events"](spark, sf_dir)
    assert counted == facts.select("shipmentId").distinct().count()


def test_stream_reads_files_and_directories(spark, sf_dir, tmp_path):
    from tidemark.bindings.feeds import stream_table, table

    table(spark, sf_dir, "nation").repartition(3).write.parquet(f"{tmp_path}/nation.parquet")
    for k, place in enumerate((sf_dir, str(tmp_path))):
        query = stream_table(spark, place, "nation").writeStream.format("memory").queryName(
            f"nations{k}").start()
        query.processAllAvailable()
        query.stop()
        assert spark.table(f"nations{k}").count() == table(spark, place, "nation").count()
