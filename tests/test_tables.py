"""Merges, quality rules, and the pipelines from messages to facts."""

import time

import pytest
from pyspark.sql import functions as F

from tidemark.bindings import feeds
from tidemark.catalog import DIMENSIONS, FACTS, SOURCES, landing_schema
from tidemark.config import END_OF_TIME as END
from tidemark.config import Settings, scratch_dir
from tidemark.functions.cdc import to_message
from tidemark.operators import quality
from tidemark.operators.scd2 import as_changelog, consolidate, consolidate_in_windows, current
from tidemark.operators.upsert import new_rows, upsert_versions
from tidemark.plans import dimensions, facts, rebuild
from tidemark.plans.dimensions import to_warehouse
from tidemark.sources.sinks import append_new, exists
from tidemark.sources.topics import read_landing, read_rows
from tidemark.sources.versions import compact, manifest, merge_versions, read_versions, vacuum
from tidemark.streaming import jobs
from tidemark.streaming.operators import stream_changelog

DIM = "sk STRING, name STRING, validFrom BIGINT, validTo BIGINT"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_overwrites_only_the_end(spark):
    target = spark.createDataFrame([("a", "old", 1, END), ("b", "kept", 1, 5)], DIM)
    changes = spark.createDataFrame(
        [("a", "new", 1, 9), ("c", "x", 3, END), ("c", "x", 3, 7), ("c", "x", 3, 7)], DIM)
    assert rows(upsert_versions(target, changes, "sk")) == [
        ("a", "old", 1, 9), ("b", "kept", 1, 5), ("c", "x", 3, 7)]


def test_insert_or_ignore(spark):
    held = spark.createDataFrame([("a", 1)], "sk STRING, n INT")
    more = spark.createDataFrame([("a", 2), ("b", 3), ("b", 3)], "sk STRING, n INT")
    assert rows(new_rows(held, more, "sk")) == [("b", 3)]


def test_append_new(spark, tmp_path):
    path = str(tmp_path / "facts")
    first = spark.createDataFrame([("a", 1), ("a", 1)], "sk STRING, n INT")
    append_new(first, path, "sk")
    append_new(first.unionByName(spark.createDataFrame([("b", 2)], first.schema)), path, "sk")
    assert rows(spark.read.parquet(path)) == [("a", 1), ("b", 2)]
    append_new(spark.createDataFrame([("b", 2), ("c", 3)], first.schema), path, "sk",
               time_column="n")
    assert rows(spark.read.parquet(path)) == [("a", 1), ("b", 2), ("c", 3)]


def test_version_table_merges(spark, tmp_path):
    path = str(tmp_path / "dim")

    def df(*data):
        return spark.createDataFrame(list(data), DIM)

    schema = df(("x", "x", 1, 1)).schema
    assert read_versions(spark, path, schema, "sk").count() == 0
    merge_versions(df(("a", "n", 1, END), ("b", "m", 2, END)), path, "sk")
    merge_versions(df(("a", "n", 1, 9), ("c", "n", 10, END)), path, "sk")
    expected = [("a", "n", 1, 9), ("b", "m", 2, END), ("c", "n", 10, END)]
    assert rows(read_versions(spark, path, schema, "sk")) == expected
    # A repeated batch, and messages delivered again, change nothing.
    merge_versions(df(("z", "z", 1, END)), path, "sk", number=1)
    merge_versions(df(("a", "n", 1, END), ("a", "n", 1, 9)), path, "sk")
    assert rows(read_versions(spark, path, schema, "sk")) == expected


def test_version_table_commits(spark, tmp_path):
    path, stream = str(tmp_path / "dim"), "sql.streaming.queryId"
    context = spark.sparkContext

    def df(*data):
        return spark.createDataFrame(list(data), DIM)

    schema, expected = df(("x", "x", 1, 1)).schema, {}
    context.setLocalProperty(stream, "first")
    try:
        for n in range(6):
            opened = [(f"{n}-{i}", "v", n, END) for i in range(5)]
            ended = [(f"{n - 1}-{i}", "v", n - 1, n + 9) for i in range(5)] if n else []
            expected.update({r[0]: r for r in ended + opened})
            for _ in range(2):  # every batch comes twice
                merge_versions(df(*ended, *opened), path, "sk", number=n, buckets=8, compact_from=None)
        assert manifest(spark, path).number == 5
        assert rows(read_versions(spark, path, schema, "sk")) == sorted(expected.values())
        # A new checkpoint starts from 0 with another id: nothing is taken for a repetition.
        context.setLocalProperty(stream, "second")
        merge_versions(df(("new", "v", 1, END)), path, "sk", number=0)
        expected["new"] = ("new", "v", 1, END)
    finally:
        context.setLocalProperty(stream, None)
    before = manifest(spark, path)
    assert before.buckets == 8 and before.merged == {"first": 5, "second": 0}
    # One key touches one bucket; the others' open files stay where they were.
    merge_versions(df(("new", "v", 1, 4)), path, "sk", compact_from=None)
    expected["new"] = ("new", "v", 1, 4)
    after = manifest(spark, path)
    assert sum(after.opened.get(b) != c for b, c in before.opened.items()) == 1
    # A reader that began before a compaction finishes on its own files.
    reader = read_versions(spark, path, schema, "sk")
    compact(spark, path, schema, "sk")
    assert len(manifest(spark, path).closed) < len(after.closed)
    assert rows(reader) == sorted(expected.values())
    vacuum(spark, path, keep=1)
    assert rows(read_versions(spark, path, schema, "sk")) == sorted(expected.values())
    merge_versions(spark.createDataFrame([], schema), path, "sk")  # an empty batch
    assert rows(read_versions(spark, path, schema, "sk")) == sorted(expected.values())


def test_version_table_keeps_every_column(spark, tmp_path):
    """Columns that are named like parts of the table's layout come back as they were."""
    schema = "sk STRING, state STRING, bucket INT, number INT, validFrom BIGINT, validTo BIGINT"
    data = [("a", "Ohio", 7, 1, 1, 5), ("b", None, None, 2, 1, END)]
    path, held = str(tmp_path / "dim"), spark.createDataFrame(data, schema)
    merge_versions(held, path, "sk")
    merge_versions(held, path, "sk")
    compact(spark, path, held.schema, "sk")
    assert read_versions(spark, path, held.schema, "sk").orderBy("sk").collect() == held.collect()


def test_manifest_has_one_writer(spark, tmp_path, monkeypatch):
    from tidemark.sources import versions
    path = str(tmp_path / "dim")
    one = spark.createDataFrame([("a", "n", 1, END)], DIM)
    merge_versions(one, path, "sk")
    monkeypatch.setattr(versions, "manifest", lambda *_: versions.Manifest())
    with pytest.raises(RuntimeError, match="another writer"):
        merge_versions(one, path, "sk")
    monkeypatch.undo()
    assert rows(read_versions(spark, path, one.schema, "sk")) == [("a", "n", 1, END)]


def test_warehouse_types(spark, sf_dir):
    services = dimensions.d_carrier_services(feeds.landed(spark, sf_dir, "shipping_services"),
                                             feeds.landed(spark, sf_dir, "carriers"))
    stored = to_warehouse(services, DIMENSIONS["carrier_services"].warehouse_schema)
    assert dict(stored.dtypes)["serviceId"] == "string"
    orders = DIMENSIONS["orders"].warehouse_schema
    assert "customerId" not in orders.fieldNames()


def test_quality_rules_find_what_is_wrong(spark):
    items = spark.sql(
        "SELECT * FROM VALUES (1L, 1L, 1L, 0, 1.0BD, 0.1BD), (2L, 1L, 1L, 2, -1.0BD, -0.1BD), "
        "(3L, 9L, 2L, 1, 1.0BD, 0BD) "
        "AS t(order_item_id, order_id, book_id, quantity, price_at_purchase, discount)")
    orders = spark.sql("SELECT 1L order_id, 5L customer_id, 'lost' status")
    report = {r["rule"]: r["violations"] for r in quality.constraint_report(
        {"order_items": items, "orders": orders}).collect()}
    assert report == {
        "orders.status_unknown": 1, "order_items.quantity_not_positive": 1,
        "order_items.price_negative": 1, "order_items.discount_negative": 1,
        "order_items.order_id+book_id_not_unique": 1,
        "order_items.order_id_without_orders": 1}
    # NULL refers to nothing and equals nothing; an empty parent leaves every key without one.
    empty = quality.constraint_report({"order_items": spark.sql(
        "SELECT id AS order_item_id, CAST(NULL AS BIGINT) AS order_id, 7L AS book_id, 1 AS quantity, "
        "1.0BD AS price_at_purchase, 0BD AS discount FROM range(5)"), "orders": orders.limit(0),
        "books": spark.sql("SELECT 7L book_id, 3L author_id, 'i' isbn, 1BD price, 1 stock UNION ALL "
                           "SELECT 8L, 3L, 'i', -1BD, NULL")})
    assert {r["rule"]: r["violations"] for r in empty.where("violations > 0").collect()} == {
        "books.price_negative": 1, "books.isbn_not_unique": 1}
    assert empty.count() == 10
    broken = quality.invalid_rows(items, "order_items").collect()
    assert sorted((r["order_item_id"], tuple(r["broken"])) for r in broken) == [
        (1, ("quantity_not_positive",)), (2, ("price_negative", "discount_negative"))]


@pytest.mark.parametrize("rows_per_cut", [None, 1])
def test_transitions(spark, rows_per_cut):
    data = [(1, "created", 1), (1, "in_transit", 2), (1, "delivered", 3), (1, "created", 4),
            (2, "created", 1), (2, "created", 2), (2, "delivered", 3)]
    df = spark.createDataFrame(data, "shipment_id INT, shipping_status STRING, ts_ms BIGINT")
    options = {} if rows_per_cut is None else {"rows_per_cut": rows_per_cut}
    assert rows(quality.invalid_transitions(df, **options)) == [
        (1, 4, "delivered", "created"), (2, 3, "created", "delivered")]


def test_settings_name_datasets(monkeypatch):
    assert Settings(environment="dev", root="/r").dataset("a.b") == "/r/a.b.dev"
    monkeypatch.setenv("ENVIRONMENT", "prod")
    assert Settings(root="/r").dataset("a.b") == "/r/a.b.prod"
    monkeypatch.delenv("ENVIRONMENT")
    assert Settings(root="/r").dataset("a.b") == "/r/a.b"


def test_scratch_is_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_dir(spark, "x")
    assert path != scratch_dir(spark, "x")
    assert shared is None or path.startswith(shared)


@pytest.fixture(scope="module")
def topics(spark, sf_dir, tmp_path_factory):
    """Source topics as directories of messages, with bad messages among them."""
    root = str(tmp_path_factory.mktemp("topics"))
    for table, source in SOURCES.items():
        messages = to_message(feeds.landed(spark, sf_dir, table, whole_text=True), table)
        messages = messages.unionByName(
            spark.createDataFrame([("{broken",)], "value STRING")).coalesce(2)
        messages.write.text(f"{root}/{source.topic}")
    return root


def expected_star(spark, sf_dir):
    landed = {t: feeds.landed(spark, sf_dir, t) for t in SOURCES}
    star = {
        "orders": dimensions.d_orders(landed["orders"]),
        "customers": dimensions.d_customers(landed["customers"]),
        "books": dimensions.d_books(landed["books"], landed["authors"]),
        "carrier_services": dimensions.d_carrier_services(
            landed["shipping_services"], landed["carriers"]),
    }
    star["order_items"] = facts.f_order_items(
        landed["order_items"], star["orders"], star["customers"], star["books"])
    star["shipment_events"] = facts.f_shipment_events(
        landed["shipment_events"], landed["shipments"], star["orders"], star["carrier_services"])
    return star


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_rebuild_from_messages(spark, sf_dir, topics):
    settings = Settings(environment="test", root=topics)
    rebuild.rebuild(spark, settings)
    expected = expected_star(spark, sf_dir)
    for name in DIMENSIONS:
        assert same(expected[name], rebuild.built_dimension(spark, name, settings)), name
    for name, fact in FACTS.items():
        stored = spark.read.parquet(settings.dataset(fact.topic))
        assert stored.count() > 0
        assert same(expected[name], stored), name
    rejected = spark.read.parquet(settings.dataset(SOURCES["orders"].landing) + ".rejected")
    assert [r["raw"] for r in rejected.collect()] == ["{broken"]


def test_streams_give_what_the_rebuild_gives(spark, sf_dir, topics, tmp_path):
    """Landing, joined feed, changelog, dimension table and fact, each as a stream."""
    settings = Settings(environment=f"s{tmp_path.name}", root=topics, buffer_ms=0,
                        source_lateness="0 seconds")
    for table in ("orders", "customers", "books", "authors", "order_items"):
        jobs.start_landing(spark, table, settings).awaitTermination()
    jobs.start_rejected(spark, "orders", settings).awaitTermination()
    jobs.start_joined_feed(spark, "books", settings).awaitTermination()
    expected = expected_star(spark, sf_dir)
    for name in ("orders", "customers", "books"):
        jobs.start_dimension(spark, name, settings, bounded=True).awaitTermination()
        jobs.start_dimension_table(spark, name, settings).awaitTermination()
        assert same(expected[name], jobs.dimension_table(spark, name, settings)), name
        jobs.start_consolidated(spark, name, settings, bounded=True).awaitTermination()
        held = read_rows(spark, settings.dataset(DIMENSIONS[name].topic + ".consolidated"),
                         DIMENSIONS[name].schema)
        log = as_changelog(expected[name])
        assert same(consolidate_in_windows(log, DIMENSIONS[name].sk), held), name
    jobs.start_fact(spark, "order_items", settings, bounded=True)
    assert same(expected["order_items"], jobs.fact_table(spark, "order_items", settings))
    late = spark.read.parquet(f"{settings.dataset(DIMENSIONS['orders'].topic)}.late")
    assert late.count() == 0
    # Items that are corrected and deleted in a later run withdraw their facts.
    items = read_landing(spark, "order_items", settings).cache()
    some = items.where("op <> 'd'").orderBy("order_item_id").limit(40)
    again = some.withColumns({"op": F.when(F.col("order_item_id") % 2 == 0, "d").otherwise("u"),
                              "ts_ms": F.col("ts_ms") + 10**11, "quantity": F.col("quantity") + 7})
    to_message(again, "order_items").write.mode("append").text(f"{topics}/{SOURCES['order_items'].topic}")
    jobs.start_landing(spark, "order_items", settings).awaitTermination()
    jobs.start_fact(spark, "order_items", settings, bounded=True)
    after = facts.f_order_items(read_landing(spark, "order_items", settings), expected["orders"],
                                expected["customers"], expected["books"])
    assert after.count() < expected["order_items"].count()
    assert same(after, jobs.fact_table(spark, "order_items", settings))
    rejected = spark.read.parquet(settings.dataset(SOURCES["orders"].landing + ".rejected"))
    assert rejected.count() == 1
    # A second run finds nothing new.
    jobs.start_dimension_table(spark, "orders", settings).awaitTermination()
    assert same(expected["orders"], jobs.dimension_table(spark, "orders", settings))
    # The other fact, on the same order dimension.
    for table in ("shipping_services", "carriers", "shipments", "shipment_events"):
        jobs.start_landing(spark, table, settings).awaitTermination()
    jobs.start_joined_feed(spark, "carrier_services", settings).awaitTermination()
    jobs.start_dimension(spark, "carrier_services", settings, bounded=True).awaitTermination()
    jobs.start_dimension_table(spark, "carrier_services", settings).awaitTermination()
    jobs.start_fact(spark, "shipment_events", settings, bounded=True)
    assert same(expected["shipment_events"], jobs.fact_table(spark, "shipment_events", settings))


def test_landings_keep_texts_whole_and_report_what_they_cut(spark, tmp_path):
    text, topic = "x" * 300, SOURCES["orders"].topic
    message = ('{"payload": {"op": "c", "ts_ms": 5, "source": {"ts_ms": 1, "version": "3", "txId": 5, "lsn": 9}, "after": '
               '{"order_id": 1, "customer_id": 2, "order_date": 0, "status": "new", "shipping_method": "%s"}}}')
    values = [(message % text,), (message % "air",)]
    spark.createDataFrame(values, "value STRING").write.text(f"{tmp_path}/{topic}")
    for whole in (False, True):
        of_table, of_stream = (Settings(environment=f"{kind}{whole}", root=str(tmp_path)) for kind in ("t", "s"))
        rebuild.land_table(spark, "orders", of_table, cut_texts=not whole)
        jobs.start_landing(spark, "orders", of_stream, cut_texts=not whole).awaitTermination()
        for settings in (of_table, of_stream):
            landed = spark.read.parquet(settings.dataset(SOURCES["orders"].landing)).collect()
            assert {r.shipping_method for r in landed} == {"air", text if whole else text[:20]}
        cut = spark.read.parquet(of_table.dataset(SOURCES["orders"].landing) + ".cut").collect()
        assert [(r.cut, r.raw) for r in cut] == ([] if whole else [("shipping_method", message % text)])
    jobs.start_cut(spark, "orders", of_stream).awaitTermination()
    assert spark.read.parquet(of_stream.dataset(f"{SOURCES['orders'].landing}.cut")).count() == 1


def test_ttl_needs_processing_time(spark, sf_dir):
    changes = feeds.events(spark, sf_dir, streaming=True)
    with pytest.raises(ValueError):
        stream_changelog(changes, "user_id", {"user_id": "user_id"}, sk="sk", entity="e",
                         settings=Settings(state_ttl_ms=30_000))


def test_dimension_job_on_processing_time(spark, tmp_path):
    """Changes are put in order within the buffer; a key is forgotten after its time to live."""
    settings = Settings(environment=f"p{tmp_path.name}", root=str(tmp_path), buffer_ms=1500,
                        state_ttl_ms=30_000)
    with pytest.raises(ValueError):
        jobs.start_dimension(spark, "orders", settings, processing_time=True)
    topic = settings.dataset(DIMENSIONS["orders"].topic)
    landing = settings.dataset(SOURCES["orders"].landing)
    schema = landing_schema("orders")

    def land(*changes):
        values = [{"order_id": 1, "customer_id": 2, "op": op, "ts_ms": ts, "status": f"s{ts}"}
                  for op, ts in changes]
        rows = [tuple(v.get(f.name) for f in schema) for v in values]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)

    def written(folder, count):
        for _ in range(60):
            if exists(spark, folder):
                rows = spark.read.schema(DIMENSIONS["orders"].schema).option(
                    "recursiveFileLookup", True).parquet(folder).collect()
                if len(rows) >= count:
                    return sorted((r.status, r.validFrom, r.validTo) for r in rows)
            time.sleep(1)
        raise AssertionError(f"fewer than {count} rows in {folder}")

    land(("u", 20), ("c", 10))
    query = jobs.start_dimension(spark, "orders", settings, every="1 second", processing_time=True)
    try:
        first = [("s10", 10, 19), ("s10", 10, END), ("s20", 20, END)]
        assert written(topic, 3) == first
        land(("u", 15))
        assert [r[:2] for r in written(f"{topic}.late", 1)] == [("s15", 15)]
        time.sleep(32)
        land(("u", 30))
        # The version that began at 20 is forgotten, so nothing closes it.
        assert written(topic, 4) == [*first, ("s30", 30, END)]
    finally:
        query.stop()


def test_current_and_changelog_agree(spark, sf_dir):
    versions = dimensions.d_orders(feeds.landed(spark, sf_dir, "orders"))
    log = as_changelog(versions)
    assert log.count() == 2 * versions.count() - current(versions).count()
    assert log.where(F.col("validTo") == END).count() == versions.count()


def test_facts_count_what_became_of_an_item(spark):
    changes = spark.createDataFrame(
        [(1, 10, 1, "c", 5), (1, 10, 2, "u", 6), (1, 30, 3, "u", 7), (1, 30, 3, "u", 7),
         (2, 10, 4, "c", 1), (2, 20, 5, "d", 1), (2, 20, 5, "d", 1),
         (3, 15, 6, "c", None), (None, 1, 7, "c", 1)],
        "id INT, ts_ms BIGINT, lsn BIGINT, op STRING, quantity INT")
    rows = facts.live_rows(changes, "id").orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, 10, 3, "u", 7), (3, 15, 6, "c", None)]
    assert facts.live_rows(changes.limit(0), "id").count() == 0


def test_consolidation_is_by_surrogate_key(spark):
    log = spark.createDataFrame([("k", "a", 1, END), ("k", "b", 1, 9)],
                                "sk STRING, x STRING, validFrom BIGINT, validTo BIGINT")
    assert [tuple(r) for r in consolidate(log, "sk").collect()] == [("k", "b", 1, 9)]


def test_a_cluster_has_to_name_its_shared_folder():
    from types import SimpleNamespace

    named = {}
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda key, other: named.get(key, other)),
                              sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(RuntimeError):
        scratch_dir(cluster, "x")
    named["spark.checkpoint.dir"] = "hdfs://shared"
    assert scratch_dir(cluster, "x").startswith("hdfs://shared/x-")


def test_merges_rewrite_nothing_that_is_held(spark, tmp_path):
    """A merge writes its own changes alone, however many versions are open."""
    path = str(tmp_path / "dim")

    def df(*data):
        return spark.createDataFrame(list(data), DIM)

    held = [(f"{i}", "v", 1, END) for i in range(500)]
    merge_versions(df(*held), path, "sk", buckets=1)
    merge_versions(df(("7", "late", 1, 9), ("x", "v", 9, END)), path, "sk", compact_from=None)
    first, second = manifest(spark, path).parts
    assert spark.read.parquet(f"{path}/commits/{second}").count() == 2
    expected = [r for r in held if r[0] != "7"] + [("7", "v", 1, 9), ("x", "v", 9, END)]
    schema = df(*held).schema
    assert rows(read_versions(spark, path, schema, "sk")) == sorted(expected)
    # Compaction leaves out the open row of the version that ended.
    compact(spark, path, schema, "sk")
    part, = manifest(spark, path).parts
    assert spark.read.parquet(f"{path}/commits/{part}").count() == 501
    merge_versions(df(("7", "again", 1, END)), path, "sk")
    assert rows(read_versions(spark, path, schema, "sk")) == sorted(expected)


def test_open_versions_alone_are_compacted(spark, tmp_path):
    path = str(tmp_path / "dim")
    for n in range(5):
        merge_versions(spark.createDataFrame([("a", "v", 1, END), (f"{n}", "v", 1, END)], DIM), path, "sk",
                       buckets=1, compact_from=3)
    assert len(manifest(spark, path).parts) <= 3
    held = read_versions(spark, path, spark.createDataFrame([], DIM).schema, "sk")
    assert rows(held) == [(k, "v", 1, END) for k in ("0", "1", "2", "3", "4", "a")]


def test_older_manifests_are_read(spark, tmp_path):
    import json

    path, one = str(tmp_path / "dim"), spark.createDataFrame([("a", "n", 1, END), ("b", "n", 1, 5)], DIM)
    state = F.when(F.col("validTo") == END, "open").otherwise("closed")
    one.withColumns({"version_end": state, "key_bucket": F.lit(0)}).write.partitionBy(
        "version_end", "key_bucket").parquet(f"{path}/commits/old")
    (tmp_path / "dim" / "manifests").mkdir()
    (tmp_path / "dim" / "manifests" / "0").write_text(json.dumps(
        {"number": 0, "buckets": 1, "opened": {"0": "old"}, "closed": ["old"], "merged": {"batch": 0}}))
    merge_versions(spark.createDataFrame([("a", "n", 1, 9)], DIM), path, "sk")
    expected = [("a", "n", 1, 9), ("b", "n", 1, 5)]
    assert rows(read_versions(spark, path, one.schema, "sk")) == expected
    compact(spark, path, one.schema, "sk")
    assert rows(read_versions(spark, path, one.schema, "sk")) == expected
