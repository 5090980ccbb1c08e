"""The engine's operators and pipelines on the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..catalog import DIMENSIONS
from ..config import END_OF_TIME, scratch_dir
from ..functions.cdc import landed_rows, parse_changes, rejected_rows, to_message
from ..functions.columns import acceptance_window_end, surrogate_key
from ..operators import scd2
from ..operators.joins import point_in_time_join, without_match
from ..operators.quality import constraint_report, invalid_transitions
from ..operators.ranges import as_of_join
from ..operators.upsert import new_rows, upsert_versions
from ..plans import dimensions, facts, reports
from ..sources.topics import good_rows, parse_rows, to_json_rows
from ..sources.versions import merge_versions, read_versions
from . import feeds

Query = Callable[[SparkSession, str], DataFrame]
EVENT_COLUMNS = {"userId": "user_id", "eventType": "event_type", "value": "value"}
EVENTS = {"sk": "eventSk", "entity": "d_events"}


def plain(df: DataFrame) -> DataFrame:
    """Dates and times as text and decimals as doubles, so that engines compare alike."""

    def column(f: T.StructField):
        c = F.col(f.name)
        if isinstance(f.dataType, T.TimestampType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        return c.alias(f.name)

    return df.select(*[column(f) for f in df.schema])


def row_bound(spark: SparkSession, sf_dir: str, table: str, versions: int) -> int:
    """Proven upper bound of an entity's versions: footer row count times versions."""
    return feeds.table(spark, sf_dir, table).count() * versions


def _landing(name: str) -> Query:
    def query(spark, sf_dir):
        return plain(landed_rows(parse_changes(feeds.messages(spark, sf_dir, name), name)))

    return query


def corrupt_quarantine(spark, sf_dir):
    """Order messages, some cut short and some without operation, through the parser."""
    method = F.col("shipping_method")
    orders = feeds.landed(spark, sf_dir, "orders", whole_text=True).withColumn(
        "op", F.when(method != "4-NOT SPECIFIED", F.col("op")))
    low = to_message(orders.where(method == "5-LOW"), "orders")
    cut = low.select(F.left("value", F.length("value") - 2).alias("value"))
    messages = to_message(orders.where(method != "5-LOW"), "orders").unionByName(cut)
    rejected = rejected_rows(parse_changes(messages, "orders"))
    return rejected.groupBy("error").agg(F.count("*").alias("messages"))


def landing_rejected(spark, sf_dir):
    """Order item messages, some with values that cannot be read, by reason."""
    items = feeds.landed(spark, sf_dir, "order_items", whole_text=True).withColumn(
        "op", F.when(F.col("book_id") % 10 != 4, F.col("op")))
    value = F.col("value")
    book = F.regexp_extract("value", '"book_id":([0-9]+)', 1).try_cast("bigint") % 10
    discount = '"discount":"[^"]*"'
    bad = (F.when(book == 0, F.left(value, F.length(value) - 3))
           .when(book == 1, F.regexp_replace(value, discount, '"discount":"!!bad!!"'))
           .when(book == 2, F.regexp_replace(value, discount, '"discount":"AQAAAAAAAAAA"'))
           .when(book == 3, F.regexp_replace(value, '"quantity":', '"quantity":"many","q":'))
           .otherwise(value))
    messages = to_message(items, "order_items").select(bad.alias("value"))
    rejected = rejected_rows(parse_changes(messages, "order_items"))
    return rejected.groupBy("error").agg(F.count("*").alias("messages"))


def _event_versions(spark, sf_dir, **options):
    return scd2.scd2_versions(feeds.events(spark, sf_dir), "user_id", EVENT_COLUMNS,
                              **EVENTS, **options)


def scd2_changelog_events(spark, sf_dir):
    return scd2.as_changelog(_event_versions(spark, sf_dir))


def scd2_consolidated_events(spark, sf_dir):
    return scd2.consolidate(scd2.as_changelog(_event_versions(spark, sf_dir)), "eventSk")


def scd2_window_consolidated_events(spark, sf_dir):
    changelog = scd2.as_changelog(_event_versions(spark, sf_dir))
    return scd2.consolidate_in_windows(changelog, "eventSk")


def scd2_current_events(spark, sf_dir):
    return scd2.current(_event_versions(spark, sf_dir, delete_rows="drop"))


def scd2_noop_suppressed(spark, sf_dir):
    kept = scd2.drop_unchanged(feeds.events(spark, sf_dir), "user_id", ["event_type"])
    return scd2.scd2_versions(kept, "user_id", EVENT_COLUMNS, **EVENTS)


def scd2_integrity(spark, sf_dir):
    return scd2.integrity_report(_event_versions(spark, sf_dir), "userId")


def acceptance_window(spark, sf_dir):
    return feeds.events(spark, sf_dir).select(
        F.col("lsn").alias("event_id"), "ts_ms",
        acceptance_window_end(F.col("ts_ms"), 100_000).alias("window_end"))


def _d_orders(spark, sf_dir, **options):
    return dimensions.d_orders(feeds.landed(spark, sf_dir, "orders"), **options)


def _d_customers(spark, sf_dir, **options):
    return dimensions.d_customers(feeds.landed(spark, sf_dir, "customers"), **options)


def _d_books(spark, sf_dir, **options):
    return dimensions.d_books(
        feeds.landed(spark, sf_dir, "books"), feeds.landed(spark, sf_dir, "authors"),
        author_rows=row_bound(spark, sf_dir, "nation", 2), **options)


def _d_services(spark, sf_dir, **options):
    return dimensions.d_carrier_services(
        feeds.landed(spark, sf_dir, "shipping_services"), feeds.landed(spark, sf_dir, "carriers"),
        carrier_rows=row_bound(spark, sf_dir, "nation", 2), **options)


def dim_orders(spark, sf_dir):
    return plain(_d_orders(spark, sf_dir))


def dim_customers(spark, sf_dir):
    return plain(_d_customers(spark, sf_dir))


def dim_books(spark, sf_dir):
    return plain(_d_books(spark, sf_dir))


def dim_carrier_services(spark, sf_dir):
    return plain(_d_services(spark, sf_dir))


def books_authors_joined(spark, sf_dir):
    joined = dimensions.books_with_authors(
        feeds.landed(spark, sf_dir, "books"), feeds.landed(spark, sf_dir, "authors"),
        parent_rows=row_bound(spark, sf_dir, "nation", 2))
    return plain(joined.select("book_id", "author_id", "author_last_name", "op", "ts_ms", "lsn"))


def services_carriers_joined(spark, sf_dir):
    joined = dimensions.services_with_carriers(
        feeds.landed(spark, sf_dir, "shipping_services"), feeds.landed(spark, sf_dir, "carriers"),
        parent_rows=row_bound(spark, sf_dir, "nation", 2))
    return plain(joined.select("service_id", "carrier_id", "carrier_contact_email", "op", "ts_ms"))


def shipment_events_joined(spark, sf_dir):
    joined = facts.shipment_event_changes(
        feeds.landed(spark, sf_dir, "shipment_events"), feeds.landed(spark, sf_dir, "shipments"))
    return plain(joined.select("event_id", "shipment_id", "status", "location", "order_id",
                               "service_id", "shipping_status", "actual_delivery_date", "ts_ms"))


def shipment_events_latest(spark, sf_dir):
    return plain(facts.events_with_shipments(
        feeds.landed(spark, sf_dir, "shipment_events"), feeds.landed(spark, sf_dir, "shipments")))


def _starts(spark, sf_dir, entity, key, name):
    """Version starts of a dimension, straight from its feed."""
    return feeds.landed(spark, sf_dir, entity).select(
        F.col(key).alias(name), F.col("ts_ms").alias("validFrom"))


def pit_orders(spark, sf_dir):
    items = feeds.landed(spark, sf_dir, "order_items").select(
        "order_item_id", "order_id", "book_id", "ts_ms")
    return point_in_time_join(
        items, _d_orders(spark, sf_dir).select(
            "orderId", "orderSk", F.col("status").alias("orderStatus"), "validFrom", "validTo"),
        ("order_id", "orderId"), "ts_ms",
        versions_from=_starts(spark, sf_dir, "orders", "order_id", "orderId"))


def pit_orders_inclusive(spark, sf_dir):
    items = feeds.landed(spark, sf_dir, "order_items").select("order_item_id", "order_id", "ts_ms")
    return point_in_time_join(
        items, _d_orders(spark, sf_dir).select("orderId", "orderSk", "validFrom", "validTo"),
        ("order_id", "orderId"), "ts_ms", inclusive_end=True,
        versions_from=_starts(spark, sf_dir, "orders", "order_id", "orderId"))


def pit_orders_ranges(spark, sf_dir):
    """The same over sorted ranges, which no size of key changes."""
    items = feeds.landed(spark, sf_dir, "order_items").select(
        "order_item_id", "order_id", "book_id", "ts_ms")
    orders = _d_orders(spark, sf_dir, **DISJOINT).withColumnRenamed("status", "orderStatus")
    return as_of_join(items, orders, ("order_id", "orderId"), "ts_ms", ["orderSk", "orderStatus"])


def unmatched_items(spark, sf_dir):
    items = feeds.landed(spark, sf_dir, "order_items").select(
        "order_item_id", "order_id", "book_id", "ts_ms")
    return without_match(
        items, _d_orders(spark, sf_dir), ("order_id", "orderId"), "ts_ms",
        versions_from=_starts(spark, sf_dir, "orders", "order_id", "orderId"))


DISJOINT = {"delete_rows": "closed"}


def _f_order_items(spark, sf_dir):
    return facts.f_order_items(
        feeds.landed(spark, sf_dir, "order_items"), _d_orders(spark, sf_dir, **DISJOINT),
        _d_customers(spark, sf_dir, **DISJOINT), _d_books(spark, sf_dir, **DISJOINT),
        disjoint=True,
        orders_feed=_starts(spark, sf_dir, "orders", "order_id", "orderId"),
        customers_feed=_starts(spark, sf_dir, "customers", "customer_id", "customerId"),
        books_feed=_starts(spark, sf_dir, "books", "book_id", "bookId"),
        customer_keys=feeds.landed(spark, sf_dir, "orders").select("customer_id", "ts_ms"),
        customer_rows=row_bound(spark, sf_dir, "customer", 2),
        # Each book version meets at most the two versions of its author.
        book_rows=row_bound(spark, sf_dir, "part", 3 * 2))


def _f_shipment_events(spark, sf_dir):
    return facts.f_shipment_events(
        feeds.landed(spark, sf_dir, "shipment_events"), feeds.landed(spark, sf_dir, "shipments"),
        _d_orders(spark, sf_dir, **DISJOINT), _d_services(spark, sf_dir, **DISJOINT),
        disjoint=True,
        orders_feed=_starts(spark, sf_dir, "orders", "order_id", "orderId"),
        services_feed=_starts(spark, sf_dir, "shipping_services", "service_id", "serviceId"),
        service_rows=row_bound(spark, sf_dir, "supplier", 2 * 2))


def fact_order_items(spark, sf_dir):
    f = _f_order_items(spark, sf_dir)
    return f.withColumn("priceTotal", F.round("priceTotal", 4))


def fact_shipment_events(spark, sf_dir):
    return plain(_f_shipment_events(spark, sf_dir))


def upsert_dim(spark, sf_dir):
    """A first load of orders, then the whole changelog merged into it."""
    changes = feeds.landed(spark, sf_dir, "orders")
    first = dimensions.d_orders(changes.where("op = 'c'"))
    return plain(upsert_versions(first, scd2.as_changelog(_d_orders(spark, sf_dir)), "orderSk"))


def dim_orders_merged(spark, sf_dir, batches: int = 20):
    """The changelog of orders merged into a stored table batch by batch, in the order of time."""
    folder = scratch_dir(spark, "dim-orders")
    log = scd2.as_changelog(_d_orders(spark, sf_dir))
    told = F.when(F.col("validTo") == END_OF_TIME, F.col("validFrom")).otherwise(F.col("validTo"))
    low, high = feeds.landed(spark, sf_dir, "orders").agg(F.min("ts_ms"), F.max("ts_ms")).first()
    number = F.floor((told - low) * batches / (high - low + 1))
    log.withColumn("number", number).write.partitionBy("number").parquet(f"{folder}/log")
    written = spark.read.parquet(f"{folder}/log")
    for n in range(batches):
        merge_versions(written.where(F.col("number") == n).select(*log.columns), f"{folder}/table",
                       "orderSk", n, buckets=8, compact_from=8)
    return plain(read_versions(spark, f"{folder}/table", log.schema, "orderSk"))


def insert_ignore_fact(spark, sf_dir):
    """Items delivered twice, on top of those already stored."""
    key = surrogate_key("order_item", F.col("order_item_id"), F.col("book_id"), F.col("ts_ms"))
    changes = facts.narrow(feeds.landed(spark, sf_dir, "order_items"),
                           ("order_item_id", "book_id", "quantity"))
    items = facts.live_rows(changes, "order_item_id").select(
        key.alias("orderItemSk"), F.col("order_item_id").alias("orderItemId"), "quantity",
        F.col("ts_ms").alias("transactionTime"))
    stored = items.where(F.col("transactionTime") < feeds.START + 3 * feeds.YEAR)
    return new_rows(stored, items.unionByName(items), "orderItemSk")


def _sales(sk, dimension, *columns) -> Query:
    builders = {"books": _d_books, "customers": _d_customers, "orders": _d_orders}

    def query(spark, sf_dir):
        return reports.sales_by(_f_order_items(spark, sf_dir),
                                builders[dimension](spark, sf_dir), sk, columns)

    return query


def delivery_time_by_service(spark, sf_dir):
    return reports.delivery_by_service(_f_shipment_events(spark, sf_dir),
                                       _d_services(spark, sf_dir))


def orders_presentation(spark, sf_dir):
    return plain(dimensions.orders_presentation(_d_orders(spark, sf_dir)))


def dq_constraints(spark, sf_dir):
    names = ("authors", "books", "customers", "orders", "order_items", "carriers",
             "shipping_services", "shipments", "shipment_events")
    # Cut texts could look equal.
    return constraint_report({n: feeds.landed(spark, sf_dir, n, whole_text=True) for n in names})


def dim_topic_round_trip(spark, sf_dir):
    """The order dimension as JSON messages, with a broken one for every low priority."""
    orders = _d_orders(spark, sf_dir)
    low = F.col("value").contains('"shippingMethod":"5-LOW"')
    messages = to_json_rows(orders).select(
        F.when(low, F.left("value", F.length("value") - 1)).otherwise(F.col("value"))
        .alias("value"))
    return plain(good_rows(parse_rows(messages, orders.schema), orders.schema))


def warehouse_carrier_services(spark, sf_dir):
    return dimensions.to_warehouse(_d_services(spark, sf_dir),
                                   DIMENSIONS["carrier_services"].warehouse_schema)


def status_transitions(spark, sf_dir):
    return invalid_transitions(feeds.landed(spark, sf_dir, "shipments"))


LANDING_NAMES = {"shipping_services": "landing_services"}


def batch_queries() -> dict[str, Query]:
    named = [
        scd2_changelog_events, scd2_consolidated_events, scd2_window_consolidated_events,
        scd2_current_events, scd2_noop_suppressed, scd2_integrity, acceptance_window,
        dim_orders, dim_customers, dim_books, dim_carrier_services, books_authors_joined,
        services_carriers_joined, shipment_events_joined, shipment_events_latest, pit_orders,
        pit_orders_inclusive, pit_orders_ranges, fact_order_items, fact_shipment_events, unmatched_items, upsert_dim,
        dim_orders_merged,
        insert_ignore_fact, corrupt_quarantine, landing_rejected, delivery_time_by_service, orders_presentation,
        dq_constraints, status_transitions, dim_topic_round_trip, warehouse_carrier_services,
    ]
    return {
        **{LANDING_NAMES.get(t, f"landing_{t}"): _landing(t) for t in feeds._FEEDS},
        **{q.__name__: q for q in named},
        "sales_by_book": _sales("bookSk", "books", "bookId", "title"),
        "sales_by_genre": _sales("bookSk", "books", "genre"),
        "sales_by_author": _sales("bookSk", "books", "authorId", "authorFirstName"),
        "sales_by_customer": _sales("customerSk", "customers", "customerId", "country"),
        "sales_by_order_status": _sales("orderSk", "orders", "status", "shippingMethod"),
    }
