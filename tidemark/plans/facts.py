"""The two facts: events with the dimension versions valid at their time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..catalog import FACTS
from ..functions.columns import packed_key, price_total, surrogate_key, unpacked_key
from ..operators.joins import join_state, latest_state, latest_state_join, point_in_time_join
from ..operators.scd2 import tie_columns

SHIPMENT_COLUMNS = ("order_id", "service_id", "tracking_number", "shipping_status",
                    "shipped_date", "expected_delivery_date", "actual_delivery_date",
                    "shipping_cost")


def live_rows(changes: DataFrame, key: str, *, ts: str = "ts_ms", op: str = "op") -> DataFrame:
    """What became of each event: its last state, at the time of its first change.

    Events that were deleted are left out, and so are rows without a key. Redelivered changes
    count once. Changes are combined in the map tasks, so an event with very many of them
    is no burden to one task.
    """
    # Every column once, what puts rows in order first: this is shuffled for each event.
    order = [ts, *tie_columns(changes)]
    rest = [c for c in changes.columns if c not in (key, *order)]
    last = changes.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).groupBy(key).agg(
        F.max(F.struct(F.struct(*order).alias("order"), F.struct(*rest).alias("rest"))).alias("__last"),
        F.min(ts).alias(ts))
    alive = last.where(~F.coalesce(F.col(f"__last.rest.{op}") == "d", F.lit(False)))
    values = {key: F.col(key), ts: F.col(ts), **{c: F.col(f"__last.rest.{c}") for c in rest}}
    return alive.select(*[values.get(c, F.col(f"__last.order.{c}")).alias(c) for c in changes.columns])


def narrow(changes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only the columns that are kept, and those that put changes in order."""
    return changes.select(*columns, "op", "ts_ms", *tie_columns(changes))


def event_rows(changes: DataFrame, key: str, which: str) -> DataFrame:
    if which not in ("live", "all"):
        raise ValueError(f"unknown changes: {which}")
    if which == "live":
        return live_rows(changes, key)
    return changes.where(~F.coalesce(F.col("op") == "d", F.lit(False)))


def f_order_items(
    items: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    books: DataFrame,
    *,
    inclusive_end: bool = False,
    disjoint: bool = False,
    orders_feed: DataFrame | None = None,
    customers_feed: DataFrame | None = None,
    books_feed: DataFrame | None = None,
    customer_keys: DataFrame | None = None,
    customer_rows: int | None = None,
    book_rows: int | None = None,
    changes: str = "live",
) -> DataFrame:
    """Order items with order, customer and book keys, and the sales measure.

    ``*_feed`` frames hold the dimension's key and ``validFrom`` only; ``customer_keys``, with
    ``customer_id`` and ``ts_ms``, is a cheaper frame with the customers of orders; the
    ``*_rows`` bounds allow a broadcast. ``disjoint`` asserts that no dimension
    has overlapping versions. ``changes="live"`` gives one fact for each item that was
    not deleted, as it last was and at the time of its creation; ``"all"`` one for each
    change other than a delete.
    """
    needed = ("order_item_id", "order_id", "book_id", "quantity", "price_at_purchase", "discount")
    rows = event_rows(narrow(items, needed), "order_item_id", changes).select(*needed, "ts_ms")
    rows = point_in_time_join(
        rows, orders.select("orderId", packed_key("orderSk"), "customerId", "validFrom", "validTo"),
        ("order_id", "orderId"), "ts_ms", versions_from=orders_feed,
        keys_from=items.select("order_id", "ts_ms"),
        inclusive_end=inclusive_end, disjoint=disjoint, size_of=items)
    if customer_keys is None:
        customer_keys = orders.select(F.col("customerId").alias("customer_id"),
                                      F.col("validFrom").alias("ts_ms"))
    rows = point_in_time_join(
        rows.withColumnRenamed("customerId", "customer_id"),
        customers.select("customerId", packed_key("customerSk"), "validFrom", "validTo"),
        ("customer_id", "customerId"), "ts_ms", versions_from=customers_feed,
        keys_from=customer_keys,
        dimension_rows=customer_rows, inclusive_end=inclusive_end, disjoint=disjoint, size_of=items)
    rows = point_in_time_join(
        rows, books.select("bookId", packed_key("bookSk"), "validFrom", "validTo"),
        ("book_id", "bookId"), "ts_ms", versions_from=books_feed,
        keys_from=items.select("book_id", "ts_ms"),
        dimension_rows=book_rows, inclusive_end=inclusive_end, disjoint=disjoint, size_of=items)
    # Exact numbers are smaller than doubles on their way through the joins, and so are packed keys.
    return order_item_fact(rows.withColumns({
        **{sk: unpacked_key(sk) for sk in ("orderSk", "customerSk", "bookSk")},
        "priceAtPurchase": F.col("price_at_purchase").cast("double"),
        "discount": F.col("discount").cast("double")}))


def order_item_fact(rows: DataFrame) -> DataFrame:
    """Fact projection of an enriched order item."""
    total = price_total(F.col("quantity"), F.col("priceAtPurchase"), F.col("discount"))
    key = surrogate_key("order_item", F.col("order_item_id"), F.col("book_id"), F.col("ts_ms"))
    return rows.withColumns({
        "orderItemSk": key, "orderItemId": F.col("order_item_id"),
        "transactionTime": F.col("ts_ms"), "priceTotal": total,
    }).select(*FACTS["order_items"].schema.fieldNames())


def events_with_shipments(events: DataFrame, shipments: DataFrame, *,
                          shipment_rows: int | None = None,
                          changes: str = "live") -> DataFrame:
    """Each shipment event with the latest state of its shipment: one row per event.

    ``changes`` as in :func:`f_order_items`.
    """
    state = latest_state(shipments.select("shipment_id", *SHIPMENT_COLUMNS, "ts_ms",
                                          "emitted_ts_ms"), "shipment_id")
    state = state.select("shipment_id", *SHIPMENT_COLUMNS)
    needed = ("event_id", "shipment_id", "status", "location")
    kept = event_rows(narrow(events, needed), "event_id", changes).select(*needed, "ts_ms")
    return join_state(kept, state, "shipment_id", spread_by="event_id", state_rows=shipment_rows,
                      keys_from=events.select("shipment_id"))


def shipment_event_changes(events: DataFrame, shipments: DataFrame, **options) -> DataFrame:
    """Events with every shipment state they meet, a row for each change of either."""
    return latest_state_join(
        events.select("event_id", "shipment_id", "status", "location", "op", "ts_ms",
                      "emitted_ts_ms"),
        shipments, "shipment_id", "event_id",
        parent_columns={c: c for c in SHIPMENT_COLUMNS}, **options)


def f_shipment_events(
    events: DataFrame,
    shipments: DataFrame,
    orders: DataFrame,
    services: DataFrame,
    *,
    inclusive_end: bool = False,
    disjoint: bool = False,
    orders_feed: DataFrame | None = None,
    services_feed: DataFrame | None = None,
    service_rows: int | None = None,
    changes: str = "live",
) -> DataFrame:
    """Live shipment events with shipment, order and service; ``changes`` as above."""
    rows = events_with_shipments(events, shipments, changes=changes)
    rows = point_in_time_join(
        rows, orders.select("orderId", "orderSk", "validFrom", "validTo"),
        ("order_id", "orderId"), "ts_ms", versions_from=orders_feed,
        keys_from=shipments.select("order_id", "ts_ms"),
        inclusive_end=inclusive_end, disjoint=disjoint, size_of=events)
    rows = point_in_time_join(
        rows, services.select("serviceId", "carrierServiceSk", "validFrom", "validTo"),
        ("service_id", "serviceId"), "ts_ms", versions_from=services_feed,
        keys_from=shipments.select("service_id", "ts_ms"),
        dimension_rows=service_rows, inclusive_end=inclusive_end, disjoint=disjoint, size_of=events)
    return shipment_event_fact(rows)


def shipment_event_fact(rows: DataFrame) -> DataFrame:
    """Fact projection of an enriched shipment event."""
    key = surrogate_key("shipment_event", F.col("event_id"), F.col("ts_ms"))
    return rows.withColumns({
        "shipmentEventSk": key,
        "shipmentId": F.col("shipment_id"),
        "shipmentEventId": F.col("event_id"),
        "trackingNumber": F.col("tracking_number"),
        "shippingStatus": F.col("shipping_status"),
        "shippedDate": F.col("shipped_date"),
        "expectedDeliveryDate": F.col("expected_delivery_date"),
        "actualDeliveryDate": F.col("actual_delivery_date"),
        "shippingCost": F.col("shipping_cost").cast("double"),
    }).select(*FACTS["shipment_events"].schema.fieldNames())
