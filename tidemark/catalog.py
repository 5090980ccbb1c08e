"""Schemas of the source tables, landing topics, dimensions and facts.

Keys are BIGINT where the source declares INTEGER: every 32-bit key fits, and
so do the tables that outgrow 32 bits.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    name: str
    kind: str  # id, int, text, timestamp (micros), date (epoch days), decimal (base64)
    length: int | None = None
    required: bool = False


@dataclass(frozen=True)
class Source:
    flavor: str  # postgres or mysql
    topic: str
    landing: str
    key: str
    fields: tuple[Field, ...]


def _id(name, required=True):
    return Field(name, "id", required=required)


def _text(name, length=None, required=False):
    return Field(name, "text", length, required)


SOURCES: dict[str, Source] = {
    "authors": Source(
        "postgres", "pg-changes.public.authors", "store.authors.landing", "author_id",
        (_id("author_id"), _text("first_name", 50), _text("last_name", 50),
         _text("biography", 50), _text("country", 50)),
    ),
    "books": Source(
        "postgres", "pg-changes.public.books", "store.books.landing", "book_id",
        (_id("book_id"), _text("title", 50), _id("author_id"), _text("isbn", 13),
         Field("price", "decimal"), Field("published_date", "date"),
         _text("description", 500), _text("genre", 50), Field("stock", "int")),
    ),
    "customers": Source(
        "postgres", "pg-changes.public.customers", "store.customers.landing", "customer_id",
        (_id("customer_id"), _text("first_name", 50), _text("last_name", 50),
         _text("email", 50), _text("phone", 20), Field("created_at", "timestamp"),
         _text("street_address", 50), _text("city", 50), _text("state", 50),
         _text("postal_code", 10), _text("country", 50)),
    ),
    "orders": Source(
        "postgres", "pg-changes.public.orders", "store.orders.landing", "order_id",
        (_id("order_id"), _id("customer_id"), Field("order_date", "timestamp"),
         _text("status", 20, required=True), _text("shipping_method", 20)),
    ),
    "order_items": Source(
        "postgres", "pg-changes.public.order_items", "store.order_items.landing", "order_item_id",
        (_id("order_item_id"), _id("order_id"), _id("book_id"),
         Field("quantity", "int", required=True),
         Field("price_at_purchase", "decimal"), Field("discount", "decimal")),
    ),
    "carriers": Source(
        "mysql", "mysql-changes.shipping_db.carriers", "shipping.carriers.landing", "carrier_id",
        (_id("carrier_id"), _text("name"), _text("contact_email"), _text("phone", 12)),
    ),
    "shipping_services": Source(
        "mysql", "mysql-changes.shipping_db.shipping_services",
        "shipping.shipping_services.landing", "service_id",
        (_id("service_id"), _id("carrier_id"), _text("service_name"),
         Field("estimated_days", "int"), Field("cost_estimate", "decimal")),
    ),
    "shipments": Source(
        "mysql", "mysql-changes.shipping_db.shipments", "shipping.shipments.landing", "shipment_id",
        (_id("shipment_id"), _id("order_id"), _id("carrier_id"), _id("service_id"),
         _text("tracking_number"), _text("shipping_status"), Field("shipped_date", "date"),
         Field("expected_delivery_date", "date"), Field("actual_delivery_date", "date"),
         Field("shipping_cost", "decimal")),
    ),
    "shipment_events": Source(
        "mysql", "mysql-changes.shipping_db.shipment_events",
        "shipping.shipment_events.landing", "event_id",
        (_id("event_id"), _id("shipment_id"), _text("status"), _text("location")),
    ),
}

METADATA: dict[str, tuple[tuple[str, str], ...]] = {
    "postgres": (("op", "string"), ("emitted_ts_ms", "bigint"), ("ts_ms", "bigint"),
                 ("connector_version", "string"), ("transaction_id", "string"),
                 ("lsn", "bigint")),
    "mysql": (("op", "string"), ("emitted_ts_ms", "bigint"), ("ts_ms", "bigint"),
              ("connector_version", "string"), ("transaction_id", "string")),
}

TYPES: dict[str, T.DataType] = {
    "string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(),
    "double": T.DoubleType(), "date": T.DateType(), "timestamp": T.TimestampType(),
    "decimal": T.DecimalType(10, 2),
}
LANDED_TYPES = {"id": "bigint", "int": "int", "text": "string", "timestamp": "timestamp",
                "date": "date", "decimal": "decimal"}


def _schema(columns: dict[str, str]) -> T.StructType:
    return T.StructType([T.StructField(n, TYPES[t]) for n, t in columns.items()])


def landing_schema(table: str) -> T.StructType:
    source = SOURCES[table]
    return _schema({**{f.name: LANDED_TYPES[f.kind] for f in source.fields},
                    **dict(METADATA[source.flavor])})


@dataclass(frozen=True)
class Dimension:
    topic: str
    table: str
    key: str
    sk: str
    columns: dict[str, str] = field(default_factory=dict)
    topic_only: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return _schema({self.sk: "string", self.key: "bigint", **self.columns,
                     "validFrom": "bigint", "validTo": "bigint"})

    @property
    def warehouse_schema(self) -> T.StructType:
        kept = [f for f in self.schema if f.name not in self.topic_only]
        if self.table == "d_carrier_services":  # the warehouse declares this key as text
            kept = [T.StructField(f.name, T.StringType()) if f.name == self.key else f
                    for f in kept]
        return T.StructType(kept)


@dataclass(frozen=True)
class Fact:
    topic: str
    table: str
    sk: str
    columns: dict[str, str]

    @property
    def schema(self) -> T.StructType:
        return _schema({self.sk: "string", **self.columns})

DIMENSIONS: dict[str, Dimension] = {
    "orders": Dimension(
        "dimensions.orders", "d_orders", "orderId", "orderSk",
        {"customerId": "bigint", "status": "string", "shippingMethod": "string",
         "orderDate": "date"},
        topic_only=("customerId",),
    ),
    "customers": Dimension(
        "dimensions.customers", "d_customers", "customerId", "customerSk",
        {"email": "string", "phone": "string", "streetAddress": "string", "city": "string",
         "state": "string", "postalCode": "string", "country": "string",
         "firstName": "string", "lastName": "string"},
    ),
    "books": Dimension(
        "dimensions.books", "d_books", "bookId", "bookSk",
        {"authorId": "bigint", "title": "string", "isbn": "string", "publishedDate": "date",
         "genre": "string", "authorFirstName": "string", "authorLastName": "string",
         "authorCountry": "string"},
    ),
    "carrier_services": Dimension(
        "dimensions.carrier_services", "d_carrier_services", "serviceId", "carrierServiceSk",
        {"serviceName": "string", "carrierName": "string", "carrierContactEmail": "string",
         "carrierPhone": "string", "estimatedDays": "int", "costEstimate": "double"},
    ),
}

FACTS: dict[str, Fact] = {
    "order_items": Fact(
        "facts.order_items", "f_order_items", "orderItemSk",
        {"orderSk": "string", "bookSk": "string", "customerSk": "string",
         "orderItemId": "bigint", "quantity": "int", "priceAtPurchase": "double",
         "discount": "double", "transactionTime": "bigint", "priceTotal": "double"},
    ),
    "shipment_events": Fact(
        "facts.shipment_events", "f_shipment_events", "shipmentEventSk",
        {"orderSk": "string", "carrierServiceSk": "string", "shipmentId": "bigint",
         "shipmentEventId": "bigint", "status": "string", "location": "string",
         "trackingNumber": "string", "shippingStatus": "string", "shippedDate": "date",
         "expectedDeliveryDate": "date", "actualDeliveryDate": "date",
         "shippingCost": "double"},
    ),
}

# Allowed states and shipment transitions of the source systems.
ORDER_STATUSES = ("pending", "shipped", "delivered", "cancelled")
SHIPMENT_STATUSES = ("created", "in_transit", "delivered", "delayed", "returned", "cancelled")
SHIPMENT_TRANSITIONS = {
    "created": ("in_transit", "cancelled"),
    "in_transit": ("delivered", "delayed", "returned", "cancelled"),
    "delivered": (),
    "delayed": ("in_transit", "delivered", "returned", "cancelled"),
    "returned": (),
    "cancelled": (),
}
