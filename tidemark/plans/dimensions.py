"""The four dimensions, from landing rows. Each returns consolidated versions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..catalog import DIMENSIONS
from ..operators.joins import latest_state_join
from ..operators.scd2 import scd2_versions

# Output columns and the landing (or joined) columns they come from.
ATTRIBUTES: dict[str, dict[str, str]] = {
    "orders": {
        "orderId": "order_id", "customerId": "customer_id", "status": "status",
        "shippingMethod": "shipping_method", "orderDate": "order_date",
    },
    "customers": {
        "customerId": "customer_id", "email": "email", "phone": "phone",
        "streetAddress": "street_address", "city": "city", "state": "state",
        "postalCode": "postal_code", "country": "country",
        "firstName": "first_name", "lastName": "last_name",
    },
    "books": {
        "bookId": "book_id", "authorId": "author_id", "title": "title", "isbn": "isbn",
        "publishedDate": "published_date", "genre": "genre",
        "authorFirstName": "author_first_name", "authorLastName": "author_last_name",
        "authorCountry": "author_country",
    },
    "carrier_services": {
        "serviceId": "service_id", "serviceName": "service_name",
        "carrierName": "carrier_name", "carrierContactEmail": "carrier_contact_email",
        "carrierPhone": "carrier_phone", "estimatedDays": "estimated_days",
        "costEstimate": "cost_estimate",
    },
}

AUTHOR_COLUMNS = {"first_name": "author_first_name", "last_name": "author_last_name",
                  "country": "author_country"}
CARRIER_COLUMNS = {"name": "carrier_name", "contact_email": "carrier_contact_email",
                   "phone": "carrier_phone"}


def attribute_columns(name: str) -> dict:
    """Attribute projection of a dimension, with its column types."""
    types = {f.name: f.dataType for f in DIMENSIONS[name].schema}
    return {out: F.col(source).cast(types[out]) for out, source in ATTRIBUTES[name].items()}


def build_versions(changes: DataFrame, name: str, **options) -> DataFrame:
    """Versions of a dimension from its single, or already joined, change feed."""
    dimension = DIMENSIONS[name]
    return scd2_versions(
        changes, ATTRIBUTES[name][dimension.key], attribute_columns(name),
        sk=dimension.sk, entity=dimension.table, **options,
    ).select(*dimension.schema.fieldNames())


def d_orders(orders: DataFrame, **options) -> DataFrame:
    return build_versions(orders, "orders", **options)


def d_customers(customers: DataFrame, **options) -> DataFrame:
    return build_versions(customers, "customers", **options)


def books_with_authors(books: DataFrame, authors: DataFrame, **options) -> DataFrame:
    """Joined feed; takes only the book columns the dimension keeps."""
    kept = ("book_id", "author_id", "title", "isbn", "published_date", "genre",
            "op", "ts_ms", "emitted_ts_ms", "lsn")
    return latest_state_join(books.select(*kept), authors, "author_id", "book_id",
                             parent_columns=AUTHOR_COLUMNS, **options)


def d_books(books: DataFrame, authors: DataFrame, *, effective_time: str = "greatest",
            author_rows: int | None = None, **options) -> DataFrame:
    joined = books_with_authors(books, authors, effective_time=effective_time,
                                parent_rows=author_rows)
    return build_versions(joined, "books", **{"size_of": books, **options})


def services_with_carriers(services: DataFrame, carriers: DataFrame, **options) -> DataFrame:
    kept = ("service_id", "carrier_id", "service_name", "estimated_days", "cost_estimate",
            "op", "ts_ms", "emitted_ts_ms")
    return latest_state_join(services.select(*kept), carriers, "carrier_id", "service_id",
                             parent_columns=CARRIER_COLUMNS, **options)


def d_carrier_services(services: DataFrame, carriers: DataFrame, *,
                       effective_time: str = "greatest", carrier_rows: int | None = None,
                       **options) -> DataFrame:
    joined = services_with_carriers(services, carriers, effective_time=effective_time,
                                    parent_rows=carrier_rows)
    return build_versions(joined, "carrier_services", **{"size_of": services, **options})


def orders_presentation(orders_dimension: DataFrame) -> DataFrame:
    """``d_orders`` as the warehouse shows it: the customer reference serves joins only."""
    return orders_dimension.drop("customerId")


def to_warehouse(df: DataFrame, schema) -> DataFrame:
    """Columns and types of the warehouse table."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
