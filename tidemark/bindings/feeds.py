"""Change feeds of the engine's entities, derived from the given tables.

Each feed is a pure function of one table's rows: a row becomes one change per
version, with the columns of the entity's landing topic. The feeds hold what real ones
do: updates and deletes, changes at one instant, rows delivered twice, children that
move to another parent, NULL and negative decimals.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import METADATA, SOURCES, landing_schema
from ..config import use_utc
from ..functions.cdc import to_message
from ..functions.columns import truncated
from ..sources.topics import spread

DAY = 86_400_000
YEAR = 365 * DAY
# Start of entities without a date of their own: 1994-12-31T00:00:00Z.
START = 788_832_000_000


# Line numbers repeat within an order, so the part is added.
def line_id() -> Column:
    return (F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 100_000_000 + F.col("l_partkey")


def line_changes(read: Callable) -> tuple[DataFrame, Column, Column, Column]:
    """Lines as changes, with their time, order in the log, and operation.

    A line is created, one in four is corrected, and one in nine corrected and deleted; one in
    five corrections falls on the instant of the creation, and one line in ten has its last
    change delivered twice.
    """
    mark = F.col("l_orderkey") + F.col("l_linenumber") + F.col("l_partkey")
    count = F.when(mark % 9 == 0, 3).when(mark % 4 == 0, 2).otherwise(1)
    df = versions(read("lineitem"), count, again=mark % 10 == 3)
    step = F.when(mark % 5 == 0, F.greatest(F.col("n") - 1, F.lit(0))).otherwise(F.col("n"))
    order = F.col("n") * 1000 + F.col("l_suppkey") % 1000
    op = F.when(F.col("n") == 0, "c").when(F.col("n") == 1, "u").otherwise("d")
    return df, epoch_ms("l_shipdate") + step * 2 * DAY, order, op


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table as a stream of files, whether it is one file or a directory of parts.

    A stream takes a single file only where a pattern names it.
    """
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/[{name[0]}]{name[1:]}.parquet")


def epoch_ms(column: str) -> Column:
    return F.unix_millis(F.col(column).cast("timestamp"))


def versions(df: DataFrame, count: Column, again: Column | None = None) -> DataFrame:
    """One row per version number ``n`` from 0 to ``count - 1``; the last twice where ``again``."""
    last = (count - 1).cast("bigint")
    numbers = F.sequence(F.lit(0).cast("bigint"), last)
    if again is not None:
        numbers = F.when(again, F.concat(numbers, F.array(last))).otherwise(numbers)
    return df.withColumn("n", F.explode(numbers))


def pick(*values: str) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.col("n") + 1).cast("int"))


def text(template: str, *columns) -> Column:
    return F.format_string(template, *columns)


def _authors(read):
    df = versions(read("nation"), F.col("n_nationkey") % 2 + 1)
    return df, START + F.col("n") * 2 * YEAR, F.col("n_nationkey") * 4 + F.col("n"), {
        "author_id": "n_nationkey",
        "first_name": "n_name",
        "last_name": text("v%d", "n"),
        "biography": F.repeat(F.concat("n_name", F.lit(" ")), F.lit(8)),
        "country": text("REGION_%d", "n_regionkey"),
    }


def _books(read):
    df = versions(read("part"), F.col("p_partkey") % 3 + 1)
    ts = START + F.col("n") * YEAR + F.col("p_partkey") % 1000
    return df, ts, F.col("p_partkey") * 4 + F.col("n"), {
        "book_id": "p_partkey",
        "title": "p_name",
        "author_id": (F.col("p_partkey") + F.col("n") * (F.col("p_partkey") % 2)) % 25,
        "isbn": F.concat(F.lit("978"), F.lpad(F.col("p_partkey").cast("string"), 10, F.lit("0")),
                         F.lit(" (print)")),
        "price": F.col("p_retailprice"),
        "published_date": F.date_add(
            F.lit("1960-01-01").cast("date"), (F.col("p_partkey") % 20000).cast("int")),
        "description": F.concat("p_brand", F.lit(" "), "p_type"),
        "genre": "p_type",
        "stock": F.col("p_size") + F.col("n"),
    }


def _customers(read):
    df = versions(read("customer"), F.col("c_custkey") % 2 + 1)
    return df, START + F.col("n") * 3 * YEAR, F.col("c_custkey") * 4 + F.col("n"), {
        "customer_id": "c_custkey",
        "first_name": F.left("c_name", F.lit(8)),
        "last_name": F.substring("c_name", 10, 9),
        "email": text("c%d@v%d.example", "c_custkey", "n"),
        "phone": text("%d-555-0100", "c_nationkey"),
        "created_at": F.timestamp_seconds(F.lit(START // 1000) + F.col("c_custkey") % 86400),
        "street_address": text("%d Main Street", "c_custkey"),
        "city": text("CITY_%d", "c_nationkey"),
        "state": "c_mktsegment",
        "postal_code": F.lpad(F.col("c_custkey").cast("string"), 12, F.lit("0")),
        "country": text("NATION_%d", "c_nationkey"),
    }


def _orders(read):
    count = F.col("o_orderkey") % 3 + 1
    df = versions(read("orders"), count, again=F.col("o_orderkey") % 13 == 5)
    ts = epoch_ms("o_orderdate") + F.col("n") * 30 * DAY
    deleted = (F.col("n") == 2) & (F.col("o_orderkey") % 7 == 1)
    return df, ts, F.col("o_orderkey") * 4 + F.col("n"), {
        "order_id": "o_orderkey",
        "customer_id": "o_custkey",
        "order_date": F.col("o_orderdate").cast("timestamp"),
        "status": pick("pending", "shipped", "delivered"),
        "shipping_method": "o_orderpriority",
        "op": F.when(F.col("n") == 0, "c").when(deleted, "d").otherwise("u"),
    }


def _order_items(read):
    df, ts, order, op = line_changes(read)
    lsn = (F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 4000 + order
    cents = F.floor(F.col("l_extendedprice") / F.col("l_quantity") * 100) / 100
    part = F.col("l_partkey")
    return df, ts, lsn, {
        "order_item_id": line_id(),
        "order_id": "l_orderkey",
        "book_id": "l_partkey",
        "quantity": (F.col("l_quantity") + F.col("n")).cast("int"),
        "price_at_purchase": F.when(part % 31 == 0, -cents).otherwise(cents),
        "discount": F.when(part % 19 != 0, F.when(part % 23 == 0, -F.col("l_discount"))
                           .otherwise(F.col("l_discount"))),
        "op": op, "order": order,
    }


def _carriers(read):
    df = versions(read("nation"), F.col("n_nationkey") % 2 + 1)
    return df, START + F.col("n") * 4 * YEAR, F.col("n_nationkey") * 4 + F.col("n"), {
        "carrier_id": "n_nationkey",
        "name": F.concat(F.lit("Carrier "), "n_name"),
        "contact_email": text("desk%d@carrier%d.example", "n", "n_nationkey"),
        "phone": text("+1 555 0100 %d", "n_nationkey"),
        "op": F.when(F.col("n") == 0, "c").when(F.col("n_nationkey") % 5 == 3, "d").otherwise("u"),
    }


def _shipping_services(read):
    df = versions(read("supplier"), F.col("s_suppkey") % 2 + 1)
    ts = START + F.col("n") * 3 * YEAR + F.col("s_suppkey") % 1000
    return df, ts, F.col("s_suppkey") * 4 + F.col("n"), {
        "service_id": "s_suppkey",
        "carrier_id": (F.col("s_nationkey") + F.col("n") * (F.col("s_suppkey") % 3)) % 25,
        "service_name": "s_name",
        "estimated_days": F.col("s_suppkey") % 10 + 1 + F.col("n"),
        "cost_estimate": F.col("s_acctbal"),
    }


def _shipments(read):
    df = versions(read("orders"), F.lit(2))
    day = F.col("o_orderdate").cast("date")
    late = (F.col("o_orderkey") % 11).cast("int")
    return df, epoch_ms("o_orderdate") + F.col("n") * 5 * DAY, F.col("o_orderkey") * 4 + F.col("n"), {
        "shipment_id": "o_orderkey",
        "order_id": "o_orderkey",
        "carrier_id": F.col("o_custkey") % 25,
        "service_id": F.col("o_custkey") % 10,
        "tracking_number": text("TRK%012d", "o_orderkey"),
        "shipping_status": F.when(F.col("n") == 0, "created")
        .when(F.col("o_orderstatus") == "F", "delivered").otherwise("in_transit"),
        "shipped_date": day,
        "expected_delivery_date": F.date_add(day, 7),
        "actual_delivery_date": F.when(F.col("n") == 1, F.date_add(day, late)),
        "shipping_cost": F.floor(F.col("o_totalprice")) / 100,
    }


def _shipment_events(read):
    df, ts, order, op = line_changes(read)
    lsn = (F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 4000 + order
    return df, ts, lsn, {
        "event_id": line_id(),
        "shipment_id": "l_orderkey",
        "status": F.when(F.col("l_linestatus") == "F", "delivered").otherwise("in_transit"),
        "location": F.when(F.col("l_returnflag") != "N", text("HUB_%d_%d", "l_suppkey", "n")),
        "op": op, "order": order,
    }


_FEEDS: dict[str, Callable] = {
    "authors": _authors, "books": _books, "customers": _customers, "orders": _orders,
    "order_items": _order_items, "carriers": _carriers, "shipping_services": _shipping_services,
    "shipments": _shipments, "shipment_events": _shipment_events,
}


def landed(spark: SparkSession, sf_dir: str, name: str, *, whole_text: bool = False,
           streaming: bool = False) -> DataFrame:
    """The change feed of an entity with its landing schema.

    ``whole_text`` leaves texts as long as the source has them, as in the
    messages that landing cuts.
    """
    reader = stream_table if streaming else table
    df, ts, lsn, columns = _FEEDS[name](lambda source: reader(spark, sf_dir, source))
    meta = {
        "op": columns.get("op", F.when(F.col("n") == 0, "c").otherwise("u")),
        "emitted_ts_ms": ts + 5 + columns.get("order", F.lit(0)),
        "ts_ms": ts,
        "connector_version": F.lit("3.0.0"),
        "transaction_id": lsn.cast("string"),
        "lsn": lsn,
    }
    meta = {k: meta[k] for k, _ in METADATA[SOURCES[name].flavor]}
    schema = landing_schema(name)
    values = {k: F.col(v) if isinstance(v, str) else v for k, v in {**columns, **meta}.items()}
    if not whole_text:
        for field in SOURCES[name].fields:
            if field.kind == "text":
                values[field.name] = truncated(values[field.name], field.length)
    return df.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in schema])


def messages(spark: SparkSession, sf_dir: str, name: str, *, streaming: bool = False) -> DataFrame:
    """The change messages of an entity, as its source topic holds them."""
    rows = landed(spark, sf_dir, name, whole_text=True, streaming=streaming)
    return to_message(rows if streaming else spread(rows), name)


def events(spark: SparkSession, sf_dir: str, *, streaming: bool = False) -> DataFrame:
    """The ``events`` table as a feed of user states, with deletes."""
    reader = stream_table if streaming else table
    return event_changes(reader(spark, sf_dir, "events"))


def event_changes(df: DataFrame) -> DataFrame:
    op = F.when(F.col("event_type") == "signup", "c").when(
        F.col("event_type") == "error", "d").otherwise("u")
    return df.select("user_id", "event_type", "value", op.alias("op"),
                     epoch_ms("ts").alias("ts_ms"), F.col("event_id").alias("lsn"))
