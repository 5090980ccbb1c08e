"""Rebuild of the whole star from its source topics: landings, dimensions, facts.

Every layer is written before the next one reads it, so later layers read
narrow columns from parquet, a lost executor costs only its own tasks, and row
bounds for broadcasts come from file footers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..catalog import DIMENSIONS, FACTS, SOURCES
from ..config import Settings
from ..functions.cdc import cut_rows, parse_changes
from ..sources.topics import read_changes, read_landing, read_rows
from . import dimensions, facts
from .landing import land


def land_table(spark: SparkSession, table: str, settings: Settings, *, cut_texts: bool = True,
               **source) -> None:
    """Write a landing, its rejected messages, and those whose texts it cuts (``.cut``)."""
    messages = read_changes(spark, table, settings, **source)
    landed, rejected = land(messages, table, cut_texts=cut_texts)
    target = settings.dataset(SOURCES[table].landing)
    landed.write.mode("overwrite").parquet(target)
    rejected.write.mode("overwrite").parquet(f"{target}.rejected")
    cut = cut_rows(parse_changes(messages, table, cut_texts=False), table)
    (cut if cut_texts else cut.limit(0)).write.mode("overwrite").parquet(f"{target}.cut")


def build_dimension(spark: SparkSession, name: str, settings: Settings, **options) -> None:
    """Write a dimension's versions; ``options`` go to the version builder."""
    landing = {t: read_landing(spark, t, settings) for t in SOURCES}
    if name == "orders":
        versions = dimensions.d_orders(landing["orders"], **options)
    elif name == "customers":
        versions = dimensions.d_customers(landing["customers"], **options)
    elif name == "books":
        versions = dimensions.d_books(landing["books"], landing["authors"],
                                      author_rows=landing["authors"].count(), **options)
    elif name == "carrier_services":
        versions = dimensions.d_carrier_services(
            landing["shipping_services"], landing["carriers"],
            carrier_rows=landing["carriers"].count(), **options)
    else:
        raise ValueError(f"unknown dimension: {name}")
    versions.write.mode("overwrite").parquet(settings.dataset(DIMENSIONS[name].topic))


def built_dimension(spark: SparkSession, name: str, settings: Settings) -> DataFrame:
    dimension = DIMENSIONS[name]
    return read_rows(spark, settings.dataset(dimension.topic), dimension.schema)


def build_fact(spark: SparkSession, name: str, settings: Settings, *,
               inclusive_end: bool = False) -> None:
    built = {n: built_dimension(spark, n, settings) for n in DIMENSIONS}
    if name == "order_items":
        rows = facts.f_order_items(
            read_landing(spark, "order_items", settings), built["orders"], built["customers"],
            built["books"], customer_rows=built["customers"].count(),
            book_rows=built["books"].count(), inclusive_end=inclusive_end)
    elif name == "shipment_events":
        rows = facts.f_shipment_events(
            read_landing(spark, "shipment_events", settings),
            read_landing(spark, "shipments", settings), built["orders"],
            built["carrier_services"], service_rows=built["carrier_services"].count(),
            inclusive_end=inclusive_end)
    else:
        raise ValueError(f"unknown fact: {name}")
    rows.write.mode("overwrite").parquet(settings.dataset(FACTS[name].topic))


def rebuild(spark: SparkSession, settings: Settings, *, cut_texts: bool = True, **source) -> None:
    """All layers in order. ``source`` says how to read the change topics.

    ``cut_texts=False`` lands texts whole instead of cut to their declared lengths.
    """
    for table in SOURCES:
        land_table(spark, table, settings, cut_texts=cut_texts, **source)
    for name in DIMENSIONS:
        build_dimension(spark, name, settings)
    for name in FACTS:
        build_fact(spark, name, settings)
