"""Business questions on the star."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import packed_key


def sales_by(facts: DataFrame, dimension: DataFrame, sk: str, columns: Sequence[str]) -> DataFrame:
    """Items, units and sales per dimension attribute.

    Facts are summed per surrogate key before the join, so the join sees one
    row per version and a best seller costs no more than any other key.
    """
    facts = facts.withColumn(sk, packed_key(sk))
    per_version = facts.groupBy(sk).agg(
        F.count("*").alias("items"), F.sum("quantity").alias("units"),
        F.sum("priceTotal").alias("sales"))
    return per_version.join(dimension.select(packed_key(sk), *columns), sk).groupBy(*columns).agg(
        F.sum("items").alias("items"), F.sum("units").alias("units"),
        F.round(F.sum("sales"), 4).alias("sales"))


def delivery_by_service(facts: DataFrame, services: DataFrame) -> DataFrame:
    """Delivery time, delay and cost of shipments per service and carrier.

    Events of one shipment repeat its dates and may have seen several versions of its
    service, so each shipment is counted once, under the newest version its events saw.
    """
    days = F.date_diff("actualDeliveryDate", "shippedDate")
    delay = F.date_diff("actualDeliveryDate", "expectedDeliveryDate")
    seen = facts.groupBy("carrierServiceSk", "shipmentId").agg(
        F.max(days).alias("days"), F.max(delay).alias("delay"),
        F.max("shippingCost").alias("cost"))
    named = services.select(
        "carrierServiceSk", F.struct("validFrom", "carrierServiceSk").alias("version"),
        F.struct("serviceName", "carrierName").alias("service"))
    shipments = seen.join(named, "carrierServiceSk").groupBy("shipmentId").agg(
        F.max_by("service", "version").alias("service"), F.max("days").alias("days"),
        F.max("delay").alias("delay"), F.max("cost").alias("cost"))
    return shipments.groupBy("service.serviceName", "service.carrierName").agg(
        F.count("*").alias("shipments"), F.count_if(F.col("delay") > 0).alias("late"),
        F.round(F.try_divide(F.sum("days"), F.count("days")), 4).alias("avg_days"),
        F.round(F.sum("cost"), 2).alias("cost"))
