"""Checks of landed rows: value rules, uniqueness, references, transitions.

A source table's changes hold many versions of one row, so uniqueness means
that one value belongs to one key, not to one change.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..catalog import ORDER_STATUSES, SHIPMENT_STATUSES, SHIPMENT_TRANSITIONS, SOURCES
from .skew import ROWS_PER_CUT, with_neighbour


@dataclass(frozen=True)
class Reference:
    table: str
    column: str
    parent: str


def value_rules() -> dict[str, dict[str, Column]]:
    """Conditions that make a row invalid, by table."""

    def outside(column: str, allowed: Sequence[str]) -> Column:
        return ~F.coalesce(F.col(column).isin(*allowed), F.lit(False))

    return {
        "books": {"price_negative": F.col("price") < 0, "stock_negative": F.col("stock") < 0},
        "orders": {"status_unknown": outside("status", ORDER_STATUSES)},
        "order_items": {"quantity_not_positive": F.col("quantity") <= 0,
                        "price_negative": F.col("price_at_purchase") < 0,
                        "discount_negative": F.col("discount") < 0},
        "shipments": {"status_unknown": outside("shipping_status", SHIPMENT_STATUSES)},
        "shipment_events": {"status_unknown": outside("status", SHIPMENT_STATUSES)},
    }


UNIQUE: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("books", ("isbn",)), ("customers", ("email",)), ("carriers", ("name",)),
    ("order_items", ("order_id", "book_id")), ("shipments", ("tracking_number",)),
)

REFERENCES: tuple[Reference, ...] = (
    Reference("books", "author_id", "authors"),
    Reference("orders", "customer_id", "customers"),
    Reference("order_items", "order_id", "orders"),
    Reference("order_items", "book_id", "books"),
    Reference("shipping_services", "carrier_id", "carriers"),
    Reference("shipments", "carrier_id", "carriers"),
    Reference("shipments", "service_id", "shipping_services"),
    Reference("shipments", "order_id", "orders"),
    Reference("shipment_events", "shipment_id", "shipments"),
)


def _value(rows: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    """Fields for the values of all ``columns``; different values give different fields.

    One or two whole numbers stay numbers, all else becomes one text.
    """
    types = dict(rows.select(*columns).dtypes)
    if len(columns) <= 2 and set(types.values()) <= {"bigint", "int"}:
        return {n: F.col(c) for n, c in zip(("number", "second"), columns)}
    if len(columns) == 1:
        return {"text": F.col(columns[0])}
    return {"text": F.to_json(F.array(*[F.col(c).cast("string") for c in columns]))}


@dataclass(frozen=True)
class _Rule:
    """A rule counts the groups (or, for value rules, the rows) that break it."""

    name: str
    counted: Column


class _Entries:
    """What the rows of each table tell about the rules, in one shape for all rules.

    An entry belongs to a group: ``scope, number, second, text``. A uniqueness rule groups by the
    values that must be unique and keeps the lowest and highest key; all references to one
    parent share the scope of its keys, with one bit of ``wanted`` for each of them; a broken
    value rule counts rows in a group of its own.
    """

    SCHEMA = ("scope INT, number BIGINT, second BIGINT, text STRING, low BIGINT, high BIGINT, "
              "known BOOLEAN, wanted BIGINT, broken BIGINT")
    REST = {"known": False, "wanted": 0, "broken": 0}

    def __init__(self, tables: Mapping[str, DataFrame]) -> None:
        self.rules: list[_Rule] = []
        self.of: dict[str, list[Column]] = {t: [] for t in tables}
        scopes = iter(range(1 << 30))
        for table, rules in value_rules().items():
            for name, condition in rules.items() if table in tables else ():
                scope = next(scopes)
                self._add(table, scope, condition, broken=F.lit(1))
                self._rule(f"{table}.{name}", scope, F.col("broken"))
        for table, columns in UNIQUE:
            if table in tables:
                scope, key = next(scopes), F.col(SOURCES[table].key)
                present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
                self._add(table, scope, present, low=key, high=key, **_value(tables[table], columns))
                self._rule(f"{table}.{'+'.join(columns)}_not_unique", scope,
                           (F.col("low") < F.col("high")).cast("bigint"))
        for parent in dict.fromkeys(r.parent for r in REFERENCES):
            used = [r for r in REFERENCES if r.parent == parent and {r.table, parent} <= set(tables)]
            if used:
                self._references(parent, used, next(scopes))

    def _references(self, parent: str, used: Sequence[Reference], scope: int) -> None:
        key = F.col(SOURCES[parent].key)
        self._add(parent, scope, key.isNotNull(), number=key, known=F.lit(True))
        for bit, r in enumerate(used):
            value = F.col(r.column)
            self._add(r.table, scope, value.isNotNull(), number=value, wanted=F.lit(1 << bit))
            self._rule(f"{r.table}.{r.column}_without_{parent}", scope, (
                ~F.col("known") & (F.col("wanted").bitwiseAND(1 << bit) != 0)).cast("bigint"))

    def _rule(self, name: str, scope: int, counted: Column) -> None:
        self.rules.append(_Rule(name, F.when(F.col("scope") == scope, counted)))

    def _add(self, table: str, scope: int, given: Column, **values: Column) -> None:
        fields = [given.alias("given"), F.lit(scope).alias("scope")]
        for field in self.SCHEMA.split(", ")[1:]:
            name, kind = field.split()
            fields.append(values.get(name, F.lit(self.REST.get(name))).cast(kind).alias(name))
        self.of[table].append(F.struct(*fields))


def constraint_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All rules whose tables are given: ``rule``, ``violations``.

    Value rules count rows; uniqueness rules count values that more than one key holds;
    references count distinct foreign keys without a parent. NULL is no value and refers to
    nothing. Each table is read once, for all its rules together, and all rules of all tables
    share one exchange, which values enter once a map task, so hot values vanish before it.
    """
    entries = _Entries(tables)
    parts = [tables[t].select(F.explode(F.array(*e)).alias("e")).select("e.*").where("given")
             for t, e in entries.of.items() if e]
    groups = reduce(DataFrame.unionByName, parts).groupBy("scope", "number", "second", "text").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.bool_or("known").alias("known"),
        F.bit_or("wanted").alias("wanted"), F.sum("broken").alias("broken"))
    counts = groups.agg(*[F.coalesce(F.sum(r.counted), F.lit(0)).alias(f"r{i}")
                          for i, r in enumerate(entries.rules)])
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.col(f"r{i}").cast("bigint").alias("violations"))
        for i, r in enumerate(entries.rules)])).alias("r")).select("r.*")


def invalid_rows(rows: DataFrame, table: str) -> DataFrame:
    """The rows that break a value rule, with the names of the rules broken."""
    broken = F.array_compact(F.array(*[
        F.when(c, F.lit(n)) for n, c in value_rules()[table].items()]))
    return rows.withColumn("broken", broken).where(F.size("broken") > 0)


def invalid_transitions(changes: DataFrame, key: str = "shipment_id",
                        status: str = "shipping_status", ts: str = "ts_ms", *,
                        allowed: Mapping[str, Sequence[str]] = SHIPMENT_TRANSITIONS,
                        tie: Sequence[str] = ("emitted_ts_ms",),
                        rows_per_cut: int = ROWS_PER_CUT) -> DataFrame:
    """Status changes between neighbouring rows of a key that are not allowed."""
    tie = [c for c in tie if c in changes.columns]
    rows = with_neighbour(changes.select(key, status, ts, *tie), [key], ts, tie=tie,
                          carry=[status, ts], rows_per_cut=rows_per_cut)
    pairs = [f"{a}>{b}" for a, targets in allowed.items() for b in targets]
    step = F.concat_ws(">", status, f"next_{status}")
    return rows.where(
        F.col(f"next_{status}").isNotNull()
        & (F.col(status) != F.col(f"next_{status}")) & ~step.isin(*pairs)
    ).select(key, F.col(f"next_{ts}").alias(ts), F.col(status).alias("from_status"),
             F.col(f"next_{status}").alias("to_status"))
