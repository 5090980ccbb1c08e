"""The queries of :mod:`queries` as SQL over the given tables."""

from __future__ import annotations

END = 253402300799000
DAY = 86_400_000
YEAR = 365 * DAY
START = 788_832_000_000

_MARK = "(l_orderkey + l_linenumber + l_partkey)"
_LINE_COUNT = f"CASE WHEN {_MARK} % 9 = 0 THEN 3 WHEN {_MARK} % 4 = 0 THEN 2 ELSE 1 END"
_LINE_TIME = (f"epoch_ms(l_shipdate) + (CASE WHEN {_MARK} % 5 = 0 THEN greatest(n - 1, 0) "
              f"ELSE n END) * {2 * DAY}")
_LINE_ID = "(l_orderkey * 8 + l_linenumber) * 100000000 + l_partkey"
_LINE_ORDER = "n * 1000 + l_suppkey % 1000"
_LINE_LSN = f"((l_orderkey * 8 + l_linenumber) * 4000 + {_LINE_ORDER})::BIGINT"
_CENTS = "floor(l_extendedprice / l_quantity * 100) / 100"
# Last change delivered twice; operations other than create, then updates; order within an instant.
_AGAIN = {"orders": "o_orderkey % 13 = 5", "order_items": f"{_MARK} % 10 = 3",
          "shipment_events": f"{_MARK} % 10 = 3"}
_LINE_OP = "['c', 'u', 'd'][n + 1]"
_OPS = {"orders": "CASE WHEN n = 0 THEN 'c' WHEN n = 2 AND o_orderkey % 7 = 1 THEN 'd' ELSE 'u' END",
        "carriers": "CASE WHEN n = 0 THEN 'c' WHEN n_nationkey % 5 = 3 THEN 'd' ELSE 'u' END",
        "order_items": _LINE_OP, "shipment_events": _LINE_OP}
_ORDERS = {"order_items": _LINE_ORDER, "shipment_events": _LINE_ORDER}

# Feed columns as SQL; ``n`` is the version number.
_SQL_FEEDS: dict[str, tuple[str, str, str, dict[str, str]]] = {
    "authors": (
        "nation", "n_nationkey % 2 + 1", f"{START} + n * {2 * YEAR}", {
            "author_id": "n_nationkey::BIGINT", "first_name": "n_name",
            "last_name": "'v' || n", "biography": "left(repeat(n_name || ' ', 8), 50)",
            "country": "'REGION_' || n_regionkey", "lsn": "(n_nationkey * 4 + n)::BIGINT"}),
    "books": (
        "part", "p_partkey % 3 + 1", f"{START} + n * {YEAR} + p_partkey % 1000", {
            "book_id": "p_partkey", "title": "left(p_name, 50)", "author_id": "(p_partkey + n * (p_partkey % 2)) % 25",
            "isbn": "'978' || lpad(p_partkey::VARCHAR, 10, '0')",
            "price": "p_retailprice::DECIMAL(10,2)::DOUBLE",
            "published_date": "DATE '1960-01-01' + (p_partkey % 20000)::INT",
            "description": "left(p_brand || ' ' || p_type, 500)", "genre": "left(p_type, 50)",
            "stock": "(p_size + n)::INT", "lsn": "(p_partkey * 4 + n)::BIGINT"}),
    "customers": (
        "customer", "c_custkey % 2 + 1", f"{START} + n * {3 * YEAR}", {
            "customer_id": "c_custkey", "first_name": "left(c_name, 8)",
            "last_name": "substring(c_name, 10, 9)",
            "email": "'c' || c_custkey || '@v' || n || '.example'",
            "phone": "c_nationkey || '-555-0100'",
            "created_at": f"make_timestamp(({START} + (c_custkey % 86400) * 1000) * 1000)",
            "street_address": "c_custkey || ' Main Street'", "city": "'CITY_' || c_nationkey",
            "state": "c_mktsegment",
            "postal_code": "left(lpad(c_custkey::VARCHAR, 12, '0'), 10)",
            "country": "'NATION_' || c_nationkey", "lsn": "(c_custkey * 4 + n)::BIGINT"}),
    "orders": (
        "orders", "o_orderkey % 3 + 1", f"epoch_ms(o_orderdate) + n * {30 * DAY}", {
            "order_id": "o_orderkey", "customer_id": "o_custkey", "order_date": "o_orderdate",
            "status": "['pending', 'shipped', 'delivered'][n + 1]",
            "shipping_method": "left(o_orderpriority, 20)",
            "lsn": "(o_orderkey * 4 + n)::BIGINT"}),
    "order_items": (
        "lineitem", _LINE_COUNT, _LINE_TIME, {
            "order_item_id": _LINE_ID, "order_id": "l_orderkey",
            "book_id": "l_partkey", "quantity": "(l_quantity + n)::INT",
            "price_at_purchase": f"CASE WHEN l_partkey % 31 = 0 THEN -({_CENTS}) ELSE {_CENTS} END",
            "discount": "(CASE WHEN l_partkey % 19 = 0 THEN NULL WHEN l_partkey % 23 = 0 "
                        "THEN -l_discount ELSE l_discount END)::DECIMAL(10,2)::DOUBLE",
            "lsn": _LINE_LSN}),
    "carriers": (
        "nation", "n_nationkey % 2 + 1", f"{START} + n * {4 * YEAR}", {
            "carrier_id": "n_nationkey::BIGINT", "name": "'Carrier ' || n_name",
            "contact_email": "'desk' || n || '@carrier' || n_nationkey || '.example'",
            "phone": "left('+1 555 0100 ' || n_nationkey, 12)",
            "lsn": "(n_nationkey * 4 + n)::BIGINT"}),
    "shipping_services": (
        "supplier", "s_suppkey % 2 + 1", f"{START} + n * {3 * YEAR} + s_suppkey % 1000", {
            "service_id": "s_suppkey", "carrier_id": "((s_nationkey + n * (s_suppkey % 3)) % 25)::BIGINT",
            "service_name": "s_name", "estimated_days": "(s_suppkey % 10 + 1 + n)::INT",
            "cost_estimate": "s_acctbal::DECIMAL(10,2)::DOUBLE",
            "lsn": "(s_suppkey * 4 + n)::BIGINT"}),
    "shipments": (
        "orders", "2", f"epoch_ms(o_orderdate) + n * {5 * DAY}", {
            "shipment_id": "o_orderkey", "order_id": "o_orderkey",
            "carrier_id": "o_custkey % 25", "service_id": "o_custkey % 10",
            "tracking_number": "'TRK' || lpad(o_orderkey::VARCHAR, 12, '0')",
            "shipping_status": "CASE WHEN n = 0 THEN 'created' WHEN o_orderstatus = 'F' "
                               "THEN 'delivered' ELSE 'in_transit' END",
            "shipped_date": "o_orderdate::DATE",
            "expected_delivery_date": "o_orderdate::DATE + 7",
            "actual_delivery_date":
                "CASE WHEN n = 1 THEN o_orderdate::DATE + (o_orderkey % 11)::INT END",
            "shipping_cost": "(floor(o_totalprice) / 100)::DECIMAL(10,2)::DOUBLE",
            "lsn": "(o_orderkey * 4 + n)::BIGINT"}),
    "shipment_events": (
        "lineitem", _LINE_COUNT, _LINE_TIME, {
            "event_id": _LINE_ID, "shipment_id": "l_orderkey",
            "status": "CASE WHEN l_linestatus = 'F' THEN 'delivered' ELSE 'in_transit' END",
            "location": "CASE WHEN l_returnflag <> 'N' THEN 'HUB_' || l_suppkey || '_' || n END",
            "lsn": _LINE_LSN}),
}
_MYSQL = {"carriers", "shipping_services", "shipments", "shipment_events"}
_DATES = {"published_date", "shipped_date", "expected_delivery_date", "actual_delivery_date"}
_TIMES = {"order_date", "created_at"}


def feed(name: str) -> str:
    table, count, ts, columns = _SQL_FEEDS[name]
    listed = ", ".join(f"{sql} AS {c}" for c, sql in columns.items())
    op = _OPS.get(name, "CASE WHEN n = 0 THEN 'c' ELSE 'u' END")
    numbers = f"range(0, ({count})::BIGINT)"
    if name in _AGAIN:
        numbers = (f"CASE WHEN {_AGAIN[name]} THEN list_append({numbers}, ({count})::BIGINT - 1) "
                   f"ELSE {numbers} END")
    return (f"SELECT {listed}, {op} AS op, ({ts})::BIGINT AS ts_ms, "
            f"({ts})::BIGINT + 5 + {_ORDERS.get(name, '0')} AS emitted_ts_ms "
            f"FROM (SELECT *, unnest({numbers}) AS n FROM {table})")


def distinct_changes(name: str, key: str) -> str:
    """The last change of each key and instant."""
    return (f"SELECT * FROM ({feed(name)}) QUALIFY row_number() OVER "
            f"(PARTITION BY {key}, ts_ms ORDER BY emitted_ts_ms DESC) = 1")


def live(name: str, key: str) -> str:
    """The last change of each key that was not deleted, at the time of its first change."""
    return f"""
SELECT * EXCLUDE (created) REPLACE (created AS ts_ms) FROM (
  SELECT *, min(ts_ms) OVER (PARTITION BY {key}) AS created FROM ({feed(name)})
  QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY ts_ms DESC, emitted_ts_ms DESC) = 1)
WHERE op <> 'd'"""


def _text(column: str) -> str:
    if column in _DATES:
        return f"{column}::DATE::VARCHAR AS {column}"
    if column in _TIMES:
        return f"strftime({column}, '%Y-%m-%d %H:%M:%S') AS {column}"
    return column


def landing(name: str) -> str:
    columns = [c for c in _SQL_FEEDS[name][3] if c != "lsn"]
    tail = "" if name in _MYSQL else ", lsn"
    return (f"SELECT {', '.join(_text(c) for c in columns)}, op, emitted_ts_ms::BIGINT AS emitted_ts_ms, "
            f"ts_ms, '3.0.0' AS connector_version, lsn::VARCHAR AS transaction_id{tail} "
            f"FROM ({feed(name)})")


def ends(source: str, key: str, ts: str = "ts_ms") -> str:
    return f"lead({ts}) OVER (PARTITION BY {key} ORDER BY {ts})"


EVENT_FEED = """
SELECT user_id, event_type, value, event_id, epoch_us(ts) // 1000 AS ts_ms,
       CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op
FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, epoch_us(ts) // 1000 ORDER BY event_id DESC) = 1
"""


def event_versions(source: str = EVENT_FEED, extra: str = "") -> str:
    return f"""
SELECT md5(concat_ws('#', 'd_events', user_id, ts_ms)) AS "eventSk", user_id AS "userId",
       event_type AS "eventType", value, ts_ms AS "validFrom",
       CASE WHEN op = 'd' THEN {END}
            ELSE coalesce({ends('', 'user_id')} - 1, {END}) END AS "validTo"{extra}
FROM ({source})"""


EVENT_CHANGELOG = f"""
WITH v AS ({event_versions()})
SELECT * REPLACE ({END} AS "validTo") FROM v
UNION ALL SELECT * FROM v WHERE "validTo" <> {END}"""

_EVENT_NAMES = '"eventSk", "userId", "eventType", value, "validFrom"'

EVENT_WINDOWS = f"""
WITH v AS ({event_versions()}),
w AS (SELECT *, "validFrom" - "validFrom" % 100000 + 100000 AS window_end FROM v)
SELECT {_EVENT_NAMES}, {END} AS "validTo" FROM w
WHERE "validTo" = {END} OR "validTo" + 1 > window_end
UNION ALL SELECT {_EVENT_NAMES}, "validTo" FROM w WHERE "validTo" <> {END}"""

NOOP_FEED = f"""
SELECT * FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts_ms) AS before
               FROM ({EVENT_FEED}))
WHERE before IS NULL OR before <> event_type OR op = 'd'"""

INTEGRITY = f"""
WITH v AS (SELECT "userId", "validFrom", "validTo",
                  lead("validFrom") OVER (PARTITION BY "userId" ORDER BY "validFrom")
                    AS "next_validFrom"
           FROM ({event_versions()}))
SELECT * FROM (
  SELECT *, CASE WHEN "validTo" < "validFrom" THEN 'inverted'
                 WHEN "next_validFrom" <= "validTo" THEN 'overlap'
                 WHEN "next_validFrom" > "validTo" + 1 THEN 'gap' END AS problem FROM v)
WHERE problem IS NOT NULL"""


def versions(source: str, entity: str, sk: str, key: str, columns: dict[str, str]) -> str:
    listed = ", ".join(f'{sql} AS "{name}"' for name, sql in columns.items())
    return f"""
SELECT md5(concat_ws('#', '{entity}', {key}, ts_ms)) AS "{sk}", {listed},
       ts_ms AS "validFrom", CASE WHEN op = 'd' THEN {END}
       ELSE coalesce({ends('', key)} - 1, {END}) END AS "validTo"
FROM ({source})"""


def latest_state_join(child: str, child_key: str, parent: str, on: str, listed: str) -> str:
    return f"""
SELECT {listed}, c.op, greatest(c.ts_ms, p.ts_ms) AS ts_ms
FROM (SELECT *, CASE WHEN op = 'd' THEN ts_ms + 1
             ELSE coalesce({ends('', child_key)}, {END}) END AS until
      FROM ({distinct_changes(child, child_key)})) c
JOIN (SELECT *, coalesce({ends('', on)}, {END}) AS until
      FROM ({distinct_changes(parent, on)}) WHERE op <> 'd') p
  ON c.{on} = p.{on} AND p.ts_ms < c.until AND c.ts_ms < p.until"""


BOOKS_AUTHORS = latest_state_join(
    "books", "book_id", "authors", "author_id",
    "c.book_id, c.author_id, c.title, c.isbn, c.published_date, c.genre, c.lsn, "
    "p.first_name AS author_first_name, p.last_name AS author_last_name, "
    "p.country AS author_country")
SERVICES_CARRIERS = latest_state_join(
    "shipping_services", "service_id", "carriers", "carrier_id",
    "c.service_id, c.carrier_id, c.service_name, c.estimated_days, c.cost_estimate, "
    "p.name AS carrier_name, p.contact_email AS carrier_contact_email, p.phone AS carrier_phone")

D_ORDERS = versions(distinct_changes("orders", "order_id"), "d_orders", "orderSk", "order_id", {
    "orderId": "order_id", "customerId": "customer_id", "status": "status",
    "shippingMethod": "shipping_method", "orderDate": "order_date::DATE::VARCHAR"})
D_CUSTOMERS = versions(distinct_changes("customers", "customer_id"), "d_customers", "customerSk", "customer_id", {
    "customerId": "customer_id", "email": "email", "phone": "phone",
    "streetAddress": "street_address", "city": "city", "state": "state",
    "postalCode": "postal_code", "country": "country", "firstName": "first_name",
    "lastName": "last_name"})
D_BOOKS = versions(BOOKS_AUTHORS, "d_books", "bookSk", "book_id", {
    "bookId": "book_id", "authorId": "author_id", "title": "title", "isbn": "isbn",
    "publishedDate": "published_date::DATE::VARCHAR", "genre": "genre",
    "authorFirstName": "author_first_name", "authorLastName": "author_last_name",
    "authorCountry": "author_country"})
D_SERVICES = versions(SERVICES_CARRIERS, "d_carrier_services", "carrierServiceSk", "service_id", {
    "serviceId": "service_id", "serviceName": "service_name", "carrierName": "carrier_name",
    "carrierContactEmail": "carrier_contact_email", "carrierPhone": "carrier_phone",
    "estimatedDays": "estimated_days", "costEstimate": "cost_estimate"})

_ITEMS = feed("order_items")


def pit(listed: str, test: str = "<") -> str:
    return f"""
SELECT {listed} FROM ({_ITEMS}) i JOIN ({D_ORDERS}) o
  ON i.order_id = o."orderId" AND i.ts_ms >= o."validFrom" AND i.ts_ms {test} o."validTo\""""


UNMATCHED = f"""
SELECT order_item_id, order_id, book_id, ts_ms FROM ({_ITEMS}) i
WHERE NOT EXISTS (SELECT 1 FROM ({D_ORDERS}) o WHERE i.order_id = o."orderId"
                  AND i.ts_ms >= o."validFrom" AND i.ts_ms < o."validTo")"""

_ITEM_SK = "md5(concat_ws('#', 'order_item', order_item_id, book_id, ts_ms))"


def valid(fact: str, alias: str) -> str:
    return f'{fact}.ts_ms >= {alias}."validFrom" AND {fact}.ts_ms < {alias}."validTo"'


F_ORDER_ITEMS = f"""
WITH with_order AS MATERIALIZED (
  SELECT i.*, o."orderSk", o."customerId" FROM ({live('order_items', 'order_item_id')}) i
  JOIN ({D_ORDERS}) o ON i.order_id = o."orderId" AND {valid('i', 'o')}),
with_customer AS MATERIALIZED (
  SELECT i.*, c."customerSk" FROM with_order i
  JOIN ({D_CUSTOMERS}) c ON i."customerId" = c."customerId" AND {valid('i', 'c')})
SELECT {_ITEM_SK} AS "orderItemSk", "orderSk", b."bookSk", "customerSk",
       order_item_id AS "orderItemId", quantity, price_at_purchase AS "priceAtPurchase",
       discount, ts_ms AS "transactionTime",
       round(quantity * price_at_purchase * (1 - discount), 4) AS "priceTotal"
FROM with_customer i JOIN ({D_BOOKS}) b ON i.book_id = b."bookId" AND {valid('i', 'b')}"""

EVENTS_JOINED = latest_state_join(
    "shipment_events", "event_id", "shipments", "shipment_id",
    "c.event_id, c.shipment_id, c.status, c.location, p.order_id, p.service_id, "
    "p.shipping_status, p.actual_delivery_date")
_SHIPMENTS_LATEST = f"""
SELECT * FROM ({feed('shipments')})
QUALIFY row_number() OVER (PARTITION BY shipment_id ORDER BY ts_ms DESC) = 1"""
EVENTS_LATEST = f"""
SELECT e.shipment_id, e.event_id, e.status, e.location, e.ts_ms, s.order_id, s.service_id,
       s.tracking_number, s.shipping_status, s.shipped_date::VARCHAR AS shipped_date,
       s.expected_delivery_date::VARCHAR AS expected_delivery_date,
       s.actual_delivery_date::VARCHAR AS actual_delivery_date, s.shipping_cost
FROM ({live('shipment_events', 'event_id')}) e JOIN ({_SHIPMENTS_LATEST}) s USING (shipment_id)"""
F_SHIPMENT_EVENTS = f"""
WITH latest AS MATERIALIZED ({EVENTS_LATEST}),
with_order AS MATERIALIZED (
  SELECT e.*, o."orderSk" FROM latest e
  JOIN ({D_ORDERS}) o ON e.order_id = o."orderId" AND {valid('e', 'o')})
SELECT md5(concat_ws('#', 'shipment_event', event_id, ts_ms)) AS "shipmentEventSk",
       "orderSk", v."carrierServiceSk", shipment_id AS "shipmentId",
       event_id AS "shipmentEventId", e.status, location,
       tracking_number AS "trackingNumber", shipping_status AS "shippingStatus",
       shipped_date AS "shippedDate", expected_delivery_date AS "expectedDeliveryDate",
       actual_delivery_date AS "actualDeliveryDate", shipping_cost AS "shippingCost"
FROM with_order e
JOIN ({D_SERVICES}) v ON e.service_id = v."serviceId" AND {valid('e', 'v')}"""

INSERT_IGNORE = f"""
SELECT {_ITEM_SK} AS "orderItemSk", order_item_id AS "orderItemId", quantity,
       ts_ms AS "transactionTime"
FROM ({live('order_items', 'order_item_id')}) WHERE ts_ms >= {START + 3 * YEAR}"""

QUARANTINE = f"""
SELECT error, count(*) AS messages FROM (
  SELECT CASE shipping_method WHEN '5-LOW' THEN 'malformed message'
              WHEN '4-NOT SPECIFIED' THEN 'no operation or time' END AS error
  FROM ({feed('orders')}))
WHERE error IS NOT NULL GROUP BY error"""


REJECTED = f"""
SELECT error, count(*) AS messages FROM (
  SELECT CASE WHEN book_id % 10 = 0 THEN 'malformed message'
              WHEN book_id % 10 IN (1, 2) AND discount IS NOT NULL THEN 'unreadable discount'
              WHEN book_id % 10 = 3 THEN 'missing quantity'
              WHEN book_id % 10 = 4 THEN 'no operation or time' END AS error
  FROM ({_ITEMS}))
WHERE error IS NOT NULL GROUP BY error"""


def sales(dimension: str, sk: str, columns: str) -> str:
    return f"""
SELECT {columns}, count(*) AS items, sum(quantity)::BIGINT AS units,
       round(sum("priceTotal"), 4) AS sales
FROM ({F_ORDER_ITEMS}) f JOIN ({dimension}) d ON f."{sk}" = d."{sk}"
GROUP BY {columns}"""


DELIVERY = f"""
WITH f AS MATERIALIZED ({F_SHIPMENT_EVENTS}), v AS MATERIALIZED ({D_SERVICES}),
s AS (
  SELECT "shipmentId", max("actualDeliveryDate"::DATE - "shippedDate"::DATE) AS days,
         max("actualDeliveryDate"::DATE - "expectedDeliveryDate"::DATE) AS delay,
         max("shippingCost") AS cost
  FROM f SEMI JOIN v USING ("carrierServiceSk") GROUP BY "shipmentId"),
n AS (
  SELECT DISTINCT ON ("shipmentId") "shipmentId", "serviceName", "carrierName"
  FROM f JOIN v USING ("carrierServiceSk")
  ORDER BY "shipmentId", v."validFrom" DESC, "carrierServiceSk" DESC)
SELECT "serviceName", "carrierName", count(*) AS shipments,
       sum((delay > 0)::INT)::BIGINT AS late,
       round(sum(days) / count(days), 4) AS avg_days, round(sum(cost), 2) AS cost
FROM s JOIN n USING ("shipmentId") GROUP BY "serviceName", "carrierName\""""


def _constraints() -> str:
    def rule(name: str, sql: str) -> str:
        return f"SELECT '{name}' AS rule, ({sql})::BIGINT AS violations"

    def count(table: str, test: str) -> str:
        return f"SELECT count(*) FROM ({feed(table)}) WHERE {test}"

    shipping = ("('created', 'in_transit', 'delivered', 'delayed', 'returned', 'cancelled')")
    parts = [
        rule("books.price_negative", count("books", "price < 0")),
        rule("books.stock_negative", count("books", "stock < 0")),
        rule("orders.status_unknown", count(
            "orders", "status NOT IN ('pending', 'shipped', 'delivered', 'cancelled')")),
        rule("order_items.quantity_not_positive", count("order_items", "quantity <= 0")),
        rule("order_items.price_negative", count("order_items", "price_at_purchase < 0")),
        rule("order_items.discount_negative", count("order_items", "discount < 0")),
        rule("shipments.status_unknown",
             count("shipments", f"shipping_status NOT IN {shipping}")),
        rule("shipment_events.status_unknown",
             count("shipment_events", f"status NOT IN {shipping}")),
    ]
    unique = [("books", "isbn", "book_id"), ("customers", "email", "customer_id"),
              ("carriers", "name", "carrier_id"),
              ("order_items", "order_id, book_id", "order_item_id"),
              ("shipments", "tracking_number", "shipment_id")]
    for table, columns, key in unique:
        name = columns.replace(", ", "+")
        parts.append(rule(
            f"{table}.{name}_not_unique",
            f"SELECT count(*) FROM (SELECT {columns} FROM ({feed(table)}) "
            f"GROUP BY {columns} HAVING count(DISTINCT {key}) > 1)"))
    references = [
        ("books", "author_id", "authors", "author_id"),
        ("orders", "customer_id", "customers", "customer_id"),
        ("order_items", "order_id", "orders", "order_id"),
        ("order_items", "book_id", "books", "book_id"),
        ("shipping_services", "carrier_id", "carriers", "carrier_id"),
        ("shipments", "carrier_id", "carriers", "carrier_id"),
        ("shipments", "service_id", "shipping_services", "service_id"),
        ("shipments", "order_id", "orders", "order_id"),
        ("shipment_events", "shipment_id", "shipments", "shipment_id")]
    for table, column, parent, key in references:
        parts.append(rule(
            f"{table}.{column}_without_{parent}",
            f"SELECT count(DISTINCT {column}) FROM ({feed(table)}) WHERE {column} NOT IN "
            f"(SELECT {key} FROM ({feed(parent)}))"))
    return " UNION ALL ".join(parts)


TRANSITIONS = f"""
SELECT shipment_id, after AS ts_ms, from_status, to_status FROM (
  SELECT shipment_id, shipping_status AS from_status,
         lead(ts_ms) OVER (PARTITION BY shipment_id ORDER BY ts_ms) AS after,
         lead(shipping_status) OVER (PARTITION BY shipment_id ORDER BY ts_ms) AS to_status
  FROM ({feed('shipments')}))
WHERE from_status <> to_status AND (from_status || '>' || to_status) NOT IN (
  'created>in_transit', 'created>cancelled', 'in_transit>delivered', 'in_transit>delayed',
  'in_transit>returned', 'in_transit>cancelled', 'delayed>in_transit', 'delayed>delivered',
  'delayed>returned', 'delayed>cancelled')"""


def batch_oracles() -> dict[str, str]:
    names = {"shipping_services": "landing_services"}
    return {
        **{names.get(t, f"landing_{t}"): landing(t) for t in _SQL_FEEDS},
        "scd2_changelog_events": EVENT_CHANGELOG,
        "scd2_consolidated_events": event_versions(),
        "scd2_window_consolidated_events": EVENT_WINDOWS,
        "scd2_current_events":
            f"SELECT * EXCLUDE (op) FROM ({event_versions(extra=', op')}) "
            f"WHERE \"validTo\" = {END} AND op <> 'd'",
        "scd2_noop_suppressed": event_versions(NOOP_FEED),
        "scd2_integrity": INTEGRITY,
        "acceptance_window":
            "SELECT event_id, epoch_us(ts) // 1000 AS ts_ms, "
            "epoch_us(ts) // 1000 - epoch_us(ts) // 1000 % 100000 + 100000 AS window_end FROM events",
        "dim_orders": D_ORDERS,
        "dim_customers": D_CUSTOMERS,
        "dim_books": D_BOOKS,
        "dim_carrier_services": D_SERVICES,
        "books_authors_joined":
            f"SELECT book_id, author_id, author_last_name, op, ts_ms, lsn FROM ({BOOKS_AUTHORS})",
        "services_carriers_joined":
            "SELECT service_id, carrier_id, carrier_contact_email, op, ts_ms "
            f"FROM ({SERVICES_CARRIERS})",
        "shipment_events_joined":
            "SELECT event_id, shipment_id, status, location, order_id, service_id, "
            "shipping_status, actual_delivery_date::VARCHAR AS actual_delivery_date, ts_ms "
            f"FROM ({EVENTS_JOINED})",
        "shipment_events_latest": EVENTS_LATEST,
        "pit_orders": pit('order_item_id, order_id, book_id, ts_ms, o."orderSk", '
                          'o.status AS "orderStatus"'),
        "pit_orders_inclusive": pit('order_item_id, order_id, ts_ms, o."orderSk"', "<="),
        "pit_orders_ranges": pit('order_item_id, order_id, book_id, ts_ms, o."orderSk", '
                                 'o.status AS "orderStatus"'),
        "fact_order_items": F_ORDER_ITEMS,
        "fact_shipment_events": F_SHIPMENT_EVENTS,
        "unmatched_items": UNMATCHED,
        "upsert_dim": D_ORDERS,
        "dim_orders_merged": D_ORDERS,
        "insert_ignore_fact": INSERT_IGNORE,
        "corrupt_quarantine": QUARANTINE,
        "landing_rejected": REJECTED,
        "delivery_time_by_service": DELIVERY,
        "orders_presentation": f'SELECT * EXCLUDE ("customerId") FROM ({D_ORDERS})',
        "dq_constraints": _constraints(),
        "status_transitions": TRANSITIONS,
        "dim_topic_round_trip":
            f"SELECT * FROM ({D_ORDERS}) WHERE \"shippingMethod\" <> '5-LOW'",
        "warehouse_carrier_services":
            f'SELECT * REPLACE ("serviceId"::VARCHAR AS "serviceId") FROM ({D_SERVICES})',
        "stream_insert_ignore":
            f'SELECT DISTINCT {_ITEM_SK} AS "orderItemSk", order_item_id AS "orderItemId", '
            f"ts_ms AS \"transactionTime\" FROM ({_ITEMS}) WHERE op <> 'd'",
        # A replay of a whole stream gives what the batch operators give.
        "stream_landing_orders": landing("orders"),
        "stream_scd2_events": EVENT_CHANGELOG,
        "stream_late_changes": f"SELECT user_id, ts_ms FROM ({EVENT_FEED})",
        "stream_consolidated_events": EVENT_WINDOWS,
        "stream_shipment_events_joined":
            "SELECT event_id, shipment_id, status, location, order_id, service_id, "
            "shipping_status, actual_delivery_date::VARCHAR AS actual_delivery_date, ts_ms "
            f"FROM ({EVENTS_JOINED})",
        "stream_waiting_order_items": F_ORDER_ITEMS,
        "stream_latest_join":
            f"SELECT book_id, author_id, author_last_name, op, ts_ms, lsn FROM ({BOOKS_AUTHORS})",
        "stream_fact": pit('order_item_id, order_id, book_id, ts_ms, o."orderSk", '
                           'o.status AS "orderStatus"'),
        "stream_stream_fact": pit('order_item_id, order_id, book_id, ts_ms, o."orderSk", '
                                  'o.status AS "orderStatus"'),
        "sales_by_book": sales(D_BOOKS, "bookSk", 'd."bookId", d.title'),
        "sales_by_genre": sales(D_BOOKS, "bookSk", "d.genre"),
        "sales_by_author": sales(D_BOOKS, "bookSk", 'd."authorId", d."authorFirstName"'),
        "sales_by_customer": sales(D_CUSTOMERS, "customerSk", 'd."customerId", d.country'),
        "sales_by_order_status": sales(D_ORDERS, "orderSk", 'd.status, d."shippingMethod"'),
    }
