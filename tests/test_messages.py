"""Change messages: encodings, truncation, deletes and bad input."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.bindings import feeds
from tidemark.catalog import METADATA, SOURCES, landing_schema
from tidemark.functions import columns as C
from tidemark.functions.cdc import landed_rows, parse_changes, rejected_rows, to_message
from tidemark.plans.landing import land
from tidemark.sources.topics import parse_rows, read_messages, to_json_rows


def message(after, before=None, op="c", source=None, **payload):
    source = {"ts_ms": 1000, "version": "3", "txId": 5, "lsn": 9} if source is None else source
    return json.dumps({"payload": {
        "op": op, "ts_ms": 1005, "source": source, "before": before, "after": after, **payload}})


def parse(spark, table, *messages, **options):
    df = spark.createDataFrame([(m,) for m in messages], "value STRING")
    return parse_changes(df, table, **options)


ORDER = {"order_id": 1, "customer_id": 2, "order_date": 1_700_000_000_999_999,
         "status": "pending", "shipping_method": "Express"}


@pytest.mark.parametrize("text, value", [
    ("B88=", "19.99"), ("AMg=", "2.00"), ("+DE=", "-19.99"), ("/w==", "-0.01"), ("AA==", "0.00"),
    (None, None), ("", None), ("not base64!", None)])
def test_decimals(spark, text, value):
    df = spark.createDataFrame([(text,)], "x STRING")
    got = df.select(C.decode_decimal(F.col("x"))).first()[0]
    assert got == (None if value is None else Decimal(value))


def test_decimal_round_trip(spark):
    values = ["0.00", "0.01", "-0.01", "1.27", "1.28", "-1.28", "-1.29", "327.67", "99999999.99",
              "-99999999.99", "12345678.90", "-0.10", "2.55", "2.56"]
    df = spark.createDataFrame([(Decimal(v),) for v in values], "x DECIMAL(10,2)")
    for row in df.select("x", C.decode_decimal(C.encode_decimal(F.col("x"))).alias("y")).collect():
        assert row["x"] == row["y"]


def test_order_message(spark):
    row = landed_rows(parse(spark, "orders", message(ORDER))).first()
    assert row["order_date"] == dt.datetime(2023, 11, 14, 22, 13, 20)
    assert (row["order_id"], row["op"], row["ts_ms"], row["emitted_ts_ms"], row["lsn"],
            row["transaction_id"], row["connector_version"]) == (1, "c", 1000, 1005, 9, "5", "3")
    assert "notes" not in row.asDict()


def test_numbers_written_as_text_and_unknown_fields(spark):
    odd = {**ORDER, "order_id": "17", "notes": "dropped", "extra": {"a": [1]}}
    row = landed_rows(parse(spark, "orders", message(odd))).first()
    assert row["order_id"] == 17 and "extra" not in row.asDict()


def test_delete_takes_the_row_before(spark):
    row = landed_rows(parse(spark, "orders", message(None, ORDER, "d"))).first()
    assert (row["order_id"], row["status"], row["op"]) == (1, "pending", "d")


def test_update_never_falls_back_to_the_row_before(spark):
    after = {**ORDER, "shipping_method": None}
    row = landed_rows(parse(spark, "orders", message(after, ORDER, "u"))).first()
    assert row["shipping_method"] is None


def test_bad_messages_are_kept_apart_with_a_reason(spark):
    bad = [
        "{not json", message(ORDER)[:-3], message(ORDER, source={}), "{}", "null", "",
        message({**ORDER, "status": None}), message({**ORDER, "order_id": "x"}),
        message(None, None, "c"), message(ORDER, op=None)]
    parsed = parse(spark, "orders", message(ORDER), *bad)
    assert landed_rows(parsed).count() == 1
    rejected = {r["raw"]: r["error"] for r in rejected_rows(parsed).collect()}
    assert set(rejected) == set(bad)
    assert rejected["{not json"] == "malformed message"
    assert rejected[bad[2]] == "no operation or time"
    assert rejected[bad[6]] == "missing status"
    assert rejected[bad[7]] == "missing order_id"


def test_book_truncation_dates_and_decimals(spark):
    book = {"book_id": 1, "title": "t" * 80, "author_id": 2, "isbn": "978-0-123456-47-2",
            "price": "B88=", "published_date": -14000, "description": "d", "genre": None,
            "stock": 3}
    row = landed_rows(parse(spark, "books", message(book))).first()
    assert (len(row["title"]), row["isbn"], row["price"], row["published_date"], row["genre"]) == (
        50, "978-0-123456-", Decimal("19.99"), dt.date(1931, 9, 3), None)
    raw = landed_rows(parse(spark, "books", message(book), decode_decimals=False)).first()
    assert raw["price"] == "B88="


def test_mysql_metadata(spark):
    carrier = {"carrier_id": 1, "name": "n", "contact_email": "e", "phone": "+1 555 0100 999"}
    source = {"ts_ms": 7, "version": "3.0", "gtid": "g" * 30}
    row = landed_rows(parse(spark, "carriers", message(carrier, source=source))).first()
    assert row["transaction_id"] == "g" * 20 and row["phone"] == "+1 555 0100 "
    assert [n for n, _ in METADATA["mysql"]] == list(row.asDict())[-5:]


def test_nullable_date_stays_null(spark):
    shipment = {"shipment_id": 1, "order_id": 2, "carrier_id": 3, "service_id": 4,
                "tracking_number": "t", "shipping_status": "created", "shipped_date": 0,
                "expected_delivery_date": 7, "actual_delivery_date": None, "shipping_cost": "AMg="}
    row = landed_rows(parse(spark, "shipments", message(shipment))).first()
    assert (row["shipped_date"], row["actual_delivery_date"]) == (dt.date(1970, 1, 1), None)


@pytest.mark.parametrize("table", SOURCES)
def test_messages_round_trip(spark, sf_dir, table):
    rows = feeds.landed(spark, sf_dir, table)
    back = land(to_message(rows, table), table)[0]
    assert back.schema.simpleString() == landing_schema(table).simpleString()
    assert back.exceptAll(rows).count() == 0 and rows.exceptAll(back).count() == 0


def test_message_is_parsed_once(spark, sf_dir):
    landed = land(feeds.messages(spark, sf_dir, "orders"), "orders")[0]
    plan = landed._jdf.queryExecution().executedPlan().toString()
    # Once to numbers, and as text only for what does not fit.
    assert plan.count("from_json") == 2


def test_expressions(spark):
    row = spark.range(1).select(
        C.acceptance_window_end(F.lit(0), 100), C.acceptance_window_end(F.lit(99), 100),
        C.acceptance_window_end(F.lit(-1), 100), C.acceptance_window_end(F.lit(-100), 100),
        C.price_total(F.lit(3), F.lit(10.0), F.lit(0.1)),
        C.surrogate_key("x", F.lit(1), F.lit(2)) == C.surrogate_key("x", F.lit(1), F.lit(2))).first()
    assert list(row) == [100, 100, 0, 0, 27.0, True]


def test_topic_directories_and_typed_rows(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, None)], "id INT, name STRING")
    path = str(tmp_path / "topic")
    to_json_rows(rows).write.text(path)
    (tmp_path / "topic" / "bad.txt").write_text("{broken\n")
    parsed = parse_rows(read_messages(spark, path), rows.schema)
    good = parsed.where("_error IS NULL").select("id", "name")
    assert sorted(tuple(r) for r in good.collect()) == [(1, "a"), (2, None)]
    assert [r["_raw"] for r in parsed.where("_error IS NOT NULL").collect()] == ["{broken"]


def test_unreadable_values_are_a_reason(spark):
    item = {"order_item_id": 1, "order_id": 2, "book_id": 3, "quantity": 4,
            "price_at_purchase": "B88=", "discount": None}
    parsed = parse(spark, "order_items", message(item), message({**item, "discount": "!!bad!!"}),
                   message({**item, "discount": "AQAAAAAAAAAA", "price_at_purchase": "?"}))
    assert [r["_error"] for r in parsed.collect()] == [
        None, "unreadable discount", "unreadable price_at_purchase, discount"]


def test_texts_are_cut_or_kept_whole(spark):
    text = "x" * 300
    df = spark.createDataFrame([(message({**ORDER, "shipping_method": text}),)], "value STRING")
    cut, whole = (parse_changes(df, "orders", cut_texts=c).first()["shipping_method"]
                  for c in (True, False))
    assert cut == text[:20] and whole == text
