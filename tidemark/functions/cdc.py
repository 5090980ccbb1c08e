"""Change messages to typed landing rows."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..catalog import LANDED_TYPES, METADATA, SOURCES, Field
from ..config import FIRST_MS, LAST_MS
from .columns import (
    days_to_date,
    decimal_of_digits,
    encode_decimal,
    hex_digits,
    micros_to_timestamp,
    truncated,
)

CORRUPT = "_corrupt"


_NUMBERS = ("id", "int", "timestamp", "date")


def envelope_schema(table: str, as_text: bool = False) -> T.StructType:
    """Only the paths that are read; ``as_text`` takes every value as it is written."""
    text = T.StringType()
    number = text if as_text else T.LongType()
    row = T.StructType([
        T.StructField(f.name, number if f.kind in _NUMBERS else text)
        for f in SOURCES[table].fields])
    source = T.StructType([
        T.StructField("ts_ms", number), T.StructField("version", text),
        T.StructField("txId", text), T.StructField("lsn", number), T.StructField("gtid", text)])
    payload = T.StructType([
        T.StructField("op", text), T.StructField("ts_ms", number),
        T.StructField("source", source), T.StructField("before", row),
        T.StructField("after", row)])
    return T.StructType([T.StructField("payload", payload), T.StructField(CORRUPT, text)])


def _parsed(value: Column, schema: T.StructType) -> Column:
    return F.from_json(value, schema, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def _at(path: str, type_name: str = "string") -> Column:
    """A value of the message, from the second parse where there was one."""
    return F.when(F.col("text").isNull(), F.col(path).try_cast(type_name)).otherwise(
        F.col(f"text.{path}").try_cast(type_name))


#: Metadata texts that landings cut, and their length.
CUT_METADATA, METADATA_LENGTH = ("connector_version", "transaction_id"), 20


def metadata_columns(flavor: str, cut_texts: bool = True) -> list[Column]:
    """The change metadata of a Postgres or MySQL message."""
    length = METADATA_LENGTH if cut_texts else None
    transaction = "payload.source.txId" if flavor == "postgres" else "payload.source.gtid"
    values = {
        "op": F.left(_at("payload.op"), F.lit(1)),
        "emitted_ts_ms": _at("payload.ts_ms", "bigint"),
        "ts_ms": _at("payload.source.ts_ms", "bigint"),
        "connector_version": truncated(_at("payload.source.version"), length),
        "transaction_id": truncated(_at(transaction), length),
        "lsn": _at("payload.source.lsn", "bigint"),
    }
    return [values[name].alias(name) for name, _ in METADATA[flavor]]


def _written(field: Field, kind: str = "string") -> Column:
    """The value of a field, from ``before`` where the message is a delete."""
    return F.coalesce(_at(f"payload.after.{field.name}", kind), F.when(
        _at("payload.op") == "d", _at(f"payload.before.{field.name}", kind)))


def _present(field: Field) -> Column:
    """Whether the message holds a value for a field, readable or not."""

    def held(path: str) -> Column:
        return F.when(F.col("text").isNull(), F.col(path).isNotNull()).otherwise(
            F.col(f"text.{path}").isNotNull())

    deleted = F.coalesce(_at("payload.op") == "d", F.lit(False))
    return held(f"payload.after.{field.name}") | (deleted & held(f"payload.before.{field.name}"))


def _once(rows: DataFrame, columns: list[Column]) -> DataFrame:
    """``columns`` and ``_raw``, behind a generator that the optimizer moves no filter through:
    a filter would copy all the expressions that it looks at, and work them out twice."""
    return rows.select(F.inline(F.array(F.struct(*columns))), "_raw")


def _raw(field: Field, decode_decimals: bool) -> Column:
    kind = {"timestamp": "bigint", "date": "int", "decimal": "string"}.get(
        field.kind, LANDED_TYPES[field.kind])
    raw = _written(field, kind)
    if field.kind == "decimal" and decode_decimals:
        raw = hex_digits(raw)
    return raw.alias(field.name)


def _landed(field: Field, decode_decimals: bool, cut_texts: bool) -> Column:
    raw = F.col(field.name)
    if field.kind == "text":
        value = truncated(raw, field.length if cut_texts else None)
    elif field.kind == "timestamp":
        value = micros_to_timestamp(raw)
    elif field.kind == "date":
        value = days_to_date(raw)
    elif field.kind == "decimal" and decode_decimals:
        value = decimal_of_digits(raw)
    else:
        value = raw
    return value.alias(field.name)


def parse_changes(messages: DataFrame, table: str, *, value: str = "value",
                  decode_decimals: bool = True, cut_texts: bool = True) -> DataFrame:
    """Typed landing rows plus ``_error`` (NULL for good rows) and ``_raw``.

    Each message is parsed once, straight to numbers; a generator keeps the
    optimizer from copying the parse into every column and filter above it. Only a
    message that does not fit is parsed again as text, so that a number written
    as text still counts. A value that is there but cannot be read or does not fit its type is
    a reason to reject the message, as "unreadable" with the names of its columns.

    Texts are cut to the lengths of the landing's columns, as its schema declares them;
    ``cut_texts=False`` keeps them whole.
    """
    source = SOURCES[table]
    opened = messages.select(F.col(value).alias("_raw"), F.inline(F.array(
        _parsed(F.col(value), envelope_schema(table)))))
    again = F.when(F.col(CORRUPT).isNotNull(),
                   _parsed(F.col("_raw"), envelope_schema(table, as_text=True)))
    opened = opened.select("_raw", "payload", F.explode(F.array(again)).alias("text"))
    coded = [f for f in source.fields if f.kind in (*_NUMBERS, "decimal")]
    rows = _once(opened, [
        *[_raw(f, decode_decimals) for f in source.fields],
        *[_present(f).alias(f"_has_{f.name}") for f in coded],
        *metadata_columns(source.flavor, cut_texts), F.col(f"text.{CORRUPT}").alias(CORRUPT)])
    required = [f.name for f in source.fields if f.required]
    absent = F.concat_ws(", ", *[F.when(F.col(n).isNull(), n) for n in required])
    error = (
        F.when(F.col(CORRUPT).isNotNull(), "malformed message")
        .when(F.col("op").isNull() | F.col("ts_ms").isNull(), "no operation or time")
        .when(~F.col("ts_ms").between(FIRST_MS, LAST_MS), "implausible time")
        .when(reduce(or_, [F.col(n).isNull() for n in required]),
              F.concat(F.lit("missing "), absent))
    )
    names = [n for n, _ in METADATA[source.flavor]]
    landed = rows.select(*[_landed(f, decode_decimals, cut_texts) for f in source.fields], *names,
                         error.alias("_error"), "_raw", *[f"_has_{f.name}" for f in coded])
    lost = F.concat_ws(", ", *[F.when(F.col(f"_has_{f.name}") & F.col(f.name).isNull(), f.name)
                               for f in coded])
    unreadable = F.when(lost != "", F.concat(F.lit("unreadable "), lost))
    return _once(landed, [*[F.col(n) for n in (*[f.name for f in source.fields], *names)],
                          F.coalesce("_error", unreadable).alias("_error")])


def landed_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("_error").isNull()).drop("_error", "_raw")


def rejected_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("_error").isNotNull()).select(
        F.col("_error").alias("error"), F.col("_raw").alias("raw"))


def cut_rows(parsed: DataFrame, table: str) -> DataFrame:
    """The good messages that a landing cuts, with the names of the cut columns.

    ``parsed`` holds the texts whole (``cut_texts=False``).
    """
    lengths = {f.name: f.length for f in SOURCES[table].fields if f.kind == "text"}
    metadata = [n for n, kind in METADATA[SOURCES[table].flavor] if n in CUT_METADATA]
    lengths |= dict.fromkeys(metadata, METADATA_LENGTH)
    cut = F.concat_ws(", ", *[F.when(F.char_length(n) > length, F.lit(n))
                              for n, length in lengths.items() if length is not None])
    return parsed.where(F.col("_error").isNull()).select(
        cut.alias("cut"), F.col("_raw").alias("raw")).where("cut <> ''")


def to_message(rows: DataFrame, table: str) -> DataFrame:
    """Landing-typed rows back to change messages (``value STRING``)."""
    source = SOURCES[table]

    def encoded(field: Field) -> Column:
        column = F.col(field.name)
        if field.kind == "timestamp":
            column = F.unix_micros(column)
        elif field.kind == "date":
            column = F.unix_date(column)
        elif field.kind == "decimal":
            column = encode_decimal(column)
        return column.alias(field.name)

    image = F.struct(*[encoded(f) for f in source.fields])
    transaction = "txId" if source.flavor == "postgres" else "gtid"
    origin = [F.col("ts_ms").alias("ts_ms"), F.col("connector_version").alias("version"),
              F.col("transaction_id").alias(transaction)]
    if source.flavor == "postgres":
        origin.append(F.col("lsn").alias("lsn"))
    deleted = F.col("op") == "d"
    payload = F.struct(
        F.col("op").alias("op"), F.col("emitted_ts_ms").alias("ts_ms"),
        F.struct(*origin).alias("source"),
        F.when(deleted, image).alias("before"), F.when(~deleted, image).alias("after"))
    return rows.select(F.to_json(F.struct(payload.alias("payload"))).alias("value"))
