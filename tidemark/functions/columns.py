"""Column expressions for change messages, keys and measures. All stay in the JVM."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def truncated(text: Column, length: int | None) -> Column:
    """Length-bounded text; a plain cast to VARCHAR(n) would not cut in Spark."""
    return text if length is None else F.left(text, F.lit(length))


def micros_to_timestamp(micros: Column) -> Column:
    """Epoch microseconds to a timestamp of whole seconds."""
    return F.timestamp_seconds(F.call_function("div", micros, F.lit(1_000_000)))


def days_to_date(days: Column) -> Column:
    return F.date_from_unix_date(days.cast("int"))


def hex_digits(encoded: Column) -> Column:
    """Base64 text as hexadecimal digits; NULL where it is not Base64."""
    return F.hex(F.try_to_binary(encoded, F.lit("base64")))


def decimal_of_digits(digits: Column, scale: int = 2, precision: int = 10) -> Column:
    """Big-endian two's-complement integer of up to 8 bytes, scaled.

    Empty or longer input gives NULL.
    """
    sign = F.when(digits >= F.lit("8"), F.lit("F")).otherwise(F.lit("0"))
    widened = F.lpad(digits, F.lit(16), sign)
    fits = F.length(digits).between(2, 16)
    unscaled = F.when(fits, F.conv(widened, 16, -10).try_cast("bigint"))
    exact = unscaled.cast("decimal(19,0)") * F.lit(Decimal(1).scaleb(-scale))
    return exact.try_cast(f"decimal({precision},{scale})")


def decode_decimal(encoded: Column, scale: int = 2, precision: int = 10) -> Column:
    """NUMERIC carried as Base64 bytes, decoded exactly and with its sign."""
    return decimal_of_digits(hex_digits(encoded), scale, precision)


def encode_decimal(number: Column, scale: int = 2) -> Column:
    """Inverse of :func:`decode_decimal`."""
    unscaled = F.round(number * F.lit(10**scale)).cast("bigint")
    digits = F.hex(unscaled)
    even = F.when(F.length(digits) % 2 == 1, F.concat(F.lit("0"), digits)).otherwise(digits)
    sign_bit = even >= F.lit("8")
    signed = F.when((unscaled >= 0) & sign_bit, F.concat(F.lit("00"), even)).otherwise(even)
    return F.base64(F.unhex(signed))


def surrogate_key(entity: str, *parts: Column) -> Column:
    """Key of one version or fact. A replay or a retried task gives the same key."""
    return F.md5(F.concat_ws("#", F.lit(entity), *[p.cast("string") for p in parts]))


def packed_key(sk: str) -> Column:
    """A surrogate key as its 16 bytes, for shuffles; a text of another form behind 17 zero bytes."""
    text = F.col(sk)
    other = F.concat(F.lit(bytes(17)), text.cast("binary"))
    return F.when(text.rlike("^[0-9a-f]{32}\\z"), F.unhex(text)).otherwise(other).alias(sk)


def unpacked_key(sk: str) -> Column:
    """Inverse of :func:`packed_key`."""
    packed = F.col(sk)
    other = F.substring(packed, 18, (1 << 31) - 1).cast("string")
    return F.when(F.length(packed) == 16, F.lower(F.hex(packed))).otherwise(other).alias(sk)


def acceptance_window_end(ts: Column, window_ms: int) -> Column:
    """End of the tumbling window of ``ts``; floors below the epoch as well."""
    return ts - F.pmod(ts, F.lit(window_ms)) + F.lit(window_ms)


def price_total(quantity: Column, price: Column, discount: Column) -> Column:
    return quantity * price * (F.lit(1) - discount)


def valid_at(ts: Column, valid_from: Column, valid_to: Column, inclusive_end: bool = False) -> Column:
    """Point-in-time test. The end is exclusive unless asked otherwise."""
    return (ts >= valid_from) & ((ts <= valid_to) if inclusive_end else (ts < valid_to))
