"""The nine landings: change messages in, typed rows out, bad messages apart."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.cdc import landed_rows, parse_changes, rejected_rows


def land(messages: DataFrame, table: str, *, decode_decimals: bool = True,
         cut_texts: bool = True) -> tuple[DataFrame, DataFrame]:
    """Landing rows and rejected messages. Works on streams and tables alike."""
    parsed = parse_changes(messages, table, decode_decimals=decode_decimals,
                           cut_texts=cut_texts)
    return landed_rows(parsed), rejected_rows(parsed)
