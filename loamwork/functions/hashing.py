"""Keys and ranks that must be equal bit by bit wherever they are computed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loamwork import constants as C
from loamwork.functions.text import strip


def content_hash(text: Column) -> Column:
    """SHA-1 of the text in lower case with runs of white space collapsed."""
    collapsed = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), f"{C.WS}+", " ")
    return F.sha1(strip(collapsed))


def input_hash(title: Column, text: Column) -> Column:
    return F.sha2(F.concat(title, F.lit("\n"), text), 256)


def record_id(url: Column) -> Column:
    """The version 5 UUID of a URL in the namespace of records."""
    h = F.sha1(F.concat(F.unhex(F.lit(C.RECORD_NAMESPACE)), url.cast("binary")))
    variant = F.translate(F.substring(h, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def rank_hex(key: Column, salt: str) -> Column:
    """The first 64 bits of SHA-1 of "salt:key" in hexadecimal, which sorts as the unsigned number does."""
    return F.substring(F.sha1(F.concat(F.lit(f"{salt}:"), key)), 1, 16)


def stable_rank(key: Column, salt: str) -> Column:
    return F.conv(rank_hex(key, salt), 16, 10).cast("decimal(20,0)")
