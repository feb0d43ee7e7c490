"""Text hygiene. Functions take and return columns; none ever raises on data.

Normal form C and case folding beyond ASCII have no built-in: Arrow functions do them, and only for values that hold a
character beyond ASCII; for all others they see nulls.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

BEYOND_ASCII = r"[^\x00-\x7F]"


@F.pandas_udf(StringType())
def _nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFC", x), na_action="ignore")


@F.pandas_udf(StringType())
def _casefold(s: pd.Series) -> pd.Series:
    return s.map(str.casefold, na_action="ignore")


class Cleaned:
    """Marks a column that clean_text() has been applied to and that isn't null, so that functions don't apply it again."""

    def __init__(self, column: Column):
        self.column = column


def clean_text(c: Column | Cleaned, unicode: bool = True) -> Column:
    """Normal form C, without control and format characters (but for tab and newline), white space collapsed, trimmed. A null
    becomes the empty string. *unicode*: whether normal form C is applied."""
    if isinstance(c, Cleaned):
        return c.column
    c = F.coalesce(c, F.lit(""))
    if unicode:
        c = F.coalesce(_nfc(F.when(c.rlike(BEYOND_ASCII), c)), c)
    c = F.regexp_replace(c, r"[\p{Cc}\p{Cf}&&[^\n\t]]", "")
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def casefold(c: Column, unicode: bool = True) -> Column:
    low = F.lower(c)
    return F.coalesce(_casefold(F.when(c.rlike(BEYOND_ASCII), c)), low) if unicode else low


def or_null(c: Column) -> Column:
    """Null for the empty string."""
    return F.when(c != "", c)


def strip_of(c: Column, characters: str) -> Column:
    return F.call_function("btrim", c, F.lit(characters))


def bound(c: Column, of: Callable[[Column], Column]) -> Column:
    """*of* a column that is worked out once, however often *of* uses it."""
    return F.get(F.transform(F.array(c), of), F.lit(0))


def result(value: Column, key: Column, quality: Column, reason: Column) -> Column:
    """What every normaliser returns; without a value the key is null and the quality 0."""
    bare = value.isNull()
    return F.struct(value.alias("value"), F.when(~bare, key).alias("key"), F.when(bare, F.lit(0.0)).otherwise(quality).alias("quality"), reason.alias("reason"))


def decode_bytes(content: Column) -> Column:
    """Bytes as text: UTF-8 without its mark, else Latin-1. Null for null."""
    text = F.when(F.call_function("is_valid_utf8", content.cast("string")), content.cast("string")).otherwise(F.decode(content, "ISO-8859-1"))
    return F.regexp_replace(text, "^﻿", "")
