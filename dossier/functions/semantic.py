"""Dates, countries, locations, skills and numbers."""

from __future__ import annotations

import difflib
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from dossier.functions.text import casefold, clean_text, or_null, result, strip_of
from dossier.vocab import Vocabulary

# Month names (their first three letters decide) and spellings, marks of the present, the pivot of two-digit years.
MONTHS = {"jan": 1, "january": 1, "feb": 2, "february": 2, "mar": 3, "march": 3, "apr": 4, "april": 4, "may": 5, "jun": 6, "june": 6, "jul": 7, "july": 7, "aug": 8, "august": 8, "sep": 9, "sept": 9, "september": 9, "oct": 10, "october": 10, "nov": 11, "november": 11, "dec": 12, "december": 12}
PRESENT = ("present", "current", "now", "ongoing", "till date", "to date")
PIVOT = 50


def expand_year(y: Column) -> Column:
    """Two digits by a fixed pivot: 00-49 are 20xx, 50-99 are 19xx."""
    return F.when(y >= 100, y).when(y < PIVOT, y + 2000).otherwise(y + 1900)


def literal_map(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def looked_up(table: Column, key: Column) -> Column:
    return F.try_element_at(table, key)


def normalize_date(raw: Column, locale: str | None = None, unicode: bool = True) -> Column:
    """struct<value, quality, reason, precision, is_current>: YYYY-MM or YYYY as text. What is ambiguous without *locale* (US: month
    first; EU, UK, IN: day first) loses precision instead of gaining a guess."""
    s = strip_of(F.trim(F.lower(clean_text(raw, unicode))), ".")
    got = lambda pattern, i: F.regexp_extract(s, pattern, i)
    number = lambda c: c.try_cast("int")
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
    months = literal_map(MONTHS)

    def out(year: Column, month: Column | None, quality: float, reason: str) -> Column:
        text = pad(year, 4) if month is None else F.concat(pad(year, 4), F.lit("-"), pad(month, 2))
        return F.struct(text.alias("value"), F.lit(quality).alias("quality"), F.lit(reason).alias("reason"), F.lit("year" if month is None else "month").alias("precision"), F.lit(False).alias("is_current"))

    def none(quality: float, reason: Column, current: bool = False) -> Column:
        return F.struct(F.lit(None).cast("string").alias("value"), F.lit(quality).alias("quality"), reason.alias("reason"), F.lit(None).cast("string").alias("precision"), F.lit(current).alias("is_current"))

    iso = r"^(\d{4})(?:[-/.](\d{1,2}))?(?:[-/.](\d{1,2}))?$"
    iso_month = number(got(iso, 2))
    named, turned = r"^([a-z]{3,9})[\s\-/,]+(\d{2,4})$", r"^(\d{4})[\s\-/,]+([a-z]{3,9})$"
    named_month, turned_month = looked_up(months, got(named, 1)), looked_up(months, got(turned, 2))
    parts = r"^(\d{1,4})[-/.](\d{1,2})(?:[-/.](\d{1,4}))?$"
    a, b, c = (got(parts, i) for i in (1, 2, 3))
    ai, bi, ci = number(a), number(b), number(c)
    # Two numbers: a first one of four digits is the year, else the second is.
    year2 = F.when(F.length(a) == 4, ai).otherwise(expand_year(bi))
    month2 = F.when(F.length(a) == 4, bi).otherwise(ai)
    year3 = expand_year(ci)
    first_is_day, second_is_day = (ai > 12) & (bi <= 12), (bi > 12) & (ai <= 12)
    month3 = F.when(first_is_day, bi).when(second_is_day, ai)
    if locale:
        month3 = month3.when((ai <= 12) & (bi <= 12), ai if locale == "US" else bi)
    three = (
        F.when(F.length(a) == 4, out(ai, bi, 1.0, ""))
        .when(month3.between(1, 12), out(year3, month3, 1.0, ""))
        .when(month3.isNotNull(), out(year3, None, 0.6, "bad_month_down_to_year"))
        .when((ai <= 12) & (bi <= 12), out(year3, None, 0.6, "ambiguous_date_down_to_year"))
        .otherwise(out(year3, None, 0.5, "implausible_components_down_to_year"))
    )
    bare = r"^(\d{2,4})$"
    return (
        F.when(s == "", none(0.0, F.lit("empty")))
        .when(s.isin(*PRESENT), none(1.0, F.lit("present_marker"), True))
        .when(s.rlike(iso), F.when(iso_month.isNull(), out(number(got(iso, 1)), None, 1.0, "")).when(iso_month.between(1, 12), out(number(got(iso, 1)), iso_month, 1.0, "")).otherwise(none(0.0, F.concat(F.lit("bad_month:"), iso_month.cast("string")))))
        .when(named_month.isNotNull(), out(expand_year(number(got(named, 2))), named_month, 1.0, ""))
        .when(turned_month.isNotNull(), out(number(got(turned, 1)), turned_month, 1.0, ""))
        .when(s.rlike(parts) & (c == ""), F.when(month2.between(1, 12), out(year2, month2, 1.0, "")).otherwise(out(year2, None, 0.6, "ambiguous_down_to_year")))
        .when(s.rlike(parts), three)
        .when(s.rlike(bare), out(expand_year(number(got(bare, 1))), None, 0.9, "year_only"))
        .otherwise(none(0.0, F.concat(F.lit("unparseable_date:"), s)))
    )


def month_index(date: Column, end: bool = False) -> Column:
    """Months since year 0 of YYYY or YYYY-MM; a year alone stands for its first month, or with *end* its last."""
    month = F.substring(date, 6, 2).try_cast("int")
    return F.substring(date, 1, 4).try_cast("int") * 12 + F.coalesce(month, F.lit(12 if end else 1)) - 1


def normalize_country(raw: Column, vocab: Vocabulary | None = None, unicode: bool = True) -> Column:
    """struct<value, key, quality, reason, canonical>: the two-letter code, else the text itself, marked as not canonical."""
    vocab = vocab or Vocabulary()
    text = clean_text(raw, unicode)
    names = literal_map(vocab.country_aliases)
    key = F.trim(strip_of(F.trim(casefold(text, unicode)), "."))
    code = F.when((F.length(text) == 2) & F.upper(text).isin(*vocab.iso_countries), F.upper(text))
    named = looked_up(names, key)
    last = looked_up(names, F.trim(F.substring_index(key, ",", -1)))
    value = or_null(F.coalesce(code, named, last, text))
    exact = F.coalesce(code, named).isNotNull()
    quality = F.when(exact, 1.0).when(last.isNotNull(), 0.95).otherwise(0.4)
    reason = F.when(text == "", "empty").when(exact, "").when(last.isNotNull(), "matched_last_token").otherwise("unknown_country_kept_as_text")
    return result(value, casefold(value, unicode), quality, reason).withField("canonical", exact | last.isNotNull())


def parse_location(raw: Column, vocab: Vocabulary | None = None, unicode: bool = True) -> Column:
    """struct<city, region, country> of "City, Region, Country": one part is a country if it is known as one, else a city."""
    parts = F.filter(F.transform(F.split(clean_text(raw, unicode), ","), lambda x: F.trim(x)), lambda p: p != "")
    n, first = F.size(parts), F.get(parts, F.lit(0))
    known = normalize_country(first, vocab, unicode)["canonical"]
    last = F.try_element_at(parts, F.lit(-1))
    return F.struct(
        F.when((n > 1) | ~known, first).alias("city"),
        F.when(n > 2, F.get(parts, F.lit(1))).alias("region"),
        F.when(n > 1, last).when(known, first).alias("country"),
    )


@lru_cache(maxsize=8)
def _closest(aliases: tuple[str, ...], threshold: float):
    """A memoised search for the alias most similar to a key; of equally similar ones the first in order."""

    @lru_cache(maxsize=1 << 16)
    def find(key: str) -> tuple[str | None, float]:
        best, high = None, 0.0
        for alias in aliases:
            match = difflib.SequenceMatcher(None, key, alias)
            # Both are upper bounds of the ratio, and a bound under the threshold can't lead to a match.
            if match.real_quick_ratio() >= threshold and match.quick_ratio() >= threshold and (r := match.ratio()) > high:
                best, high = alias, r
        return (best, high) if high >= threshold else (None, 0.0)

    return find


def normalize_skill(raw: Column, vocab: Vocabulary | None = None, unicode: bool = True) -> Column:
    """struct<value, key, quality, reason, canonical>: by alias, else by the most similar alias, else the text itself. The similarity
    search runs in an Arrow function, which sees only what no alias matches, and searches each distinct value once."""
    vocab = vocab or Vocabulary()
    index = vocab.skill_index()
    aliases, threshold = tuple(sorted(index)), vocab.fuzzy_skill
    text = clean_text(raw, unicode)
    key = casefold(text, unicode)
    exact = looked_up(literal_map(index), key)

    @F.pandas_udf("value string, quality double, reason string, canonical boolean")
    def guess(texts: pd.Series) -> pd.DataFrame:
        find, rows = _closest(aliases, threshold), []
        for t in texts:
            if t is None or t != t:
                rows.append((None, None, None, None))
                continue
            alias, ratio = find(t.casefold())
            if alias:
                rows.append((index[alias], round(ratio, 3), f"fuzzy:{ratio:.3f}", True))
            else:
                rows.append((t if any(map(str.isupper, t)) else t.title(), 0.3, "unknown_skill_kept", False))
        return pd.DataFrame(rows, columns=["value", "quality", "reason", "canonical"])

    other = guess(F.when(exact.isNull() & (text != ""), text))
    value = F.when(text != "", F.coalesce(exact, other["value"]))
    quality = F.when(exact.isNotNull(), 1.0).otherwise(other["quality"])
    reason = F.when(text == "", "empty").when(exact.isNotNull(), "").otherwise(other["reason"])
    return result(value, casefold(value, unicode), quality, reason).withField("canonical", F.coalesce(F.when(exact.isNotNull(), True).otherwise(other["canonical"]), F.lit(False)))


def parse_years(raw: Column, unicode: bool = True) -> Column:
    """struct<value double, quality, reason>: a number of years from 0 to 80; texts that aren't plain decimal numbers are refused."""
    text = clean_text(raw, unicode)
    number = F.when(text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), text.try_cast("double"))
    good = number.between(0, 80)
    return F.struct(F.when(good, number).alias("value"), F.when(good, 1.0).otherwise(0.0).alias("quality"), F.when(good, "").otherwise(F.concat(F.lit("bad_years:"), text)).alias("reason"))


@F.pandas_udf(DoubleType())
def py_round3(x: pd.Series) -> pd.Series:
    """Three decimals as Python rounds: correctly, on the binary value."""
    return x.map(lambda v: round(v, 3), na_action="ignore")
