"""Months as numbers: year * 12 + month - 1."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F


def ym(ts: Column) -> Column:
    return F.year(ts) * 12 + F.month(ts) - 1


def month_start(n: Column) -> Column:
    return F.make_date(F.floor(n / 12).cast("int"), (n % 12 + 1).cast("int"), F.lit(1))


def days_in_month(n: Column) -> Column:
    return F.dayofmonth(F.last_day(month_start(n)))


def start_day(n: Column) -> Column:
    """Days from 1970-01-01 to the month's start."""
    return F.datediff(month_start(n), F.lit("1970-01-01").cast("date"))


def midpoint_seconds(n: Column) -> Column:
    """Seconds from 1970 to the exact middle of the month."""
    return (start_day(n) * 86400 + days_in_month(n) * 43200).cast("bigint")


def mid_hour(ts: Column) -> Column:
    return ts + F.expr("INTERVAL 30 MINUTES")


def span(first: int, last: int) -> list[int]:
    if last < first:
        raise ValueError(f"span ends before it begins: {first}..{last}")
    return list(range(first, last + 1))


def parse_month(text: str) -> int:
    """'YYYY-MM' or 'YYYYMM' to a month number."""
    m = re.fullmatch(r"\s*(\d{4})-?(\d{2})\s*", text)
    if not m or not 1 <= int(m[2]) <= 12:
        raise ValueError(f"not a month: {text!r}")
    return int(m[1]) * 12 + int(m[2]) - 1


def month_of(text: Column) -> Column:
    """'YYYY-MM' or 'YYYYMM' to a month number; NULL for anything else."""
    part = lambda k: F.try_to_number(F.regexp_extract(F.trim(text), r"^(\d{4})-?(0[1-9]|1[0-2])$", k), F.lit("9999"))
    return (part(1) * 12 + part(2) - 1).cast("int")


def chosen_months(df: DataFrame, listed: str | None, ym_col: str = "ym") -> DataFrame:
    """Rows of the months in a comma-separated list; all where there is none. A list that names no month is refused."""
    if listed is None or not listed.strip():
        return df
    return df.filter(F.col(ym_col).isin([parse_month(x) for x in listed.split(",")]))


def month_axis(df: DataFrame, ym_col: str = "ym") -> DataFrame:
    """All months from the first to the last that ``df`` has."""
    return df.agg(F.min(ym_col).alias("lo"), F.max(ym_col).alias("hi")).filter("lo IS NOT NULL").select(F.explode(F.sequence("lo", "hi")).alias(ym_col))
