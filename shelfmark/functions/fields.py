"""Prices, ratings and stock read from scraped text."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.text import strip

MONEY = "decimal(10,2)"

# fixed values: conversion rates of the two loading variants
RATE_GBP_EUR = Decimal("1.17")
RATE_GBP_EUR_NORMALISED = Decimal("1.15")

# fixed values: rating words, lowest first
RATING_WORDS = ("one", "two", "three", "four", "five")


def tidy_price(col: Column) -> Column:
    """Strip, then remove the stray byte left by a wrongly decoded pound sign."""
    return F.replace(strip(col), F.lit("Â"), F.lit(""))


def parse_price(col: Column) -> Column:
    """Pound text to money. NULL means unparseable; a missing field counts as zero."""
    plain = strip(F.replace(F.replace(col, F.lit("£"), F.lit("")), F.lit(","), F.lit(".")))
    number = F.when(plain.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$"), plain)
    return F.when(col.isNull(), F.lit(Decimal("0.00")).cast(MONEY)).otherwise(
        number.try_cast("decimal(20,6)").try_cast(MONEY)
    )


def first_price(col: Column) -> Column:
    """First run of digits and dots; zero when there is none, NULL when it is no number."""
    run = F.regexp_extract(col, r"[0-9.]+", 0)
    return F.when(col.isNull() | (run == ""), F.lit(Decimal("0.00")).cast(MONEY)).otherwise(
        run.try_cast("decimal(20,6)").try_cast(MONEY)
    )


def convert(price: Column, rate: Decimal = RATE_GBP_EUR) -> Column:
    """Exact decimal conversion, rounded half up to cents."""
    return F.round(price * F.lit(rate), 2).cast(MONEY)


def parse_rating(col: Column) -> Column:
    """Word or digits to a number; anything else is 0."""
    word = F.lower(F.coalesce(col, F.lit("0")))
    out = F.coalesce(F.when(word.rlike("^[0-9]+$"), word.try_cast("int")), F.lit(0))
    for value, name in enumerate(RATING_WORDS, 1):
        out = F.when(word == name, F.lit(value)).otherwise(out)
    return out


def rating_from_class(col: Column) -> Column:
    """First rating word contained in a CSS class, else 0."""
    lowered = F.lower(F.coalesce(col, F.lit("")))
    chain = F.when(F.lit(False), F.lit(0))
    for value, name in enumerate(RATING_WORDS, 1):
        chain = chain.when(lowered.contains(name), F.lit(value))
    return chain.otherwise(F.lit(0))


def rating_from_second_class(col: Column) -> Column:
    """Strict form: the second class must be a capitalised rating word, else NULL."""
    second = F.try_element_at(F.split(strip(col), r"\s+"), F.lit(2))
    out = F.lit(None).cast("int")
    for value, name in enumerate(RATING_WORDS, 1):
        out = F.when(second == name.capitalize(), F.lit(value)).otherwise(out)
    return out


def stock_from_text(col: Column) -> Column:
    """``(22 available)`` -> 22, "in stock" without a number -> 1, else 0."""
    text = F.coalesce(col, F.lit(""))
    number = F.regexp_extract(text, r"\(([0-9]+) available\)", 1).try_cast("int")
    return F.coalesce(number, F.when(F.lower(text).contains("in stock"), 1).otherwise(0))


def in_stock(col: Column) -> Column:
    return F.lower(F.coalesce(col, F.lit(""))).contains("in stock")


def stock_from_digits(col: Column) -> Column:
    return F.coalesce(F.when(col.rlike("^[0-9]+$"), col.try_cast("int")), F.lit(0))
