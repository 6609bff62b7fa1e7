"""Cleaning of raw text values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from txmon.config import MONEY, NULL_TOKENS


def blank_tokens(value: Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """NULL where the trimmed value is a "no value" token; other values stay untrimmed."""
    return F.when(~F.trim(value).isin(*tokens), value)


def one_line(value: Column) -> Column:
    """Each carriage return, line feed or tab becomes one space; runs are not merged."""
    return F.translate(value, "\r\n\t", "   ")


def code(value: Column) -> Column:
    return F.upper(F.trim(value))


def truth(value: Column) -> Column:
    """TRUE/FALSE in any case, NULL for everything else, padded words included."""
    word = F.upper(value)
    return F.when(word.isin("TRUE", "FALSE"), word == "TRUE")


def amount_text(value: Column) -> Column:
    """Keep digits, points and minus signs only (so brackets and exponents are lost)."""
    return F.regexp_replace(value, r"[^-.0-9]", "")


def money(text: Column) -> Column:
    """Text or number to cents, half up; NULL where it is no amount or does not fit."""
    return text.try_cast(MONEY)
