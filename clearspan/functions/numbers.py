"""Numeric text: guards, implied decimals, signed amounts, exponent rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Digits with an optional sign and decimal point. Exponents and blanks are text.
PLAIN_NUMBER = r"^[+-]?[0-9]+(\.[0-9]+)?$"


def is_number(c: Column) -> Column:
    """True for plain numeric text, false otherwise and for null."""
    return F.coalesce(c.rlike(PLAIN_NUMBER), F.lit(False))


def safe_number(c: Column, type_name: str = "decimal(38,10)") -> Column:
    """Number from text, null where the text is not a plain number."""
    return F.when(is_number(c), c.try_cast(type_name))


def implied_decimal(c: Column, exponent: int | Column, type_name: str = "double") -> Column:
    """Integer text with an implied decimal point ``exponent`` digits from the right."""
    k = exponent if isinstance(exponent, Column) else F.lit(exponent)
    return safe_number(c, type_name) / F.pow(F.lit(10.0), k)


def signed_amount(c: Column) -> Column:
    """Amount text with a leading or trailing sign letter or character.

    ``C``/``+`` are credits (positive), ``D``/``-`` debits (negative). Text
    without a sign is returned as it is.
    """
    body = F.trim(c)
    digits = F.regexp_replace(body, r"[+\-CDcd]", "")
    negative = body.rlike(r"(^[-Dd])|([-Dd]$)")
    return F.when(negative, F.concat(F.lit("-"), digits)).otherwise(digits)


def exponent_rate(c: Column) -> Column:
    """Rate whose first digit is the decimal exponent of the digits after it."""
    ok = is_number(c) & (F.length(c) > 1)
    return F.when(ok, c.substr(F.lit(2), F.length(c)).try_cast("double") / F.pow(F.lit(10.0), F.left(c, F.lit(1)).try_cast("int")))


def unmask_card(c: Column, type_name: str = "decimal(19,0)") -> Column:
    """Card number with masked digits (``*``) read as zeros."""
    return F.regexp_replace(c, r"\*", "0").try_cast(type_name)
