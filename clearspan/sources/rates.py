"""Daily exchange rates: currency pairs, codes, idempotent load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearspan.operators.skew import bounded_rows

MAX_CURRENCIES = 1000


def currency_pairs(days: DataFrame, currencies: DataFrame, day: str, code: str) -> DataFrame:
    """Every ordered pair of two currencies for every day.

    The currency master is bounded (ISO codes), so its codes travel as one literal
    array that each day is expanded by twice.
    """
    codes = sorted(r[0] for r in bounded_rows(currencies.select(code).distinct(), MAX_CURRENCIES, "currencies"))
    every = F.array(*[F.lit(c) for c in codes]).cast("array<string>")
    one = days.select(day).distinct().select(day, F.explode(every).alias("currency_from"))
    return one.select("*", F.explode(every).alias("currency_to")).filter("currency_from <> currency_to")


def with_currency_codes(rates: DataFrame, currencies: DataFrame) -> DataFrame:
    """Add the numeric codes of both currencies."""

    def side(name: str) -> DataFrame:
        return currencies.select(
            F.col("currency_alphabetic_code").alias(name), F.col("currency_numeric_code").alias(f"{name}_code")
        )

    return rates.join(side("currency_from"), "currency_from", "left").join(side("currency_to"), "currency_to", "left")


def new_rates(rates: DataFrame, stored: DataFrame, currencies: DataFrame, day: str = "date") -> DataFrame:
    """Rates of days that are not stored yet, ready to append."""
    loaded = stored.select(day).distinct()
    fresh = with_currency_codes(rates.join(loaded, day, "left_anti"), currencies)
    return fresh.withColumn("app_type_file", F.lit("EXCHANGE_RATE")).withColumn("app_processing_date", F.col(day))
