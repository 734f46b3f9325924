"""Exchange rates: one lookup of a day and currency gives the rates into all others."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearspan.operators.skew import bounded_rows, lookup_join
from clearspan.session import checkpointed

#: Bytes of a table of rate maps that may be broadcast; a larger one is joined, hot keys apart.
MAP_BYTES = 256 << 20
#: Currencies of a rate table.
MAX_CURRENCIES = 1000
#: About the bytes of one rate in a map.
_RATE_BYTES = 40


def brand_rates(rates: DataFrame, brand: str) -> DataFrame:
    """Rates of one brand; the name is compared without case."""
    return rates.filter(F.lower("brand") == brand.lower())


def currencies_in(df: DataFrame, column: str) -> list[str]:
    """The currencies a small table names."""
    found = df.select(F.col(column).cast("string")).where(F.col(column).isNotNull()).distinct()
    return sorted(r[0] for r in bounded_rows(found, MAX_CURRENCIES, "currencies"))


class RateMaps:
    """A row for each day and source currency that maps target currencies to rates.

    Any number of conversions of a row, into currencies known before or only after a rule was found, cost one
    lookup. Of rates stored twice the largest counts, so that reruns agree. The maps are written once; their
    bytes, not only their rows, decide whether they are broadcast. Larger ones keep the facts' hot days and currencies
    out of single tasks.
    """

    def __init__(
        self,
        rates: DataFrame,
        targets: Sequence[str] | None = None,
        from_field: str | Column = "currency_from",
        to_field: str = "currency_to",
        day: str = "app_processing_date",
        by: str | None = None,
        limit: int = MAP_BYTES,
    ):
        """``targets`` are the currencies wanted, all if not given.

        ``rates`` holds one brand, or ``by`` names the column (the brand) that a row is looked up by too.
        """
        source = F.col(from_field) if isinstance(from_field, str) else from_field
        self.keys = ["_fx_date", "_fx_from", *(["_fx_by"] if by else [])]
        side = rates.select(
            F.col(day).alias("_fx_date"), source.alias("_fx_from"), *([F.col(by).alias("_fx_by")] if by else []),
            F.col(to_field).alias("to"), F.col("exchange_value").alias("rate"),
        )
        if targets is not None:
            side = side.filter(F.col("to").isin(*targets)) if targets else side.limit(0)
        once = side.filter("to IS NOT NULL").groupBy(*self.keys, "to").agg(F.max("rate").alias("rate"))
        maps = once.groupBy(*self.keys).agg(F.map_from_entries(F.collect_list(F.struct("to", "rate"))).alias("_fx_map"))
        self.table = checkpointed(maps)
        size = self.table.agg(F.coalesce(F.sum(F.size("_fx_map") * _RATE_BYTES + 64), F.lit(0))).first()[0]
        self.small = size <= limit

    def onto(self, df: DataFrame, name: str, on_date: Column, currency: Column, *by: Column) -> DataFrame:
        """Add the map of the row's day and currency as ``name`` (null without one); rows keep their number."""
        values = dict(zip(self.keys, [on_date, currency, *by], strict=True))
        if self.small:
            hit = reduce(lambda a, b: a & b, [value == F.col(key) for key, value in values.items()])
            return df.join(F.broadcast(self.table), hit, "left").select(*df.columns, F.col("_fx_map").alias(name))
        keyed = df.withColumns({f"_of{key}": value for key, value in values.items()})
        found = lookup_join(keyed, self.table, {f"_of{key}": key for key in self.keys}, ["_fx_map"])
        return found.select(*df.columns, F.col("_fx_map").alias(name))


def rate_into(name: str, currency: Column, target: Column) -> Column:
    """Rate from the row's currency to a target: 1 for the same, null where none is known."""
    return F.when(currency == target, F.lit(1.0)).otherwise(F.try_element_at(F.col(name), target))


def attach_rate(
    df: DataFrame,
    rates: DataFrame,
    out: str,
    on_date: Column,
    currency: Column,
    target: Column,
    from_field: str | Column = "currency_from",
    to_field: str = "currency_to",
    same: Column | None = None,
    targets: Sequence[str] | None = None,
) -> DataFrame:
    """Add the rate from ``currency`` to ``target`` on a day.

    The rate is 1 where ``same`` holds (by default: both currencies are equal)
    and null where none is known. ``targets`` limits the maps to currencies that ``target`` can name.
    """
    rows = RateMaps(rates, targets, from_field, to_field).onto(df, "_fx", on_date, currency)
    equal = (currency == target) if same is None else same
    rate = F.when(equal, F.lit(1.0)).otherwise(F.try_element_at(F.col("_fx"), target))
    return rows.withColumn(out, rate).drop("_fx")


def converted(df: DataFrame, name: str, amount: Column, currency: Column, targets: Sequence[str], prefix: str) -> DataFrame:
    """Add ``<prefix>_<target>`` from the row's map: the amount in each target currency."""
    return df.withColumns({f"{prefix}_{t.lower()}": amount * rate_into(name, currency, F.lit(t)) for t in targets})


def convert_to_each(
    df: DataFrame,
    rates: DataFrame,
    amount: Column,
    currency: Column,
    on_date: Column,
    targets: Sequence[str],
    prefix: str,
) -> DataFrame:
    """Add ``<prefix>_<target>``: the amount in each target currency, by one lookup. ``rates`` holds one brand."""
    if not targets:
        return df
    rows = RateMaps(rates, targets).onto(df, "_fx", on_date, currency)
    return converted(rows, "_fx", amount, currency, targets, prefix).drop("_fx")


def to_report_currency(
    detail: DataFrame, rates: DataFrame, customers: DataFrame, decimals: int = 2
) -> DataFrame:
    """Settlement amounts in the customer's report currency, rounded."""
    owner = customers.select(F.col("code").alias("_code"), F.col("report_currency_code").alias("_report"))
    maps = RateMaps(rates, currencies_in(customers, "report_currency_code"), by="brand")
    joined = maps.onto(
        detail.join(owner, F.col("app_customer_code") == F.col("_code")),
        "_fx", F.col("app_processing_date"), F.col("settlement_currency"), F.col("transaction_brand"),
    )
    rate = rate_into("_fx", F.col("settlement_currency"), F.col("_report"))
    keep = [c for c in detail.columns if c not in ("exchange_rate", "report_amount", "report_currency")]
    return joined.select(
        *keep,
        rate.alias("exchange_rate"),
        F.round(F.col("settlement_amount") * rate, decimals).alias("report_amount"),
        F.col("_report").alias("report_currency"),
    )
