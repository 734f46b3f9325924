"""Reconciliation of computed interchange with the brands' settlement reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearspan.operators.fx import RateMaps, brand_rates, currencies_in
from clearspan.operators.skew import global_row_number

# --- fixed values -------------------------------------------------------------
MODES = {"1": "acquiring", "2": "issuing"}
MEMBER_MODES = {"A": "acquiring", "I": "issuing"}
GLOBAL_JURISDICTION = "00"
FIRST_EXCLUDED_TYPE = 519
ACQUIRING_EXCLUDED_TYPE = "310"
EXCLUDED_CYCLES = ["7", "8", "0"]
ACCEPTED_RETURNS = ["N", " "]
#: Settlement totals message of the bitmap brand.
TOTALS_MESSAGE, TOTALS_FUNCTION = "1644", "685"
PRESENTMENT = "1240"
ACCEPTED_FILES = ["001", "002"]
#: Column of the processing day.
DAY = "app_processing_date"
ACTIVITY_JURISDICTIONS = {
    "4": "off-us",
    "1": "interregional",
    "8": "interregional",
    "2": "intraregional",
    "3": "intraregional",
}
# -------------------------------------------------------------------------------


def _table(c: Column, table: dict) -> Column:
    out = None
    for k, v in table.items():
        out = F.when(c == k, v) if out is None else out.when(c == k, v)
    return out


def settlement_report_text(
    report: DataFrame,
    countries: DataFrame,
    currencies: DataFrame,
    types: DataFrame,
    cycles: DataFrame,
    mode: str,
    only_type: str | None = None,
) -> DataFrame:
    """Settlement rows of the text brand summed per fee level.

    ``report`` holds typed report lines with their aggregation level; ``mode`` is
    the report's business mode (1 or 2). ``only_type`` keeps one business
    transaction type (the online reconciliation) instead of the clearing ones; the excluded cycles stay out of both.
    """
    kind, cycle = F.trim("business_transaction_type"), F.trim("business_transaction_cycle")
    chosen = (
        (F.trim("business_mode") == mode)
        & (F.col("aggregation_level") == 0)
        & (F.length(F.trim("fee_level_descriptor")) > 0)
        & F.col("return_indicator").isin(*ACCEPTED_RETURNS)
    )
    if only_type is not None:
        chosen = chosen & (kind == only_type) & ~F.coalesce(cycle.isin(*EXCLUDED_CYCLES), F.lit(False))
    else:
        excluded = (kind.try_cast("int") >= FIRST_EXCLUDED_TYPE) | cycle.isin(*EXCLUDED_CYCLES)
        if mode == "1":
            excluded = excluded | (kind == ACQUIRING_EXCLUDED_TYPE)
        chosen = chosen & ~F.coalesce(excluded, F.lit(False))
    place = F.when(F.trim("source_country_code") != "", F.when(
        F.col("business_mode") == "2", F.col("destination_country_code")
    ).otherwise(F.col("source_country_code"))).try_cast("int")
    land = countries.select(
        F.col("country_numeric").cast("int").alias("_place"),
        F.col("country_code").alias("_country"),
        F.col("visa_region_code").cast("string").alias("_region"),
    )
    money = currencies.select(
        F.col("currency_numeric_code").cast("int").alias("_ccy"),
        F.col("currency_alphabetic_code").alias("settlement_currency"),
    )
    type_names = types.select(
        F.col("business_transaction_type_code").alias("_type"), F.col("short_description").alias("_type_name")
    )
    cycle_names = cycles.select(
        F.col("business_transaction_cycle_code").alias("_cycle"), F.col("short_description").alias("_cycle_name")
    )
    rows = (
        report.filter(chosen)
        .join(land, place == F.col("_place"), "left")
        .join(money, F.col("settlement_currency_code").try_cast("int") == F.col("_ccy"), "left")
        .join(type_names, F.col("business_transaction_type") == F.col("_type"), "left")
        .join(cycle_names, F.col("business_transaction_cycle") == F.col("_cycle"), "left")
    )
    abroad = F.col("source_country_code") != F.col("destination_country_code")
    count = F.when(F.trim("count") == "", "0").otherwise(F.trim("count")).try_cast("bigint")
    return rows.groupBy(
        "app_processing_date",
        "report_type",
        "aggregation_level",
        "summary_level",
        F.when(F.col("jurisdiction_code") == GLOBAL_JURISDICTION, "9")
        .otherwise(F.when(abroad, F.col("_region")).otherwise(F.col("_country")))
        .alias("jurisdiction_assigned"),
        _table(F.col("business_mode"), MODES).alias("business_mode"),
        F.trim("fee_level_descriptor").alias("fee_descriptor"),
        "settlement_currency",
        F.col("_type_name").alias("business_transaction_type"),
        F.col("_cycle_name").alias("business_transaction_cycle"),
        F.when(F.col("reversal_indicator") == "N", 0).otherwise(1).alias("reversal_flag"),
    ).agg(
        F.sum(count).alias("settlement_count"),
        F.sum("interchange_amount").alias("settlement_amount"),
        F.sum(F.col("fee_debits") + F.col("fee_credits")).alias("settlement_irf_amount"),
    )


def settlement_report_bitmap(elements: DataFrame, types: DataFrame, member: str) -> DataFrame:
    """Settlement totals of the bitmap brand summed per rate code."""
    issuer_file = (
        (F.col("reconciled_member_activity") == "I")
        & (F.col("reconciled_transaction_function_1") == PRESENTMENT)
        & F.col("reconciled_file").isNull()
    )
    file = F.when(issuer_file, ACCEPTED_FILES[0]).otherwise(F.left("reconciled_file", F.lit(3)))
    names = types.select(
        F.col("business_transaction_type_id").alias("_type"),
        F.col("short_description").alias("business_transaction_type"),
    )
    rows = elements.filter(
        (F.col("app_message_type") == TOTALS_MESSAGE)
        & (F.col("function_code").cast("string") == TOTALS_FUNCTION)
        & (F.col("reconciled_member_activity") == member)
        & file.isin(*ACCEPTED_FILES)
        & (F.trim("reconciled_business_activity_4") != "")
        & (F.col("reconciled_transaction_function_1") == PRESENTMENT)
    ).join(names, F.col("reconciled_processing_code") == F.col("_type"), "left")
    return rows.groupBy(
        "app_processing_date",
        _table(F.upper(F.trim("reconciled_member_activity")), MEMBER_MODES).alias("business_mode"),
        _table(F.col("reconciled_business_activity_2"), ACTIVITY_JURISDICTIONS).alias("jurisdiction"),
        F.col("reconciled_business_activity_4").alias("ird"),
        "business_transaction_type",
        F.when(F.upper(F.trim("original_reversal_totals_indicator")) == "O", 0).otherwise(1).alias("reversal_flag"),
    ).agg(
        F.sum("total_transaction_number").alias("settlement_count"),
        F.sum("amount_net_transaction").alias("settlement_amount"),
        F.sum("amount_net_fee").alias("settlement_irf_amount"),
    )


def in_local_currency(
    rows: DataFrame, customers: DataFrame, rates: DataFrame, brand: str, day: Column, currency: Column, amount: Column, fee: Column, places: int = 6
) -> DataFrame:
    """Add ``local_amount`` and ``local_fee``: amounts in the customer's local currency, exact, unchanged where no rate is known.

    ``currency`` is numeric; the day is that of the purchase.
    """
    owner = customers.select(F.col("code").alias("_owner"), F.col("local_currency_code").alias("_local"))
    maps = RateMaps(brand_rates(rates, brand), currencies_in(customers, "local_currency_code"), F.col("currency_from_code").cast("string"))
    known = maps.onto(rows.join(owner, F.col("app_customer_code") == F.col("_owner"), "left"), "_fx", day, currency.cast("string"))
    rate = F.coalesce(F.try_element_at(F.col("_fx"), F.col("_local")), F.lit(1.0))
    exact = lambda c, k: F.round(c * rate, k).cast(f"decimal(24,{k})")
    return known.withColumns({"local_amount": exact(amount, places), "local_fee": exact(fee, places + 2)}).drop("_owner", "_local", "_fx")


def reconcile_daily(settlement: DataFrame, interchange: DataFrame, keys: Sequence[str], optional_keys: Sequence[str] = ()) -> DataFrame:
    """Match of settlement and interchange groups of one processing day, for all days at once.

    Differences of opposite sign on two days stay apart. ``interchange`` are assigned transactions in local
    currency; both sides are summed by day and key before they meet.
    """
    by = [DAY, *keys]
    theirs = settlement.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("settlement_count", "settlement_amount", "settlement_irf_amount")])
    matched = reconcile(theirs, interchange_report(interchange, by), by, optional_keys)
    return matched.drop(f"settlement_{DAY}", f"interchange_{DAY}")


def last_report_id(stored: DataFrame, column: str = "app_id") -> int:
    """The largest id that a stored report has given out, 0 without one."""
    return int(stored.agg(F.max(column)).first()[0] or 0)


def interchange_report(assigned: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Computed interchange per group: count, local amount, local fee."""
    return assigned.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("interchange_count"),
        F.sum("local_amount").alias("interchange_amount"),
        F.sum("local_fee").alias("interchange_irf_amount"),
    )


def rule_order(rules: DataFrame) -> DataFrame:
    """Smallest rule number of every jurisdiction, region and descriptor."""
    return rules.groupBy("jurisdiction", "region_country_code", F.trim("fee_descriptor").alias("fee_descriptor")).agg(
        F.min(F.col("rule_id").try_cast("double")).alias("order_rule")
    )


def reconcile(
    settlement: DataFrame,
    interchange: DataFrame,
    keys: Sequence[str],
    optional_keys: Sequence[str] = (),
    settlement_prefix: str = "settlement_",
    interchange_prefix: str = "interchange_",
) -> DataFrame:
    """Full outer match of settlement and interchange groups with their differences.

    ``optional_keys`` match a missing value with a missing one. Both sides are
    already grouped, so the join moves one row per group.
    """
    plain = [k for k in keys if k not in optional_keys]
    left = settlement.select(
        *[F.col(k).alias(settlement_prefix + k) for k in keys],
        *[c for c in settlement.columns if c in ("settlement_count", "settlement_amount", "settlement_irf_amount")],
        F.col("app_processing_date").alias("_left_day"),
    )
    right = interchange.select(
        *[F.col(k).alias(interchange_prefix + k) for k in keys],
        "interchange_count",
        "interchange_amount",
        "interchange_irf_amount",
        F.col("app_processing_date").alias("_right_day"),
    )
    hit = reduce(
        lambda a, b: a & b, [F.col(settlement_prefix + k) == F.col(interchange_prefix + k) for k in plain]
    )
    for k in optional_keys:
        hit = hit & (
            F.coalesce(F.col(settlement_prefix + k), F.lit("")) == F.coalesce(F.col(interchange_prefix + k), F.lit(""))
        )
    joined = left.join(right, hit, "full_outer")
    seen = F.coalesce("settlement_count", F.lit(0))
    ours = F.coalesce("interchange_count", F.lit(0))
    zero = F.lit(0.0)
    return (
        joined.withColumns(
            {
                "report_processing_date": F.coalesce("_left_day", "_right_day"),
                "diff_count": seen - ours,
                "diff_amount": F.coalesce("settlement_amount", zero) - F.coalesce("interchange_amount", zero),
                "diff_irf_amount": F.coalesce("settlement_irf_amount", zero)
                - F.coalesce("interchange_irf_amount", zero),
                "diff_count_abs": F.abs(ours - seen),
                "metric_count": F.least(ours, seen),
                "metric_excess_count": F.greatest(ours - seen, F.lit(0)),
            }
        )
        .withColumn(
            "absolute_error",
            F.try_divide(
                (F.col("diff_count_abs") - F.col("metric_excess_count")).cast("double"),
                F.coalesce("settlement_count", F.lit(1)).cast("double"),
            ),
        )
        .drop("_left_day", "_right_day")
    )


def with_rule_order(reconciled: DataFrame, orders: DataFrame, scope: str, descriptor: str) -> DataFrame:
    """Add the number of the rule a group belongs to."""
    side = orders.select(
        F.col("region_country_code").alias("jurisdiction_rule"),
        F.col("fee_descriptor").alias("descriptor_rule"),
        "order_rule",
    )
    where = F.coalesce(f"settlement_{scope}", f"interchange_{scope}")
    what = F.coalesce(f"settlement_{descriptor}", f"interchange_{descriptor}")
    return reconciled.join(
        side, (where == F.col("jurisdiction_rule")) & (what == F.col("descriptor_rule")), "left"
    )


def reconciliation_summary(reconciled: DataFrame) -> DataFrame:
    """One row: settled count, unexplained difference and its share."""
    gap = F.sum("diff_count_abs") - F.sum("metric_excess_count")
    return reconciled.agg(
        F.sum("settlement_count").alias("settlement_count"),
        gap.alias("diff"),
        F.try_divide(gap.cast("double"), F.sum("settlement_count").cast("double")).alias("absolute_error"),
    )


def with_report_ids(reconciled: DataFrame, order: Sequence[Column], last_id: int = 0) -> DataFrame:
    """Number the report rows after the last id in use."""
    return global_row_number(reconciled, order, "app_id", last_id + 1)
