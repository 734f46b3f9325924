"""Calculated fields of typed transactions: account range, jurisdiction, type, settlement.

Each function takes the typed transactions and returns the same rows with the
calculated columns added. The chain has no shuffle of the transactions as long as
the master tables are small enough to be broadcast (Spark and the range lookup check
their size).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearspan.functions import cards
from clearspan.functions.dates import days_between
from clearspan.operators.fees import settlement_report_amount
from clearspan.operators.fx import RateMaps, brand_rates, currencies_in
from clearspan.operators.ranges import account_point, best_range, dedupe_ranges, prefix_bounds
from clearspan.operators.skew import counted_broadcast
from clearspan.operators.stages import end_generated_code

# --- fixed values -------------------------------------------------------------
TEXT_BRAND, BITMAP_BRAND = "VISA", "MasterCard"
CLEARING_DIGITS, ONLINE_DIGITS = 16, 19
#: Account range attributes handed on to transactions.
TEXT_RANGE_VALUES = [
    "ardef_country",
    "account_funding_source",
    "product_id",
    "issuer_country",
    "technology_indicator",
    "fast_funds",
    "travel_indicator",
    "b2b_program_id",
    "nnss_indicator",
    "product_subtype",
]
BITMAP_RANGE_VALUES = ["iar_country", "gcms_product_identifier", "funding_source", "card_program_identifier"]
TRANSACTION_MESSAGES = ["1240", "1442"]
#: Messages that get a settlement amount when the second code is read as written (1422).
STRICT_AMOUNT_MESSAGES = ["1240", "1422"]
FILE_HEADER_MESSAGE, FILE_HEADER_FUNCTION = "1644", 697
#: Customers up to which they are broadcast.
SMALL_OWNERS = 100_000
# -------------------------------------------------------------------------------


def _newest() -> Column:
    """Ordering key that puts the newest range first."""
    return -F.unix_date("app_date_valid")


def text_ranges(ardef: DataFrame, on_date: str, digits: int = CLEARING_DIGITS) -> DataFrame:
    """Account ranges of the text brand known on a day, one per low key."""
    low, high = prefix_bounds(F.col("low_key_for_range"), F.col("table_key"), digits)
    known = ardef.filter(F.col("app_date_valid") <= F.lit(on_date).cast("date")).select(
        "app_date_valid",
        low.alias("low_key"),
        high.alias("high_key"),
        "delete_indicator",
        F.col("country").alias("issuer_country"),
        *[c for c in TEXT_RANGE_VALUES if c != "issuer_country"],
    )
    return dedupe_ranges(
        known,
        "low_key",
        [
            _newest(),
            F.col("delete_indicator").isNull(),
            F.col("delete_indicator"),
            -F.col("high_key"),
            F.struct(*TEXT_RANGE_VALUES),
        ],
    )


def bitmap_ranges(iar: DataFrame, products: DataFrame, on_date: str) -> DataFrame:
    """Active account ranges of the bitmap brand known on a day, one per low key."""
    brand = products.filter(F.col("active_inactive_code") == "A").select(
        "licensed_product_id",
        F.col("gcms_product_id").alias("gcms_product_identifier"),
        F.col("product_category").alias("funding_source"),
    )
    known = (
        iar.filter(
            (F.to_date("app_date_valid") <= F.lit(on_date).cast("date")) & (F.col("active_inactive_code") == "A")
        )
        .join(brand, "licensed_product_id", "left")
        .select(
            F.to_date("app_date_valid").alias("app_date_valid"),
            F.left(F.col("low_range").cast("string"), F.lit(18)).cast("bigint").alias("low_key"),
            F.left(F.col("high_range").cast("string"), F.lit(18)).cast("bigint").alias("high_key"),
            F.col("card_country_alpha").alias("iar_country"),
            F.col("card_program_priority").try_cast("double").alias("_priority"),
            "gcms_product_identifier",
            "funding_source",
            "card_program_identifier",
        )
    )
    return dedupe_ranges(
        known,
        "low_key",
        [_newest(), F.col("_priority").isNull(), F.col("_priority"), F.struct(*BITMAP_RANGE_VALUES)],
    ).drop("_priority")


def _enrich(
    txn: DataFrame, ranges: DataFrame, point: Column, values: Sequence[str], keep_unmatched: bool
) -> DataFrame:
    order = [_newest(), -F.col("high_key"), -F.col("low_key")]
    return best_range(txn, ranges, point, "low_key", "high_key", order, values, keep_unmatched)


def _country(countries: DataFrame, key: str, prefix: str, region: str) -> DataFrame:
    return countries.select(
        F.col(key).alias(f"_{prefix}_key"),
        F.col("country_code").alias(f"_{prefix}_country"),
        F.col(region).cast("string").alias(f"_{prefix}_region"),
    )


def _customer(customers: DataFrame, currencies: DataFrame) -> DataFrame:
    """Customers with the numbers of their currencies; up to ``SMALL_OWNERS`` are broadcast."""
    codes = currencies.select("currency_alphabetic_code", F.col("currency_numeric_code").cast("int").alias("_num"))
    local = codes.toDF("local_currency_code", "_local_num")
    settle = codes.toDF("settlement_currency_code", "_settle_num")
    owners = (
        customers.select(
            F.col("code").alias("_code"),
            "acquiring_bins",
            "issuing_bins_6_digits",
            "issuing_bins_8_digits",
            "local_currency_code",
            "settlement_currency_code",
        )
        .join(local, "local_currency_code", "left")
        .join(settle, "settlement_currency_code", "left")
    )
    return counted_broadcast(owners, customers, SMALL_OWNERS)


_OWNER_COLUMNS = [
    "_code",
    "acquiring_bins",
    "issuing_bins_6_digits",
    "issuing_bins_8_digits",
    "local_currency_code",
    "settlement_currency_code",
    "_local_num",
    "_settle_num",
]
_PLACE_COLUMNS = [f"_{side}_{part}" for side in ("m", "i") for part in ("key", "country", "region")]


def _own_currencies(customers: DataFrame) -> list[str]:
    """Settlement and local currencies of the customers."""
    return sorted({*currencies_in(customers, "settlement_currency_code"), *currencies_in(customers, "local_currency_code")})


def _own_rates(currency: Column) -> tuple[Column, Column]:
    """Rates from a numeric currency into the customer's settlement and local currency, from the row's rate map."""

    def into(target: str, number: str) -> Column:
        known = F.try_element_at(F.col("_fx"), F.col(target))
        return F.when(currency == F.col(number).cast("string"), F.lit(1.0)).otherwise(known)

    return into("settlement_currency_code", "_settle_num"), into("local_currency_code", "_local_num")


def _own_issuer(number: Column) -> Column:
    return cards.in_bin_list(number, F.col("issuing_bins_6_digits"), 6) | cards.in_bin_list(
        number, F.col("issuing_bins_8_digits"), 8
    )


def text_calculated_fields(
    txn: DataFrame,
    ardef: DataFrame,
    countries: DataFrame,
    customers: DataFrame,
    currencies: DataFrame,
    rates: DataFrame,
    on_date: str,
    keep_unmatched: bool = False,
) -> DataFrame:
    """Clearing transactions of the text brand with their calculated fields.

    Transactions without an account range are left out unless ``keep_unmatched``.
    """
    merchant = F.trim("merchant_country_code")
    rows = _enrich(
        end_generated_code(txn), text_ranges(ardef, on_date), account_point(F.col("account_number"), CLEARING_DIGITS),
        TEXT_RANGE_VALUES, keep_unmatched,
    )
    rows = (
        rows.join(_country(countries, "country_code", "m", "visa_region_code"), merchant == F.col("_m_key"), "left")
        .join(
            _country(countries, "country_code", "i", "visa_region_code"), F.col("ardef_country") == F.col("_i_key"), "left"
        )
        .join(_customer(customers, currencies), F.col("app_customer_code") == F.col("_code"), "left")
    )
    collection = F.coalesce(F.upper("collection_only_flag") == "C", F.lit(False))
    own = F.when(
        F.col("app_type_file") == "IN",
        cards.in_bin_list(F.col("account_reference_number_acquiring_identifier"), F.col("acquiring_bins"), 6),
    ).otherwise(_own_issuer(F.col("account_number")))
    scope = cards.jurisdiction(
        F.col("ardef_country"),
        merchant,
        F.col("_i_region"),
        F.col("_m_region"),
        own | collection,
        F.col("app_type_file").isin("IN", "OUT"),
    )
    code, usage = F.col("transaction_code"), F.col("usage_code")
    rows = rows.withColumns(
        {
            "authorization_code_valid": cards.authorization_validity(F.col("authorization_code")),
            "business_mode": cards.business_mode(F.col("app_type_file")),
            "jurisdiction": scope,
            "jurisdiction_country": F.col("_m_country"),
            "jurisdiction_region": F.col("_m_region"),
            "timeless": days_between(F.col("central_processing_date"), F.col("purchase_date")),
            "funding_source": F.col("account_funding_source"),
            "reversal_indicator": cards.reversal_flag(code, usage),
            "business_transaction_type": cards.transaction_type(
                code,
                F.col("app_type_file"),
                F.col("merchant_category_code"),
                usage,
                F.col("transaction_code_qualifier_0"),
                F.col("special_condition_indicator_merchant_transaction_indicator"),
            ),
            "business_transaction_cycle": cards.transaction_cycle(code, usage),
        }
    ).withColumn(
        "jurisdiction_assigned",
        cards.assigned_jurisdiction(F.col("jurisdiction"), F.col("jurisdiction_region"), F.col("jurisdiction_country")),
    )
    rows = end_generated_code(rows)
    currency = F.col("source_currency_code")
    maps = RateMaps(brand_rates(rates, TEXT_BRAND), _own_currencies(customers), "currency_from_code")
    rows = maps.onto(rows, "_fx", F.col("app_processing_date"), currency)
    to_settlement, to_local = _own_rates(currency.cast("string"))
    local = F.coalesce(F.col("jurisdiction").isin("on-us", "off-us") & (F.col("settlement_flag") != 0), F.lit(False))
    return rows.withColumns(
        {
            "settlement_report_amount": settlement_report_amount(
                F.col("source_amount"), local, to_local, to_settlement
            ),
            "settlement_report_currency_code": F.when(local, F.col("local_currency_code")).otherwise(
                F.col("settlement_currency_code")
            ),
        }
    ).drop("_fx", *_OWNER_COLUMNS, *_PLACE_COLUMNS)


def online_calculated_fields(
    txn: DataFrame,
    ardef: DataFrame,
    countries: DataFrame,
    customers: DataFrame,
    currencies: DataFrame,
    types: DataFrame,
    on_date: str,
    keep_unmatched: bool = False,
) -> DataFrame:
    """Online (single message) transactions with their calculated fields.

    ``types`` maps business types to transaction groups.
    """
    merchant = F.trim("card_acceptor_country")
    side = F.upper("issuer_acquirer_indicator")
    number = end_generated_code(txn.withColumnRenamed("account_funding_source", "record_funding_source"))
    rows = _enrich(
        number, text_ranges(ardef, on_date, ONLINE_DIGITS), account_point(F.col("card_number"), ONLINE_DIGITS),
        TEXT_RANGE_VALUES, keep_unmatched,
    )
    rows = (
        rows.join(_country(countries, "country_code", "m", "visa_region_code"), merchant == F.col("_m_key"), "left")
        .join(
            _country(countries, "country_code", "i", "visa_region_code"), F.col("ardef_country") == F.col("_i_key"), "left"
        )
        .join(_customer(customers, currencies), F.col("app_customer_code") == F.col("_code"), "left")
    )
    rows = end_generated_code(rows)
    own = F.when(
        side == "I", cards.in_bin_list(F.col("acquiring_institution_id_1"), F.col("acquiring_bins"), 6)
    ).otherwise(_own_issuer(F.col("card_number")))
    request, response = F.col("request_message_type"), F.col("response_code")
    group = types.select(
        F.col("business_transaction_type_id").cast("int").alias("_type"), F.col("transaction_type_id").alias("_group")
    )
    settle = currencies.select(
        F.col("currency_numeric_code").cast("string").alias("_settle"),
        F.col("currency_alphabetic_code").alias("settlement_report_currency_code"),
    )
    rows = rows.withColumns(
        {
            "authorization_code_valid": cards.authorization_validity(F.col("authorization_id_resp_code")),
            "business_mode": cards.lookup(side, cards.ONLINE_BUSINESS_MODES),
            "jurisdiction": cards.jurisdiction(
                F.col("ardef_country"), merchant, F.col("_i_region"), F.col("_m_region"), own, side.isin("I", "A")
            ),
            "jurisdiction_country": F.col("_m_country"),
            "jurisdiction_region": F.col("_m_region"),
            "timeless": days_between(F.col("app_processing_date"), F.col("local_transaction_date")),
            "funding_source": F.col("account_funding_source"),
            "reversal_indicator": cards.online_reversal_flag(request, response),
            "business_transaction_type": cards.online_transaction_type(
                request, response, F.col("processing_code"), F.col("pos_condition_code"), F.col("merchants_type")
            ),
            "business_transaction_cycle": F.lit(None).cast("int"),
        }
    ).withColumn(
        "jurisdiction_assigned",
        cards.assigned_jurisdiction(F.col("jurisdiction"), F.col("jurisdiction_region"), F.col("jurisdiction_country")),
    )
    return (
        end_generated_code(rows)
        .join(group, F.col("business_transaction_type") == F.col("_type"), "left")
        .join(settle, F.col("settlement_currency_code_sms").cast("string") == F.col("_settle"), "left")
        .withColumn("transaction_code_sms", cards.online_clearing_code(F.col("_group"), F.col("reversal_indicator")))
        .withColumn("settlement_report_amount", F.col("settlement_amount"))
        .drop("_type", "_group", "_settle", *_OWNER_COLUMNS, *_PLACE_COLUMNS)
    )


def bitmap_calculated_fields(
    elements: DataFrame,
    iar: DataFrame,
    products: DataFrame,
    countries: DataFrame,
    customers: DataFrame,
    currencies: DataFrame,
    rates: DataFrame,
    on_date: str,
    keep_unmatched: bool = True,
    strict_messages: bool = False,
) -> DataFrame:
    """Transactions of the bitmap brand with their calculated fields.

    The region is the issuer's. Transactions without an account range stay with
    null attributes. Amounts are only given where the file has a header message.
    """
    headers = (
        elements.filter(
            (F.col("app_message_type") == FILE_HEADER_MESSAGE) & (F.col("function_code") == FILE_HEADER_FUNCTION)
        )
        .groupBy(F.col("app_hash_file").alias("_file"))
        .agg(F.min("file_id").alias("mc_file_id"))
    )
    txn = elements.filter(F.col("app_message_type").isin(*TRANSACTION_MESSAGES)).withColumns(
        {
            "num_card": F.left(F.rpad(F.col("pan").cast("string"), 18, "0"), F.lit(18)).cast("bigint"),
            "acquirer_bin": F.substring("acquirer_reference_data", 2, 6),
        }
    )
    rows = _enrich(end_generated_code(txn), bitmap_ranges(iar, products, on_date), F.col("num_card"), BITMAP_RANGE_VALUES, keep_unmatched)
    merchant = F.col("card_acceptor_country_code")
    rows = (
        rows.join(
            _country(countries, "country_code_alternative", "m", "mastercard_region_code"),
            merchant == F.col("_m_key"),
            "left",
        )
        .join(
            _country(countries, "country_code_alternative", "i", "mastercard_region_code"),
            F.col("iar_country") == F.col("_i_key"),
            "left",
        )
        .join(_customer(customers, currencies), F.col("app_customer_code") == F.col("_code"), "left")
        .join(headers, F.col("app_hash_file") == F.col("_file"), "left")
    )
    collection = F.coalesce(F.upper("settlement_indicator_1") == "C", F.lit(False))
    own = F.when(
        F.col("app_type_file") == "IN", cards.in_bin_list(F.col("acquirer_bin"), F.col("acquiring_bins"), 6)
    ).otherwise(_own_issuer(F.col("num_card")))
    scope = cards.jurisdiction(
        F.col("iar_country"),
        merchant,
        F.col("_i_region"),
        F.col("_m_region"),
        own | collection,
        F.col("app_type_file").isin("IN", "OUT"),
    )
    rows = rows.withColumns(
        {
            "business_mode": cards.business_mode(F.col("app_type_file")),
            "jurisdiction": scope,
            "jurisdiction_country": F.col("_i_country"),
            "jurisdiction_region": F.col("_i_region"),
        }
    ).withColumn(
        "jurisdiction_assigned",
        cards.assigned_jurisdiction(F.col("jurisdiction"), F.col("jurisdiction_region"), F.col("jurisdiction_country")),
    )
    rows = end_generated_code(rows)
    currency = F.col("currency_code_transaction")
    maps = RateMaps(brand_rates(rates, BITMAP_BRAND), _own_currencies(customers), F.col("currency_from_code").try_cast("int"))
    rows = maps.onto(rows, "_fx", F.col("app_processing_date"), currency)
    to_settlement, to_local = _own_rates(currency.cast("string"))
    names = currencies.select(
        F.col("currency_numeric_code").cast("int").alias("_rec_num"), F.col("currency_alphabetic_code").alias("_rec")
    )
    rows = rows.join(names, F.col("currency_code_reconciliation") == F.col("_rec_num"), "left")
    local = F.coalesce(F.col("jurisdiction").isin("on-us", "off-us") & (currency == F.col("_local_num")), F.lit(False))
    messages = STRICT_AMOUNT_MESSAGES if strict_messages else TRANSACTION_MESSAGES
    given = (
        F.col("app_message_type").isin(*messages) & F.col("mc_file_id").isNotNull() & F.col("iar_country").isNotNull()
    )
    incoming = F.col("app_type_file") == "IN"
    own_currency = F.when(local, F.col("local_currency_code")).otherwise(F.col("settlement_currency_code"))
    converted = settlement_report_amount(F.col("amount_transaction"), local, to_local, to_settlement)
    return rows.withColumns(
        {
            "settlement_report_currency_code": F.when(
                given, F.when(incoming, F.col("_rec")).otherwise(own_currency)
            ),
            "settlement_report_amount": F.when(
                given, F.when(incoming, F.col("amount_reconciliation")).otherwise(converted)
            ),
            "mc_file_id": F.when(given, F.col("mc_file_id")),
        }
    ).drop("_fx", "_rec_num", "_rec", "_file", *_OWNER_COLUMNS, *_PLACE_COLUMNS)
