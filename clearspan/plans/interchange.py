"""Interchange: evaluation row, first matching rule, fee."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearspan.functions.numbers import is_number
from clearspan.functions.text import text_or_blank
from clearspan.operators.fees import clamped_fee, fee_rate
from clearspan.operators.fx import RateMaps, brand_rates, converted, currencies_in, rate_into
from clearspan.operators.rules import (
    AMOUNT,
    COMPARE,
    MEMBER,
    RANGE,
    RULES_PER_PASS,
    SPACE,
    RuleBook,
    amount_currencies,
    assign_first_rule,
)
from clearspan.operators.stages import end_generated_code
from clearspan.plans.calculated import BITMAP_BRAND, TEXT_BRAND

# --- fixed values -------------------------------------------------------------
#: Rule conditions of the text brand and the transaction field each one looks at.
TEXT_ATTRIBUTES = {
    "issuer_country": "ardef_country",
    "issuer_region": "issuer_region",
    "technology_indicator": "technology_indicator",
    "product_id": "product_id",
    "fast_funds": "fast_funds",
    "travel_indicator": "travel_indicator",
    "b2b_program_id": "b2b_program_id",
    "account_funding_source": "funding_source",
    "nnss_indicator": "nnss_indicator",
    "product_subtype": "product_subtype",
    "transaction_code_qualifier": "transaction_code_qualifier_0",
    "payment_credential_combination": "account_number",
    "acquirer_country": "merchant_country_code",
    "acquirer_region": "merchant_region",
    "merchant_country_code": "merchant_country_code",
    "merchant_country_region": "merchant_region",
    "merchant_category_code": "merchant_category_code",
    "requested_payment_service": "requested_payment_service",
    "usage_code": "usage_code",
    "authorization_characteristics_indicator": "authorization_characteristics_indicator",
    "authorization_code": "authorization_code_valid",
    "pos_terminal_capability": "pos_terminal_capacity",
    "cardholder_id_method": "cardholder_id_method",
    "pos_entry_mode": "pos_entry_mode",
    "timeliness": "timeless",
    "reimbursement_attribute": "reimbursement_attribute",
    "special_condition_indicator": "special_condition_indicator_merchant_transaction_indicator",
    "fee_program_indicator": "fee_program_indicator",
    "moto_eci_indicator": "motoec_indicator",
    "acceptance_terminal_indicator": "acceptance_terminal_indicator",
    "prepaid_card_indicator": "prepaid_card_indicator",
    "pos_environment_code": "pos_environment",
    "business_application_id": "business_application_id_cr",
    "type_purchase": "type_of_purchase_fl",
    "authorized_amount": "authorized_amount",
    "authorization_response_code": "authorization_response_code",
    "merchant_verification_value": "merchant_verification_value",
    "dynamic_currency_conversion_indicator": "dcc_indicator",
    "cvv2_result_code": "cvv_result_code",
    "national_tax_indicator": "national_tax_included",
    "merchant_vat": "merchant_vat_registration_number",
    "summary_commodity": "summary_commodity_code",
    "acquirer_bin": "account_reference_number_acquiring_identifier",
    "acquirer_business_id": "acquirer_business_id",
}
#: The same for online records.
ONLINE_ATTRIBUTES = {
    "issuer_country": "ardef_country",
    "issuer_region": "issuer_region",
    "technology_indicator": "technology_indicator",
    "product_id": "product_id",
    "fast_funds": "fast_funds",
    "travel_indicator": "travel_indicator",
    "b2b_program_id": "b2b_program_id",
    "account_funding_source": "funding_source",
    "nnss_indicator": "nnss_indicator",
    "product_subtype": "product_subtype",
    "acquirer_country": "card_acceptor_country",
    "acquirer_region": "merchant_region",
    "merchant_country_code": "card_acceptor_country",
    "merchant_country_region": "merchant_region",
    "merchant_category_code": "merchants_type",
    "authorization_characteristics_indicator": "authorization_characteristics_indicator_sms",
    "authorization_code": "authorization_code_valid",
    "pos_terminal_capability": "pos_terminal_entry_capability",
    "cardholder_id_method": "customer_identification_method",
    "timeliness": "timeless",
    "reimbursement_attribute": "reimbursement_attribute_sms",
    "special_condition_indicator": "chargeback_special_condition_merchant_indicator",
    "fee_program_indicator": "fee_program_indicator_sms",
    "moto_eci_indicator": "mailtelephone_or_electronic_commerce_indicator",
    "pos_environment_code": "recurring_payment_indicator_flag",
    "business_application_id": "business_application_identifier",
    "network_identification_code": "network_id",
    "message_reason_code": "message_reason_code_sms",
    "surcharge_amount": "surcharge_amount_sms",
    "authorization_response_code": "response_code",
    "merchant_verification_value": "mvv_code",
    "dynamic_currency_conversion_indicator": "dcc_indicator_sms",
    "cvv2_result_code": "cvv_result_code_sms",
    "point_of_service_condition_code": "pos_condition_code",
    "acquirer_bin": "acquiring_institution_id_1",
    "acquirer_business_id": "acquirer_business_id_sms",
}
#: The same for the bitmap brand.
BITMAP_ATTRIBUTES = {
    "card_acceptor_business_code": "card_acceptor_business_code_mcc",
    "gcms_product_identifier": "gcms_product_identifier",
    "funding_source": "funding_source",
    "electronic_commerce_indicator_3": "electronic_commerce_indicator_3",
}
#: Kinds of conditions that are not plain membership.
TEXT_KINDS = {
    "nnss_indicator": SPACE,
    "cardholder_id_method": SPACE,
    "moto_eci_indicator": SPACE,
    "acceptance_terminal_indicator": SPACE,
    "merchant_vat": SPACE,
    "transaction_amount": AMOUNT,
    "surcharge_amount": COMPARE,
    "timeliness": COMPARE,
    "merchant_category_code": RANGE,
    "issuer_bin_8": RANGE,
}
BITMAP_KINDS = {
    "amount_transaction": AMOUNT,
    "issuer_bin_8": RANGE,
    "acquirer_bin": RANGE,
    "electronic_commerce_indicator_3": RANGE,
    "card_acceptor_business_code": RANGE,
}
#: Conditions that exist only for one kind of record.
TEXT_EXTRA = [
    "transaction_code",
    "business_mode",
    "business_format_code",
    "network_identification_code",
    "message_reason_code",
    "surcharge_amount",
    "transaction_amount",
    "authorization_characteristics_indicator_5",
    "issuer_bin_8",
]
ONLINE_EXTRA = [
    "business_mode",
    "transaction_code",
    "pos_entry_mode",
    "acceptance_terminal_indicator",
    "processing_code_transaction_type",
    "transaction_amount",
    "issuer_bin_8",
]
BITMAP_EXTRA = ["processing_code", "amount_transaction", "issuer_bin_8", "acquirer_bin"]
#: Optional record formats of the text brand in the order they are looked at.
FORMATS = ["SP", "SD", "PD", "FT", "FL", "DF", "CR"]
# -------------------------------------------------------------------------------


#: Prefix of the evaluation columns while a rule is looked for.
MARK = "@"


def _kinds(names: Sequence[str], special: Mapping[str, str]) -> dict[str, str]:
    return {n: special.get(n, MEMBER) for n in names}


TEXT_BOOK = RuleBook(
    scope={MARK + "jurisdiction_key": "region_country_code"},
    kinds=_kinds([*TEXT_ATTRIBUTES, *TEXT_EXTRA], TEXT_KINDS),
    amount_currency="transaction_amount_currency",
    row_prefix=MARK,
)
ONLINE_BOOK = RuleBook(
    scope={MARK + "jurisdiction_key": "region_country_code"},
    kinds=_kinds([*ONLINE_ATTRIBUTES, *ONLINE_EXTRA], TEXT_KINDS),
    amount_currency="transaction_amount_currency",
    row_prefix=MARK,
)
BITMAP_BOOK = RuleBook(
    scope={MARK + "jurisdiction_key": "region_country_code", MARK + "ird": "ird"},
    kinds=_kinds([*BITMAP_ATTRIBUTES, *BITMAP_EXTRA], BITMAP_KINDS),
    amount_currency="amount_transaction_currency",
    row_prefix=MARK,
)


def _regions(rows: DataFrame, countries: DataFrame, issuer: str, merchant: str) -> DataFrame:
    if "visa_region_code" not in countries.columns:
        return rows
    side = countries.select("country_code", F.col("visa_region_code").cast("string").alias("_region"))
    issuers = side.toDF("_ic", "issuer_region")
    merchants = side.toDF("_mc", "merchant_region")
    return (
        rows.join(issuers, F.col(issuer) == F.col("_ic"), "left")
        .join(merchants, F.col(merchant) == F.col("_mc"), "left")
        .drop("_ic", "_mc")
    )


def _attributes(rows: DataFrame, names: Mapping[str, str], extra: Mapping[str, Column]) -> DataFrame:
    """Add the evaluation columns of the rule conditions, ``BLANK`` where nothing is known."""
    present = set(rows.columns)
    columns = {a: text_or_blank(F.col(c)) if c in present else F.lit("BLANK") for a, c in names.items()}
    columns.update({a: text_or_blank(c) for a, c in extra.items()})
    return rows.select("*", *[c.alias(MARK + a) for a, c in columns.items()])


def _first_format(rows: DataFrame, column: str, formats: Sequence[str]) -> Column:
    """Value of ``column`` from the first record format that is filled in."""
    out = None
    for f in formats:
        flag, value = f"business_format_code_{f.lower()}", f"{column}_{f.lower()}"
        if flag in rows.columns and value in rows.columns:
            out = F.when(F.col(flag) == f, F.col(value)) if out is None else out.when(F.col(flag) == f, F.col(value))
    return F.lit(None).cast("string") if out is None else out


def _assign(rows: DataFrame, rules: DataFrame, book: RuleBook, payload: Sequence[str], on_date: str | None, per_pass: int) -> DataFrame:
    """Add the payload of the first rule and drop the evaluation columns.

    ``on_date`` is a column of the row, or a fixed day.
    """
    day = None
    if on_date is not None:
        day = (F.col(on_date) if on_date in rows.columns else F.lit(on_date)).cast("date")
    done = assign_first_rule(rows, rules, book, payload, day, per_pass)
    return done.drop(*[c for c in done.columns if c.startswith(MARK)])


FEE_COLUMNS = ["fee_currency", "fee_variable", "fee_fixed", "fee_min", "fee_cap"]


def text_interchange(
    txn: DataFrame,
    rules: DataFrame,
    countries: DataFrame,
    currencies: DataFrame,
    rates: DataFrame,
    on_date: str = "app_processing_date",
    per_pass: int = RULES_PER_PASS,
) -> DataFrame:
    """Rule and fee of clearing transactions that already carry their calculated fields."""
    brand = brand_rates(rates, TEXT_BRAND)
    names = currencies.select(
        F.col("currency_numeric_code").cast("int").alias("_num"),
        F.col("currency_alphabetic_code").alias("_currency"),
    )
    rows = _regions(txn, countries, "ardef_country", "merchant_country_code").join(
        names, F.col("source_currency_code").try_cast("int") == F.col("_num"), "left"
    )
    targets = amount_currencies(rules, TEXT_BOOK)
    # one lookup serves the amounts that rules compare and, once a rule is found, its fee
    maps = RateMaps(brand, sorted({*targets, *currencies_in(rules, "fee_currency")}))
    rows = maps.onto(rows, "_fx", F.col("purchase_date"), F.col("_currency"))
    rows = converted(rows, "_fx", F.col("source_amount"), F.col("_currency"), targets, f"{MARK}transaction_amount")
    code = F.right(F.lpad(F.col("transaction_code").cast("string"), 2, "0"), F.lit(2))
    rows = _attributes(
        rows,
        TEXT_ATTRIBUTES,
        {
            "jurisdiction_key": F.upper("jurisdiction_assigned"),
            "business_mode": F.upper("business_mode"),
            "transaction_code": code,
            "business_format_code": _first_format(rows, "business_format_code", FORMATS),
            "network_identification_code": _first_format(rows, "network_identification_code", ["SD", "DF", "SP"]),
            "message_reason_code": _first_format(rows, "message_reason_code", ["SD", "DF", "SP"]),
            "surcharge_amount": _first_format(rows, "surcharge_amount", ["SD", "SP"]),
            "authorization_characteristics_indicator_5": (
                F.substring(F.col("pan_token").cast("string"), 2, 1)
                if "pan_token" in rows.columns
                else F.lit(None).cast("string")
            ),
            "issuer_bin_8": F.left(F.col("account_number").cast("string"), F.lit(8)),
        },
    )
    payload = ["region_country_code", "rule_id", *FEE_COLUMNS]
    done = _assign(rows, rules, TEXT_BOOK, payload, on_date, per_pass)
    rate = rate_into("_fx", F.col("_currency"), F.col("fee_currency"))
    return _with_fee(
        done, F.col("source_amount"), F.col("source_currency_code"), FEE_COLUMNS, F.col("_currency"), rate
    ).drop("_num", "_currency", "_fx", "issuer_region", "merchant_region")


def _with_fee(rows: DataFrame, amount: Column, currency: Column, fee: Sequence[str], name: Column, rate: Column) -> DataFrame:
    ccy, variable, fixed, low, cap = (F.col(c) for c in fee)
    return rows.withColumns(
        {
            "amount_transaction": amount,
            "currency_transaction": currency,
            "calculated_value": clamped_fee(
                amount,
                fee_rate(ccy, name, rate),
                variable.try_cast("double"),
                fixed.cast("double"),
                low.cast("double"),
                cap.cast("double"),
                variable.isNull() | is_number(variable.cast("string")) | variable.cast("string").rlike("^[0-9.]+E-?[0-9]+$"),
            ),
        }
    )


def online_interchange(
    txn: DataFrame,
    rules: DataFrame,
    countries: DataFrame,
    currencies: DataFrame,
    rates: DataFrame,
    on_date: str = "app_processing_date",
    per_pass: int = RULES_PER_PASS,
) -> DataFrame:
    """Rule and fee of online transactions that already carry their calculated fields.

    A zero transaction amount is replaced by cryptogram plus surcharge amount, in the
    cryptogram currency.
    """
    brand = brand_rates(rates, TEXT_BRAND)
    codes = currencies.select(
        F.col("currency_numeric_code").cast("int").alias("_num"), F.col("currency_alphabetic_code").alias("_name")
    )
    rows = (
        _regions(txn, countries, "ardef_country", "card_acceptor_country")
        .join(codes.toDF("_num1", "_currency"), F.col("transaction_currency_code").try_cast("int") == F.col("_num1"), "left")
        .join(codes.toDF("_num2", "_cryptogram"), F.col("cryptogram_currency_code").try_cast("int") == F.col("_num2"), "left")
    )
    targets = amount_currencies(rules, ONLINE_BOOK)
    maps = RateMaps(brand, sorted({*targets, *currencies_in(rules, "fee_currency")}))
    rows = maps.onto(rows, "_fx", F.col("local_transaction_date"), F.col("_currency"))
    rows = converted(rows, "_fx", F.col("transaction_amount"), F.col("_currency"), targets, f"{MARK}transaction_amount")
    # a fee on a cryptogram amount starts from the cryptogram's currency
    rows = maps.onto(rows, "_fx2", F.col("local_transaction_date"), F.col("_cryptogram"))

    def optional(name: str) -> Column:
        return F.col(name).cast("string") if name in rows.columns else F.lit(None).cast("string")

    rows = _attributes(
        rows,
        ONLINE_ATTRIBUTES,
        {
            "jurisdiction_key": F.upper("jurisdiction_assigned"),
            "business_mode": F.upper("business_mode"),
            "transaction_code": F.col("transaction_code_sms"),
            "pos_entry_mode": F.left(optional("pos_entry_mode_sms"), F.lit(2)),
            "acceptance_terminal_indicator": F.right(optional("pos_terminal_type"), F.lit(1)),
            "processing_code_transaction_type": F.left(F.col("processing_code").cast("string"), F.lit(2)),
            "issuer_bin_8": F.left(F.col("card_number").cast("string"), F.lit(8)),
        },
    )
    payload = ["region_country_code", "rule_id", *FEE_COLUMNS]
    done = _assign(rows, rules, ONLINE_BOOK, payload, on_date, per_pass)
    plain = F.coalesce(F.col("transaction_amount") != 0, F.lit(False))
    amount = F.when(plain, F.col("transaction_amount")).otherwise(
        F.col("cryptogram_amount") + F.col("surcharge_amount_sms")
    )
    name = F.when(plain, F.col("_currency")).otherwise(F.col("_cryptogram"))
    fee = F.col("fee_currency")
    rate = F.when(plain, rate_into("_fx", F.col("_currency"), fee)).otherwise(rate_into("_fx2", F.col("_cryptogram"), fee))
    currency = F.coalesce(F.col("transaction_currency_code").cast("string"), F.col("cryptogram_currency_code").cast("string"))
    return _with_fee(done, amount, currency, FEE_COLUMNS, name, rate).drop(
        "_num1", "_num2", "_currency", "_cryptogram", "_fx", "_fx2", "issuer_region", "merchant_region"
    )


RATE_COLUMNS = ["rate_currency", "rate_variable", "rate_fixed", "rate_min", "rate_cap"]


def bitmap_interchange(
    txn: DataFrame,
    rules: DataFrame,
    currencies: DataFrame,
    rates: DataFrame,
    on_date: str = "app_processing_date",
    per_pass: int = RULES_PER_PASS,
    condition_brand: str = BITMAP_BRAND,
) -> DataFrame:
    """Rule and fee of bitmap transactions that already carry their calculated fields.

    Rules are filed by jurisdiction and rate code. ``condition_brand`` is the brand
    whose rates convert the amounts compared with rule amounts.
    """
    names = currencies.select(
        F.col("currency_numeric_code").cast("int").alias("_num"), F.col("currency_alphabetic_code").alias("_currency")
    )
    day = F.to_date("date_and_time_local_transaction")
    rows = txn.join(names, F.col("currency_code_transaction") == F.col("_num"), "left")
    targets = amount_currencies(rules, BITMAP_BOOK)
    fees = currencies_in(rules, "rate_currency")
    own = RateMaps(brand_rates(rates, BITMAP_BRAND), sorted({*targets, *fees}))
    rows = own.onto(rows, "_fx", day, F.col("_currency"))
    if condition_brand == BITMAP_BRAND:
        rows = converted(rows, "_fx", F.col("amount_transaction"), F.col("_currency"), targets, f"{MARK}amount_transaction")
    else:
        other = RateMaps(brand_rates(rates, condition_brand), targets).onto(rows, "_fx2", day, F.col("_currency"))
        rows = converted(other, "_fx2", F.col("amount_transaction"), F.col("_currency"), targets, f"{MARK}amount_transaction").drop("_fx2")
    rows = _attributes(
        rows,
        BITMAP_ATTRIBUTES,
        {
            "jurisdiction_key": F.col("jurisdiction_assigned"),
            "ird": F.trim("business_activity_4"),
            "processing_code": F.trim(F.left("processing_code", F.lit(2))),
            "issuer_bin_8": F.trim(F.left(F.col("pan").cast("string"), F.lit(8))),
            "acquirer_bin": F.substring("acquirer_reference_data", 2, 6),
        },
    )
    payload = ["region_country_code", "ird", "rule_id", *RATE_COLUMNS]
    done = _assign(rows, rules, BITMAP_BOOK, payload, on_date, per_pass)
    rate = rate_into("_fx", F.col("_currency"), F.col("rate_currency"))
    return _with_fee(
        done, F.col("amount_transaction"), F.col("currency_code_transaction"), RATE_COLUMNS, F.col("_currency"), rate
    ).drop("_num", "_currency", "_fx")
