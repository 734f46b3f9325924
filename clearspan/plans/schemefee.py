"""Scheme fees: transaction detail, monthly cube, code mapping, cost round trip."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearspan.functions import cards
from clearspan.operators.fx import RateMaps, currencies_in, rate_into
from clearspan.operators.ranges import band_join, covering_best, lookup_segments
from clearspan.operators.skew import HOT_ROWS, global_row_number, lookup_join
from clearspan.plans.calculated import BITMAP_BRAND, TEXT_BRAND
from clearspan.session import checkpointed

# --- fixed values -------------------------------------------------------------
GROUPS = ["PUR", "CRD", "CSH"]
CLEARING_CODES = ["05", "06", "07", "25", "26", "27"]
LABELS = {
    "issuing": "VISA ISS",
    "acquiring": "VISA ACQ",
    "text_mirror": "VISA ON-US DUP (ACQ TO ISS)",
    "online": "VISA SMS",
    "online_mirror": "VISA ON-US DUP (SMS TO ISS)",
    "bitmap": "MASTERCARD ISS AND ACQ",
    "bitmap_mirror": "MASTERCARD ON-US DUP (ACQ TO ISS)",
}
#: Brand of the product table.
PRODUCT_BRANDS = {TEXT_BRAND: "VISA", BITMAP_BRAND: "MC"}
DETAIL_COLUMNS = [
    "app_type_file",
    "app_customer_code",
    "app_execution_id",
    "scheme_fee_execution_month",
    "app_id",
    "app_hash_file",
    "table_description",
    "app_processing_date",
    "account_number",
    "card_acceptor_id",
    "account_funding_source",
    "account_range_country",
    "product_id",
    "range_program_id",
    "jurisdiction",
    "business_transaction_type_id",
    "reversal_indicator",
    "currency_local_indicator",
    "motoec_indicator",
    "transaction_count",
    "settlement_amount",
    "transaction_scheme_fee_cost",
    "transaction_brand",
    "merchant_country_code",
    "switch_code",
    "settlement_currency",
    "bank_country",
    "business_mode_id",
    "size_ticket",
    "unitary_scheme_fee_cost",
    "estimated_scheme_fee_cost",
    "unitary_estimated_scheme_fee_cost",
    "transaction_purchase_date",
    "exchange_rate",
    "report_amount",
    "report_currency",
]
#: Customer's flag for on-us transactions that are listed from both sides.
DUPLICATE_FLAGS = {TEXT_BRAND: "duplicate_on_us_flag_visa", BITMAP_BRAND: "duplicate_on_us_flag_mastercard"}
#: Report column -> detail column it groups by.
CUBE_KEYS = {
    "app_execution_id": "app_execution_id",
    "report_month": "scheme_fee_execution_month",
    "report_currency": "report_currency",
    "customer_code": "app_customer_code",
    "bank_country_code": "bank_country",
    "business_mode": "business_mode_id",
    "brand": "transaction_brand",
    "size_ticket": "size_ticket",
    "product_id": "product_id",
    "range_program_id": "range_program_id",
    "founding_source": "account_funding_source",
    "transaction_type": "business_transaction_type_id",
    "jurisdiction": "jurisdiction",
    "reversal_indicator": "reversal_indicator",
    "currency_local_indicator": "currency_local_indicator",
    "card_present_indicator": "motoec_indicator",
    "account_number": "account_number",
    "merchant_country_code": "merchant_country_code",
    "switch_code": "switch_code",
}
ID_ORDER = [
    "account_number",
    "bank_country_code",
    "business_mode",
    "brand",
    "jurisdiction",
    "founding_source",
    "product_id",
    "range_program_id",
    "transaction_type",
    "reversal_indicator",
    "card_present_indicator",
    "currency_local_indicator",
    "merchant_country_code",
    "size_ticket",
    "switch_code",
]
#: Report cost column -> detail cost column.
COSTS = {
    "transaction_scheme_fee_cost": "transaction_scheme_fee_cost",
    "unitary_scheme_fee_cost": "unitary_scheme_fee_cost",
    "estimated_scheme_fee_amount": "estimated_scheme_fee_cost",
    "unitary_estimated_scheme_fee_amount": "unitary_estimated_scheme_fee_cost",
}
#: Returned report column -> report column.
RETURNED_COSTS = {
    "txn_sfc": "transaction_scheme_fee_cost",
    "est_sch_fee_amt": "estimated_scheme_fee_amount",
    "unt_sfc": "unitary_scheme_fee_cost",
    "unt_est_sch_fee_amt": "unitary_estimated_scheme_fee_amount",
}
#: Codes of the older report format.
MODE_CODES = {"acquiring": 1, "issuing": 2}
BRAND_CODES = {BITMAP_BRAND: 1, TEXT_BRAND: 2}
SCOPE_CODES = {
    BITMAP_BRAND: {"on-us": 1, "off-us": 2, "intraregional": 4, "interregional": 8},
    TEXT_BRAND: {"on-us": 1, "off-us": 2, "intraregional": 3, "interregional": 4},
}
TYPE_CODES = {"PUR": 1, "CSH": 8, "CRD": 1}
# -------------------------------------------------------------------------------


def _lookups(
    rows: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    rates: DataFrame,
    brand: str,
    product: Column,
    currency: Column,
) -> DataFrame:
    """Customer, product program and report rate of every transaction."""
    owner = customers.select(
        F.col("code").alias("_code"),
        F.col("customer_country").alias("_bank_country"),
        F.col("local_currency_code").alias("_local"),
        F.col("report_currency_code").alias("_report"),
        *[F.col(c) for c in customers.columns if c in DUPLICATE_FLAGS.values()],
    )
    program = products.filter(F.col("brand") == PRODUCT_BRANDS[brand]).select(
        F.trim("product_code").alias("_product"), F.col("range_program_id").alias("_program")
    )
    known = rows.join(owner, F.col("app_customer_code") == F.col("_code")).join(
        program, F.trim(product) == F.col("_product"), "left"
    )
    maps = report_rates(rates, customers, brand)
    return maps.onto(known, "_fx", F.col("app_processing_date"), currency.try_cast("int"))


def report_rates(rates: DataFrame, customers: DataFrame, brand: str) -> RateMaps:
    """Rates of a brand from numeric currencies into the customers' report currencies."""
    return RateMaps(
        rates.filter(F.col("brand") == brand), currencies_in(customers, "report_currency_code"), F.col("currency_from_code").try_cast("int")
    )


def _detail(
    rows: DataFrame, values: dict[str, Column], execution: str, month: str, brand: str, mirror: bool | None, own: Column, label: str
) -> DataFrame:
    """Detail rows, each once or, where it is mirrored, from both sides.

    A mirrored row is one that ``own`` holds for: it comes once more as issuing under ``label``. ``mirror`` true mirrors
    those of all customers, null those of customers with the brand's flag.
    """
    zero = F.lit(0.0)
    fixed = {
        "app_type_file": F.col("app_type_file"),
        "app_customer_code": F.col("app_customer_code"),
        "app_execution_id": F.lit(execution),
        "scheme_fee_execution_month": F.lit(month),
        "app_id": F.col("app_id"),
        "app_hash_file": F.col("app_hash_file"),
        "app_processing_date": F.col("app_processing_date"),
        "transaction_count": F.lit(1),
        "transaction_scheme_fee_cost": zero,
        "switch_code": F.lit(""),
        "bank_country": F.col("_bank_country"),
        "size_ticket": F.lit(0),
        "unitary_scheme_fee_cost": zero,
        "estimated_scheme_fee_cost": zero,
        "unitary_estimated_scheme_fee_cost": zero,
        "report_currency": F.col("_report"),
    }
    every = {**fixed, **values}
    if mirror is False:
        return rows.select(*[every[c].alias(c) for c in DETAIL_COLUMNS])
    twice = own if mirror else own & F.coalesce(F.col(DUPLICATE_FLAGS[brand]), F.lit(False))
    sides = F.when(twice, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    both = rows.withColumn("_twin", F.explode(sides))
    every["table_description"] = F.when(F.col("_twin"), F.lit(label)).otherwise(every["table_description"])
    every["business_mode_id"] = F.when(F.col("_twin"), F.lit("issuing")).otherwise(every["business_mode_id"])
    return both.select(*[every[c].alias(c) for c in DETAIL_COLUMNS])


def detail_text(
    txn: DataFrame,
    customers: DataFrame,
    currencies: DataFrame,
    types: DataFrame,
    products: DataFrame,
    rates: DataFrame,
    execution: str,
    month: str,
    mirror_on_us: bool | None = False,
) -> DataFrame:
    """Detail rows of clearing transactions of the text brand, both directions.

    ``mirror_on_us`` adds outgoing on-us transactions once more as issuing; null: those of customers with the flag.
    """
    group = types.select(
        F.col("business_transaction_type_id").cast("int").alias("_type"), F.col("transaction_type_id").alias("_group")
    )
    names = currencies.select(
        F.col("currency_numeric_code").cast("string").alias("_num"), F.col("currency_alphabetic_code").alias("_name")
    )
    chosen = txn.filter(F.col("transaction_code").isin(*CLEARING_CODES) & F.col("app_type_file").isin("IN", "OUT"))
    rows = (
        _lookups(chosen, customers, products, rates, TEXT_BRAND, F.col("product_id"), F.col("source_currency_code"))
        .join(group.filter(F.col("_group").isin(*GROUPS)), F.col("business_transaction_type") == F.col("_type"))
        .join(names, F.col("source_currency_code") == F.col("_num"), "left")
    )
    rate = F.coalesce(F.try_element_at(F.col("_fx"), F.col("_report")), F.lit(1.0))
    local = F.coalesce(
        (F.col("_name") == F.col("_local")) | (F.col("dcc_indicator") != "1") | F.col("dcc_indicator").isNull(),
        F.lit(False),
    )
    return _detail(
        rows,
        {
            "table_description": F.when(F.col("app_type_file") == "IN", LABELS["issuing"]).otherwise(
                LABELS["acquiring"]
            ),
            "account_number": F.col("account_number").cast("string"),
            "card_acceptor_id": F.col("card_acceptor_id"),
            "account_funding_source": cards.funding_class(F.col("funding_source")),
            "account_range_country": F.col("ardef_country"),
            "product_id": F.col("product_id"),
            "range_program_id": F.col("_program"),
            "jurisdiction": F.col("jurisdiction"),
            "business_transaction_type_id": F.col("_group"),
            "reversal_indicator": F.col("reversal_indicator"),
            "currency_local_indicator": F.when(local, 1).otherwise(0),
            "motoec_indicator": cards.remote_flag(F.col("motoec_indicator")),
            "settlement_amount": F.col("settlement_report_amount"),
            "transaction_brand": F.lit(TEXT_BRAND),
            "merchant_country_code": F.col("merchant_country_code"),
            "settlement_currency": F.col("settlement_report_currency_code"),
            "business_mode_id": F.col("business_mode"),
            "transaction_purchase_date": F.col("purchase_date"),
            "exchange_rate": rate,
            "report_amount": rate * F.col("source_amount"),
        },
        execution,
        month,
        TEXT_BRAND,
        mirror_on_us,
        (F.col("app_type_file") == "OUT") & (F.col("jurisdiction") == "on-us"),
        LABELS["text_mirror"],
    )


def detail_online(
    txn: DataFrame,
    customers: DataFrame,
    currencies: DataFrame,
    types: DataFrame,
    products: DataFrame,
    rates: DataFrame,
    execution: str,
    month: str,
    mirror_on_us: bool | None = False,
) -> DataFrame:
    """Detail rows of online transactions (incoming files)."""
    group = types.select(
        F.col("business_transaction_type_id").cast("int").alias("_type"), F.col("transaction_type_id").alias("_group")
    )
    names = currencies.select(
        F.col("currency_numeric_code").cast("string").alias("_num"),
        F.col("currency_alphabetic_code").alias("_settle_name"),
    )
    chosen = txn.filter(F.col("transaction_code_sms").isin(*CLEARING_CODES) & (F.col("app_type_file") == "IN"))
    rows = (
        _lookups(
            chosen, customers, products, rates, TEXT_BRAND, F.col("product_id_sms"), F.col("transaction_currency_code")
        )
        .join(group.filter(F.col("_group").isin(*GROUPS)), F.col("business_transaction_type") == F.col("_type"))
        .join(names, F.col("settlement_currency_code_sms").cast("string") == F.col("_num"), "left")
    )
    rows = report_rates(rates, customers, TEXT_BRAND).onto(
        rows, "_fx2", F.col("app_processing_date"), F.col("cryptogram_currency_code").try_cast("int")
    )
    empty = F.col("transaction_amount") == 0
    rate = F.when(empty, F.try_element_at(F.col("_fx2"), F.col("_report"))).otherwise(F.try_element_at(F.col("_fx"), F.col("_report")))
    rate = F.coalesce(rate, F.lit(1.0))
    amount = F.when(empty, F.col("cryptogram_amount") + F.col("surcharge_amount_sms")).otherwise(
        F.col("transaction_amount")
    )
    dcc = F.col("dcc_indicator_sms")
    local = F.coalesce(
        (F.col("transaction_currency_code") == F.col("_local")) | (dcc != "1") | dcc.isNull(), F.lit(False)
    )
    return _detail(
        rows.withColumn("_side", F.col("issuer_acquirer_indicator")),
        {
            "table_description": F.lit(LABELS["online"]),
            "account_number": F.col("card_number").cast("string"),
            "card_acceptor_id": F.col("card_acceptor_terminal_id"),
            "account_funding_source": cards.funding_class(F.col("record_funding_source")),
            "account_range_country": F.col("pan_extended_country_code").cast("string"),
            "product_id": F.col("product_id_sms"),
            "range_program_id": F.col("_program"),
            "jurisdiction": F.col("jurisdiction"),
            "business_transaction_type_id": F.col("_group"),
            "reversal_indicator": F.col("reversal_indicator"),
            "currency_local_indicator": F.when(local, 1).otherwise(0),
            "motoec_indicator": cards.remote_flag(F.col("mailtelephone_or_electronic_commerce_indicator")),
            "settlement_amount": F.col("settlement_amount"),
            "transaction_brand": F.lit(TEXT_BRAND),
            "merchant_country_code": F.col("card_acceptor_country"),
            "settlement_currency": F.col("_settle_name"),
            "business_mode_id": F.col("business_mode"),
            "transaction_purchase_date": F.col("local_transaction_date"),
            "exchange_rate": rate,
            "report_amount": rate * amount,
        },
        execution,
        month,
        TEXT_BRAND,
        mirror_on_us,
        # the acquirer side of an online record is its business mode
        (F.col("business_mode") == "acquiring") & (F.col("jurisdiction") == "on-us"),
        LABELS["online_mirror"],
    )


def detail_bitmap(
    txn: DataFrame,
    customers: DataFrame,
    currencies: DataFrame,
    types: DataFrame,
    products: DataFrame,
    rates: DataFrame,
    execution: str,
    month: str,
    mirror_on_us: bool | None = False,
) -> DataFrame:
    """Detail rows of bitmap transactions, both directions."""
    group = types.select(
        F.col("business_transaction_type_id").alias("_type"), F.col("transaction_type_id").alias("_group")
    )
    names = currencies.select(
        F.col("currency_numeric_code").cast("int").alias("_num"), F.col("currency_alphabetic_code").alias("_name")
    )
    chosen = txn.filter(F.col("app_message_type").isin("1240", "1442") & F.col("app_type_file").isin("IN", "OUT"))
    rows = (
        _lookups(
            chosen,
            customers,
            products,
            rates,
            BITMAP_BRAND,
            F.col("gcms_product_identifier"),
            F.col("currency_code_transaction"),
        )
        .join(group, F.left("processing_code", F.lit(2)) == F.col("_type"), "left")
        .join(names, F.col("currency_code_transaction") == F.col("_num"), "left")
    )
    rate = F.coalesce(F.try_element_at(F.col("_fx"), F.col("_report")), F.lit(1.0))
    return _detail(
        rows,
        {
            "table_description": F.lit(LABELS["bitmap"]),
            "account_number": F.left(F.col("pan").cast("string"), F.lit(16)),
            "card_acceptor_id": F.col("card_acceptor_id_code").cast("string"),
            "account_funding_source": F.col("funding_source"),
            "account_range_country": F.col("iar_country"),
            "product_id": F.col("gcms_product_identifier"),
            "range_program_id": F.col("_program"),
            "jurisdiction": F.col("jurisdiction"),
            "business_transaction_type_id": F.col("_group"),
            "reversal_indicator": cards.bitmap_reversal_flag(
                F.col("app_message_type"), F.col("message_reversal_indicator")
            ),
            "currency_local_indicator": F.when(F.col("_name") == F.col("_local"), 1).otherwise(0),
            "motoec_indicator": F.when(F.substring("pos_entry_mode", 6, 1) == "0", 0).otherwise(1),
            "settlement_amount": F.col("settlement_report_amount"),
            "transaction_brand": F.lit(BITMAP_BRAND),
            "merchant_country_code": F.col("card_acceptor_country_code"),
            "settlement_currency": F.col("settlement_report_currency_code"),
            "business_mode_id": F.col("business_mode"),
            "transaction_purchase_date": F.to_date("date_and_time_local_transaction"),
            "exchange_rate": rate,
            "report_amount": rate * F.col("amount_transaction"),
        },
        execution,
        month,
        BITMAP_BRAND,
        mirror_on_us,
        (F.col("app_type_file") == "OUT") & (F.col("jurisdiction") == "on-us"),
        LABELS["bitmap_mirror"],
    )


def of_period(txn: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """Transactions of a reporting period (a partition filter on stored tables)."""
    return txn.filter(
        F.col("app_processing_date").between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date"))
    )


def with_switch_codes(detail: DataFrame, ranges: DataFrame) -> DataFrame:
    """Switch code of the account range of the same brand and customer.

    An open range holds its start value only. Of several ranges the smallest code
    wins. Ranges differ per brand and customer: the ranges of each pair are cut into
    disjoint segments, and a row meets at most one of its pair's. The plan does not
    depend on the number of pairs.
    """
    pair = ["_brand", "_customer"]
    closed = ranges.select(
        F.col("brand").alias("_brand"),
        F.col("customer_code").alias("_customer"),
        F.col("start_value").cast("bigint").alias("_low"),
        F.coalesce("end_value", "start_value").cast("bigint").alias("_high"),
        F.col("switch_code").alias("_switch"),
    ).filter("_low <= _high")
    segments = checkpointed(covering_best(checkpointed(closed), pair, "_low", "_high", [F.col("_switch")], ["_switch"]))
    return lookup_segments(
        detail,
        segments,
        F.col("account_number").try_cast("bigint"),
        {"transaction_brand": "_brand", "app_customer_code": "_customer"},
        "_switch",
    ).withColumn("switch_code", F.coalesce("_switch", "switch_code")).drop("_switch")


def with_size_tickets(detail: DataFrame, tickets: DataFrame, rates: DataFrame) -> DataFrame:
    """Ticket size band of the report amount in the band's currency, 0 without a band.

    A brand and bank country uses one ticket currency.
    """
    money = tickets.select(
        F.col("brand").alias("_t_brand"),
        F.col("country_code_list").alias("_t_country"),
        F.col("ticket_currency").alias("_t_currency"),
    ).distinct()
    rows = detail.join(
        money,
        (F.col("transaction_brand") == F.col("_t_brand")) & (F.col("bank_country") == F.col("_t_country")),
        "left",
    )
    maps = RateMaps(rates, currencies_in(tickets, "ticket_currency"), by="brand")
    rows = maps.onto(rows, "_fx", F.col("app_processing_date"), F.col("report_currency"), F.col("transaction_brand"))
    amount = F.col("report_amount") * rate_into("_fx", F.col("report_currency"), F.col("_t_currency"))
    rows = rows.withColumn("_ticket_amount", amount)
    bands = tickets.select(
        "brand", "country_code_list", "ticket_currency", "size_ticket_min", "size_ticket_max", F.col("app_id").alias("_band")
    )
    banded = band_join(
        rows,
        bands,
        F.col("_ticket_amount"),
        "size_ticket_min",
        "size_ticket_max",
        [
            ("transaction_brand", "brand"),
            ("bank_country", "country_code_list"),
            ("_t_currency", "ticket_currency"),
        ],
        ["_band"],
    )
    return banded.withColumn("size_ticket", F.coalesce("_band", F.lit(0))).select(*detail.columns)


def monthly_cube(detail: DataFrame) -> DataFrame:
    """Transaction count and report amount per report key (summed before the shuffle)."""
    return detail.groupBy(*[F.col(d).alias(r) for r, d in CUBE_KEYS.items()]).agg(
        F.sum("transaction_count").alias("transaction_count"),
        F.sum("report_amount").alias("transaction_amount"),
    )


def monthly_report(cube: DataFrame, file_hash: str, first_day: str, start: int = 1) -> DataFrame:
    """Cube rows with ids and zeroed costs.

    Ids follow the report order over all group columns, so they are unambiguous.
    """
    numbered = global_row_number(cube, [F.col(c) for c in ID_ORDER + [k for k in CUBE_KEYS if k not in ID_ORDER]], "app_id", start)
    return numbered.withColumns(
        {
            "app_type_file": F.lit("report"),
            "app_hash_file": F.lit(file_hash),
            "app_processing_date": F.lit(first_day).cast("date"),
            **{c: F.lit(0.0) for c in COSTS},
        }
    )


def legacy_report(report: DataFrame, products: DataFrame, funding: DataFrame, countries: DataFrame) -> DataFrame:
    """Report in the older format: names replaced by numeric codes.

    Products are looked up within their brand, so a code used by both brands does not
    double rows.
    """
    product = products.select(
        F.trim("product_code").alias("_product"), F.col("brand").alias("_p_brand"), "legacy_product_id"
    )
    source = funding.select(
        F.col("bin_funding_source_code").alias("_source"), F.col("bin_funding_source_mc_numeric_code").alias("_source_id")
    )
    alt = countries.select(
        F.col("country_code_alternative").alias("_alt"), F.col("legacy_country_id").alias("_alt_id")
    )
    own = countries.select(F.col("country_code").alias("_own"), F.col("legacy_country_id").alias("_own_id"))
    bitmap = F.col("brand") == BITMAP_BRAND
    text = F.col("brand") == TEXT_BRAND
    rows = (
        report.join(
            product,
            (F.trim("product_id") == F.col("_product"))
            & (F.when(bitmap, PRODUCT_BRANDS[BITMAP_BRAND]).otherwise(PRODUCT_BRANDS[TEXT_BRAND]) == F.col("_p_brand")),
            "left",
        )
        .join(source, F.col("founding_source") == F.col("_source"), "left")
        .join(alt, bitmap & (F.col("merchant_country_code") == F.col("_alt")), "left")
        .join(own, text & (F.col("merchant_country_code") == F.col("_own")), "left")
    )
    scope = F.when(bitmap, cards.lookup(F.col("jurisdiction"), SCOPE_CODES[BITMAP_BRAND])).when(
        text, cards.lookup(F.col("jurisdiction"), SCOPE_CODES[TEXT_BRAND])
    )
    passed = [c for c in ("app_id", "app_execution_id", "customer_code", "report_month") if c in report.columns]

    def cost(name: str) -> Column:
        return F.col(name).cast("double") if name in report.columns else F.lit(0.0)

    return rows.select(
        *passed,
        F.col("customer_code").alias("rpt_bnk_id"),
        F.col("report_month").try_cast("int").alias("set_mth"),
        cards.lookup(F.col("business_mode"), MODE_CODES).alias("bus_id"),
        cards.lookup(F.col("brand"), BRAND_CODES).alias("sch_id"),
        F.col("size_ticket").cast("int").alias("tkt_siz_id"),
        F.col("legacy_product_id").cast("int").alias("prd_id"),
        F.col("range_program_id").try_cast("int").alias("prg_id"),
        F.col("_source_id").cast("int").alias("fnd_src_id"),
        scope.alias("txn_scp_id"),
        cards.lookup(F.col("transaction_type"), TYPE_CODES).alias("txn_typ_id"),
        F.col("reversal_indicator").cast("int").alias("txn_rvsl_flg_id"),
        F.col("currency_local_indicator").cast("int").alias("txn_crncy_lcl_flg_id"),
        F.col("card_present_indicator").cast("int").alias("txn_crd_prs_flg_id"),
        F.left("account_number", F.lit(16)).alias("mct_cd"),
        F.col("switch_code").alias("swt_cd"),
        F.col("transaction_count").cast("bigint").alias("txn_cnt"),
        F.col("transaction_amount").cast("double").alias("txn_amt"),
        cost("transaction_scheme_fee_cost").alias("txn_sfc"),
        F.when(bitmap, F.col("_alt_id")).when(text, F.col("_own_id")).cast("int").alias("mct_ctry_id"),
        cost("unitary_scheme_fee_cost").alias("unt_sfc"),
        cost("estimated_scheme_fee_amount").alias("est_sch_fee_amt"),
        cost("unitary_estimated_scheme_fee_amount").alias("unt_est_sch_fee_amt"),
    )


def apply_returned_costs(report: DataFrame, returned: DataFrame) -> DataFrame:
    """Write the costs of a returned report onto the report rows of the same id."""
    side = returned.select("app_id", *[F.col(c).alias(f"_{c}") for c in RETURNED_COSTS])
    joined = report.join(side, "app_id", "left")
    new = {r: F.coalesce(F.col(f"_{c}"), F.col(r)) for c, r in RETURNED_COSTS.items()}
    return joined.select(*[new.get(c, F.col(c)).alias(c) for c in report.columns])


def push_back_costs(detail: DataFrame, report: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Write report costs onto every detail row of their group.

    One join over the month on all group columns (empty text matches null). A group
    may hold a large part of the month, so hot groups take the broadcast route of
    the lookup.
    """
    def key(c: Column) -> Column:
        return F.coalesce(c.cast("string"), F.lit(""))

    marked = detail.withColumns({f"_g{i}": key(F.col(d)) for i, d in enumerate(CUBE_KEYS.values())})
    costs = report.select(
        *[key(F.col(r)).alias(f"_g{i}") for i, r in enumerate(CUBE_KEYS)],
        *[F.col(r).alias(f"_cost_{d}") for r, d in COSTS.items()],
    )
    joined = lookup_join(
        marked,
        costs,
        {f"_g{i}": f"_g{i}" for i in range(len(CUBE_KEYS))},
        [f"_cost_{d}" for d in COSTS.values()],
        hot_rows,
    )
    new = {d: F.coalesce(F.col(f"_cost_{d}"), F.col(d)) for d in COSTS.values()}
    return joined.select(*[new.get(c, F.col(c)).alias(c) for c in detail.columns])


def count_check(detail: DataFrame, report: DataFrame) -> DataFrame:
    """One row: detail rows, report rows, counted transactions and whether they agree."""
    none = F.lit(None).cast("bigint")
    rows = detail.agg(
        F.count(F.lit(1)).alias("detail_rows"), F.max(none).alias("report_rows"), F.max(none).alias("report_transactions")
    )
    groups = report.agg(
        F.max(none).alias("detail_rows"),
        F.count(F.lit(1)).alias("report_rows"),
        F.sum("transaction_count").cast("bigint").alias("report_transactions"),
    )
    both = rows.unionByName(groups).agg(*[F.max(c).alias(c) for c in rows.columns])
    return both.withColumn("consistent", F.col("detail_rows") == F.col("report_transactions"))


def summary_row(
    detail: DataFrame, report: DataFrame, execution: str, month: str, customer: str, route: str
) -> DataFrame:
    """One summary row of an execution, ready to append."""
    counts = count_check(detail, report)
    return counts.select(
        F.lit(execution).alias("app_execution_id"),
        F.lit(month).alias("report_month"),
        F.lit(customer).alias("report_client_code"),
        F.col("detail_rows").alias("number_of_inserted_rows"),
        F.col("report_rows").alias("number_of_groups"),
        F.lit(0).cast("bigint").alias("number_of_updated_rows"),
        F.lit(route).alias("route"),
    )


def detail_of_all(frames: Sequence[DataFrame]) -> DataFrame:
    """All extracts of a period in one table."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
