"""Account ranges, jurisdiction, calculated fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearspan.catalogue.inputs import Source, oracle
from clearspan.catalogue.oracles import ON_DATE, ORACLE_INPUTS
from clearspan.operators.ranges import band_join, best_range, range_join
from clearspan.operators.skew import latest_by
from clearspan.plans.calculated import (
    bitmap_calculated_fields,
    online_calculated_fields,
    text_calculated_fields,
    text_ranges,
)


def calculated_text(s: Source) -> DataFrame:
    return text_calculated_fields(s.txn_text, s.ardef, s.countries, s.customers, s.currencies, s.rates, ON_DATE)


def calculated_online(s: Source) -> DataFrame:
    return online_calculated_fields(
        s.txn_online, s.ardef, s.countries, s.customers, s.currencies, s.text_types, ON_DATE
    )


def calculated_bitmap(s: Source) -> DataFrame:
    return bitmap_calculated_fields(
        s.elements, s.iar, s.bitmap_products, s.countries, s.customers, s.currencies, s.rates, ON_DATE
    )


def money(name: str, places: int = 8):
    return F.round(F.col(name), places).alias(name)


def bin_range_unique(spark: SparkSession, sf: str) -> DataFrame:
    s = Source(spark, sf)
    return text_ranges(s.ardef, ON_DATE).select(
        "low_key", "high_key", "app_date_valid", "delete_indicator", "ardef_country", "issuer_country", "product_id"
    )


def bin_range_enrich(spark: SparkSession, sf: str) -> DataFrame:
    s = Source(spark, sf)
    order = [-F.unix_date("app_date_valid"), -F.col("high_key"), -F.col("low_key")]
    return best_range(
        s.txn_text.select("app_id", "app_hash_file", "account_number"),
        text_ranges(s.ardef, ON_DATE),
        F.col("account_number"),
        "low_key",
        "high_key",
        order,
        ["ardef_country", "product_id", "account_funding_source"],
    )


def range_join_all(spark: SparkSession, sf: str) -> DataFrame:
    s = Source(spark, sf)
    pairs = range_join(
        s.txn_text.select("app_id", "app_hash_file", "account_number"),
        text_ranges(s.ardef, ON_DATE).select("low_key", "high_key", "ardef_country"),
        F.col("account_number"),
        "low_key",
        "high_key",
    )
    return pairs.select("app_id", "app_hash_file", "low_key", "high_key", "ardef_country")


def size_band(spark: SparkSession, sf: str) -> DataFrame:
    s = Source(spark, sf)
    rows = s.txn_text.select(
        "app_id", "app_hash_file", F.lit("VISA").alias("brand_name"), "app_customer_code", "source_amount"
    ).join(s.customers.select(F.col("code").alias("app_customer_code"), "customer_country"), "app_customer_code")
    side = s.tickets.withColumnRenamed("app_id", "band")
    out = band_join(
        rows,
        side,
        F.col("source_amount"),
        "size_ticket_min",
        "size_ticket_max",
        [("brand_name", "brand"), ("customer_country", "country_code_list")],
        ["band"],
    )
    return out.select("app_id", "app_hash_file", F.coalesce("band", F.lit(0)).alias("size_ticket"))


def jurisdiction_classify(spark: SparkSession, sf: str) -> DataFrame:
    return (
        calculated_text(Source(spark, sf))
        .groupBy("app_customer_code", "app_type_file", "business_mode", "jurisdiction", "jurisdiction_assigned")
        .agg(F.count(F.lit(1)).alias("transactions"))
    )


def calculated_fields_text(spark: SparkSession, sf: str) -> DataFrame:
    return calculated_text(Source(spark, sf)).select(
        "app_id",
        "app_hash_file",
        "authorization_code_valid",
        "business_mode",
        "jurisdiction",
        "jurisdiction_country",
        "jurisdiction_region",
        "jurisdiction_assigned",
        "timeless",
        "funding_source",
        "product_id",
        "ardef_country",
        "issuer_country",
        "reversal_indicator",
        "business_transaction_type",
        "business_transaction_cycle",
        "technology_indicator",
        "fast_funds",
        "travel_indicator",
        "b2b_program_id",
        "nnss_indicator",
        "product_subtype",
        money("settlement_report_amount"),
        "settlement_report_currency_code",
    )


def calculated_fields_online(spark: SparkSession, sf: str) -> DataFrame:
    return calculated_online(Source(spark, sf)).select(
        "app_id",
        "app_hash_file",
        "authorization_code_valid",
        "business_mode",
        "jurisdiction",
        "jurisdiction_assigned",
        "timeless",
        "funding_source",
        "product_id",
        "ardef_country",
        "reversal_indicator",
        "business_transaction_type",
        "transaction_code_sms",
        money("settlement_report_amount"),
        "settlement_report_currency_code",
    )


def calculated_fields_bitmap(spark: SparkSession, sf: str) -> DataFrame:
    return calculated_bitmap(Source(spark, sf)).select(
        "app_id",
        "app_hash_file",
        "pan",
        "business_mode",
        "jurisdiction",
        "jurisdiction_country",
        "jurisdiction_region",
        "jurisdiction_assigned",
        "funding_source",
        "gcms_product_identifier",
        "card_program_identifier",
        "iar_country",
        "mc_file_id",
        money("settlement_report_amount"),
        "settlement_report_currency_code",
    )


def latest_wins(spark: SparkSession, sf: str) -> DataFrame:
    orders = Source(spark, sf).orders
    newest = latest_by(
        orders.select("o_custkey", "o_orderkey", "o_orderstatus", F.to_date("o_orderdate").alias("day")),
        ["o_custkey"],
        [-F.unix_date("day"), -F.col("o_orderkey")],
    )
    return newest.select("o_custkey", "o_orderkey", "o_orderstatus")


QUERIES = {
    "bin_range_unique": bin_range_unique,
    "bin_range_enrich": bin_range_enrich,
    "range_join_all": range_join_all,
    "size_band": size_band,
    "jurisdiction_classify": jurisdiction_classify,
    "calculated_fields_text": calculated_fields_text,
    "calculated_fields_online": calculated_fields_online,
    "calculated_fields_bitmap": calculated_fields_bitmap,
    "latest_wins": latest_wins,
}

_SQL = {
    "bin_range_unique": """
SELECT CAST(lo AS BIGINT) AS low_key, CAST(hi AS BIGINT) AS high_key, app_date_valid, delete_indicator,
       ardef_country, issuer_country, product_id FROM {o_ranges} r""",
    "bin_range_enrich": """
SELECT app_id, app_hash_file, account_number, ardef_country, product_id, account_funding_source FROM {o_matched} m""",
    "range_join_all": """
SELECT t.app_id, t.app_hash_file, CAST(r.lo AS BIGINT) AS low_key, CAST(r.hi AS BIGINT) AS high_key, r.ardef_country
FROM {txn_text} t JOIN {o_ranges} r ON t.account_number BETWEEN r.lo AND r.hi""",
    "size_band": """
SELECT t.app_id, t.app_hash_file, coalesce(b.app_id, 0) AS size_ticket
FROM {txn_text} t JOIN {customers} c ON c.code = t.app_customer_code
LEFT JOIN {tickets} b ON b.brand = 'VISA' AND b.country_code_list = c.customer_country
  AND t.source_amount >= b.size_ticket_min AND t.source_amount < b.size_ticket_max""",
    "jurisdiction_classify": """
SELECT app_customer_code, app_type_file, business_mode, jurisdiction, jurisdiction_assigned, count(*) AS transactions
FROM {o_calculated} c GROUP BY ALL""",
    "calculated_fields_text": """
SELECT app_id, app_hash_file, authorization_code_valid, business_mode, jurisdiction, jurisdiction_country,
       jurisdiction_region, jurisdiction_assigned, timeless, funding_source, product_id, ardef_country, issuer_country,
       reversal_indicator, business_transaction_type, business_transaction_cycle, technology_indicator, fast_funds,
       travel_indicator, b2b_program_id, nnss_indicator, product_subtype,
       round(settlement_report_amount, 8) AS settlement_report_amount, settlement_report_currency_code
FROM {o_calculated} c""",
    "calculated_fields_online": """
SELECT app_id, app_hash_file, authorization_code_valid, business_mode, jurisdiction, jurisdiction_assigned, timeless,
       funding_source, product_id, ardef_country, reversal_indicator, business_transaction_type, transaction_code_sms,
       round(settlement_amount, 8) AS settlement_report_amount, settlement_report_currency_code
FROM {o_online} c""",
    "calculated_fields_bitmap": """
SELECT app_id, app_hash_file, pan, business_mode, jurisdiction, jurisdiction_country, jurisdiction_region,
       jurisdiction_assigned, funding_source, gcms_product_identifier, card_program_identifier, iar_country, mc_file_id,
       round(settlement_report_amount, 8) AS settlement_report_amount, settlement_report_currency_code
FROM {o_bitmap} c""",
    "latest_wins": """
SELECT o_custkey, o_orderkey, o_orderstatus FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) AS n
  FROM orders) q WHERE n = 1""",
}
ORACLE = {k: oracle(v, ORACLE_INPUTS) for k, v in _SQL.items()}
