"""Rule assignment, fees and exchange rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearspan.catalogue.enrichment import calculated_bitmap, calculated_online, calculated_text, money
from clearspan.catalogue.inputs import Source, oracle
from clearspan.catalogue.oracles import ORACLE_INPUTS
from clearspan.operators.fees import clamped_fee
from clearspan.operators.fx import attach_rate, brand_rates, convert_to_each
from clearspan.operators.rules import RULES_PER_PASS, RuleBook, assign_first_rule
from clearspan.plans.interchange import bitmap_interchange, online_interchange, text_interchange
from clearspan.sources.rates import currency_pairs, new_rates

FEES = ["rule_id", "region_country_code", "fee_currency"]


def interchange_text(s: Source, per_pass: int = RULES_PER_PASS) -> DataFrame:
    return text_interchange(calculated_text(s), s.rules_text, s.countries, s.currencies, s.rates, per_pass=per_pass)


def interchange_online(s: Source) -> DataFrame:
    return online_interchange(calculated_online(s), s.rules_text, s.countries, s.currencies, s.rates)


def interchange_bitmap(s: Source) -> DataFrame:
    return bitmap_interchange(calculated_bitmap(s), s.rules_bitmap, s.currencies, s.rates)


def interchange_fee(spark: SparkSession, sf: str) -> DataFrame:
    return interchange_text(Source(spark, sf)).select(
        "app_id", "app_hash_file", "jurisdiction", "jurisdiction_assigned", *FEES, money("calculated_value")
    )


def interchange_fee_joined(spark: SparkSession, sf: str) -> DataFrame:
    """The same with scopes of more rules than one pass holds."""
    return interchange_text(Source(spark, sf), 4).select(
        "app_id", "app_hash_file", "jurisdiction", "jurisdiction_assigned", *FEES, money("calculated_value")
    )


def interchange_fee_online(spark: SparkSession, sf: str) -> DataFrame:
    return interchange_online(Source(spark, sf)).select(
        "app_id", "app_hash_file", *FEES, money("amount_transaction"), money("calculated_value")
    )


def interchange_fee_bitmap(spark: SparkSession, sf: str) -> DataFrame:
    return interchange_bitmap(Source(spark, sf)).select(
        "app_id", "app_hash_file", "pan", "rule_id", "region_country_code", "ird", "rate_currency",
        money("calculated_value"),
    )


def _one_rule(spark: SparkSession, sf: str, kind: str, rules: list[tuple[str, str | None]], words) -> DataFrame:
    """First-match assignment over one condition column of every line item."""
    s = Source(spark, sf)
    table = spark.createDataFrame([("all", r, t) for r, t in rules], "scope string, rule_id string, attr string")
    rows = s.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", words.alias("attr")).withColumn(
        "scope_key", F.lit("all")
    )
    book = RuleBook(scope={"scope_key": "scope"}, kinds={"attr": kind})
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return assign_first_rule(rows, table, book, ["rule_id"]).select(*key, "rule_id")


def rule_first_match_eq(spark: SparkSession, sf: str) -> DataFrame:
    word = F.when(F.col("l_linenumber") == 7, F.lit(None)).otherwise(F.concat(F.lit(" "), "l_returnflag"))
    return _one_rule(spark, sf, "member", [("1", "a, X"), ("2", "BLANK"), ("3", "N")], word)


def rule_first_match_not(spark: SparkSession, sf: str) -> DataFrame:
    word = F.when(F.col("l_linenumber") == 7, F.lit("  ")).otherwise(F.col("l_returnflag"))
    return _one_rule(spark, sf, "member", [("1", "NOT:A,BLANK,N"), ("2", "NOT:A"), ("3", None)], word)


def rule_first_match_range(spark: SparkSession, sf: str) -> DataFrame:
    return _one_rule(
        spark, sf, "range", [("1", "0-9,150"), ("2", "NOT:10-1500"), ("3", "77"), ("10", "NOT:78")],
        F.col("l_partkey").cast("string"),
    )


def rule_first_match_cmp(spark: SparkSession, sf: str) -> DataFrame:
    word = F.when(F.col("l_linenumber") == 7, F.lit(None)).otherwise(F.col("l_quantity").cast("string"))
    return _one_rule(
        spark, sf, "compare", [("1", "BETWEEN 0 AND 10"), ("2", ">=45"), ("3", "<20"), ("4", "=30"), ("5", "31")], word
    )


def rule_first_match_space(spark: SparkSession, sf: str) -> DataFrame:
    word = F.substring(F.lit(" 159"), F.col("l_linenumber") % 4 + 1, 1)
    return _one_rule(spark, sf, "space", [("1", "NOT:Space,1,5"), ("2", "Space, 1"), ("3", "5")], word)


def rule_first_match_amount(spark: SparkSession, sf: str) -> DataFrame:
    s = Source(spark, sf)
    rows = s.txn_text.select(
        "app_id", "app_hash_file", "source_amount", "purchase_date", "source_currency_code", F.lit("all").alias("scope_key")
    ).join(
        s.currencies.select(
            F.col("currency_numeric_code").cast("string").alias("source_currency_code"), "currency_alphabetic_code"
        ),
        "source_currency_code",
    )
    rows = convert_to_each(
        rows, brand_rates(s.rates, "VISA"), F.col("source_amount"), F.col("currency_alphabetic_code"),
        F.col("purchase_date"), ["GBP", "USD"], "amount",
    )
    table = spark.createDataFrame(
        [("all", "1", ">0,<30000", "USD"), ("2", "2", "1", "USD"), ("all", "3", "BETWEEN 20000 AND 70000", "GBP"),
         ("all", "4", ">=100000", "USD")],
        "scope string, rule_id string, amount string, ccy string",
    )
    book = RuleBook(scope={"scope_key": "scope"}, kinds={"amount": "amount"}, amount_currency="ccy")
    return assign_first_rule(rows, table, book, ["rule_id"]).select(
        "app_id", "app_hash_file", "rule_id"
    )


def fee_clamp(spark: SparkSession, sf: str) -> DataFrame:
    s = Source(spark, sf)
    none = F.lit(None).cast("double")
    variable = F.when(F.col("l_linenumber") == 1, none).otherwise(F.lit(0.015))
    low = F.when(F.col("l_linenumber") == 2, none).otherwise(F.lit(300.0))
    high = F.when(F.col("l_linenumber") == 3, none).otherwise(F.lit(900.0))
    fixed = F.when(F.col("l_linenumber") == 4, none).otherwise(F.lit(2.5))
    fee = clamped_fee(F.col("l_extendedprice"), F.lit(1.2), variable, fixed, low, high)
    return s.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(fee, 8).alias("fee"))


def fx_convert(spark: SparkSession, sf: str) -> DataFrame:
    s = Source(spark, sf)
    rows = attach_rate(
        s.txn_text.select("app_id", "app_hash_file", "source_amount", "source_currency_code", "app_processing_date"),
        brand_rates(s.rates, "visa"),
        "rate",
        F.col("app_processing_date"),
        F.col("source_currency_code"),
        F.lit("EUR"),
        from_field="currency_from_code",
        same=F.col("source_currency_code") == "978",
    )
    return rows.select(
        "app_id", "app_hash_file", "rate", F.round(F.col("source_amount") * F.col("rate"), 8).alias("amount_eur")
    )


def fx_pivot_amounts(spark: SparkSession, sf: str) -> DataFrame:
    s = Source(spark, sf)
    rows = s.txn_text.select(
        "app_id", "app_hash_file", "source_amount", "purchase_date",
        F.element_at(
            F.create_map(*[F.lit(x) for p in (("840", "USD"), ("978", "EUR"), ("826", "GBP"), ("392", "JPY"), ("36", "AUD")) for x in p]),
            F.col("source_currency_code"),
        ).alias("ccy"),
    )
    out = convert_to_each(
        rows, brand_rates(s.rates, "VISA"), F.col("source_amount"), F.col("ccy"), F.col("purchase_date"),
        ["AUD", "JPY", "USD"], "amount",
    )
    return out.select("app_id", "app_hash_file", "ccy", money("amount_aud"), money("amount_jpy"), money("amount_usd"))


def daily_currency_pairs(spark: SparkSession, sf: str) -> DataFrame:
    s = Source(spark, sf)
    return currency_pairs(s.rate_days, s.currencies, "app_processing_date", "currency_alphabetic_code")


def rates_load(spark: SparkSession, sf: str) -> DataFrame:
    s = Source(spark, sf)
    sheet = s.rates.select("date", "brand", "currency_from", "currency_to", "exchange_value")
    stored = s.rates.filter(F.day("date") <= 20)
    return new_rates(sheet, stored, s.currencies).select(
        "date", "app_processing_date", "app_type_file", "brand", "currency_from", "currency_to", "currency_from_code",
        "currency_to_code", "exchange_value",
    )


QUERIES = {
    "interchange_fee": interchange_fee,
    "interchange_fee_joined": interchange_fee_joined,
    "interchange_fee_online": interchange_fee_online,
    "interchange_fee_bitmap": interchange_fee_bitmap,
    "rule_first_match_eq": rule_first_match_eq,
    "rule_first_match_not": rule_first_match_not,
    "rule_first_match_range": rule_first_match_range,
    "rule_first_match_cmp": rule_first_match_cmp,
    "rule_first_match_space": rule_first_match_space,
    "rule_first_match_amount": rule_first_match_amount,
    "fee_clamp": fee_clamp,
    "fx_convert": fx_convert,
    "fx_pivot_amounts": fx_pivot_amounts,
    "currency_pairs": daily_currency_pairs,
    "rates_load": rates_load,
}

_KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
_FEE_SQL = """
SELECT app_id, app_hash_file, jurisdiction, jurisdiction_assigned, rule_id, region_country_code, fee_currency,
       round(calculated_value, 8) AS calculated_value FROM {o_fee} f"""
_SQL = {
    "interchange_fee": _FEE_SQL,
    "interchange_fee_joined": _FEE_SQL,
    "interchange_fee_online": """
SELECT app_id, app_hash_file, rule_id, region_country_code, fee_currency, round(fee_base, 8) AS amount_transaction,
       round(calculated_value, 8) AS calculated_value FROM {o_online_fee} f""",
    "interchange_fee_bitmap": """
SELECT app_id, app_hash_file, pan, rule_id, region_country_code, ird, rate_currency,
       round(calculated_value, 8) AS calculated_value FROM {o_bitmap_fee} f""",
    "rule_first_match_eq": f"""
SELECT {_KEY}, CASE WHEN l_linenumber = 7 THEN '2' WHEN l_returnflag = 'A' THEN '1' WHEN l_returnflag = 'N' THEN '3' END
  AS rule_id FROM lineitem""",
    "rule_first_match_not": f"""
SELECT {_KEY}, CASE WHEN l_linenumber = 7 THEN '2' WHEN l_returnflag NOT IN ('A', 'N') THEN '1'
  WHEN l_returnflag <> 'A' THEN '2' ELSE '3' END AS rule_id FROM lineitem""",
    "rule_first_match_range": f"""
SELECT {_KEY}, CASE WHEN l_partkey BETWEEN 0 AND 9 OR l_partkey = 150 THEN '1'
  WHEN l_partkey NOT BETWEEN 10 AND 1500 THEN '2' WHEN l_partkey = 77 THEN '3' WHEN l_partkey <> 78 THEN '10' END AS rule_id
FROM lineitem""",
    "rule_first_match_cmp": f"""
SELECT {_KEY}, CASE WHEN l_linenumber = 7 THEN NULL WHEN l_quantity BETWEEN 0 AND 10 THEN '1' WHEN l_quantity >= 45 THEN '2'
  WHEN l_quantity < 20 THEN '3' WHEN l_quantity = 30 THEN '4' WHEN l_quantity = 31 THEN '5' END AS rule_id FROM lineitem""",
    "rule_first_match_space": f"""
SELECT {_KEY}, CASE l_linenumber % 4 WHEN 3 THEN '1' WHEN 0 THEN '2' WHEN 1 THEN '2' ELSE '3' END AS rule_id FROM lineitem""",
    "rule_first_match_amount": """
SELECT app_id, app_hash_file, CASE WHEN u > 0 AND u < 30000 THEN '1' WHEN g BETWEEN 20000 AND 70000 THEN '3'
  WHEN u >= 100000 THEN '4' END AS rule_id
FROM (SELECT t.app_id, t.app_hash_file,
        source_amount * CASE WHEN c.currency_alphabetic_code = 'USD' THEN 1e0 ELSE xu.exchange_value END AS u,
        source_amount * CASE WHEN c.currency_alphabetic_code = 'GBP' THEN 1e0 ELSE xg.exchange_value END AS g
      FROM {txn_text} t JOIN {currencies} c ON CAST(c.currency_numeric_code AS VARCHAR) = t.source_currency_code
      LEFT JOIN {rates} xu ON xu.app_processing_date = t.purchase_date AND xu.brand = 'VISA'
        AND xu.currency_from = c.currency_alphabetic_code AND xu.currency_to = 'USD'
      LEFT JOIN {rates} xg ON xg.app_processing_date = t.purchase_date AND xg.brand = 'VISA'
        AND xg.currency_from = c.currency_alphabetic_code AND xg.currency_to = 'GBP') q""",
    "fee_clamp": f"""
SELECT {_KEY}, round(CASE WHEN l_linenumber = 1 THEN 2.5e0 WHEN l_linenumber <> 2 AND raw <= 300 THEN 300e0
  WHEN l_linenumber <> 3 AND raw >= 900 THEN 900e0 ELSE raw END, 8) AS fee
FROM (SELECT *, 0.015e0 * (l_extendedprice * 1.2e0) + CASE WHEN l_linenumber = 4 THEN 0e0 ELSE 2.5e0 END AS raw FROM lineitem) q""",
    "fx_convert": """
SELECT app_id, app_hash_file, rate, round(source_amount * rate, 8) AS amount_eur FROM (
  SELECT t.*, CASE WHEN t.source_currency_code = '978' THEN 1e0 ELSE x.exchange_value END AS rate
  FROM {txn_text} t LEFT JOIN {rates} x ON x.app_processing_date = t.app_processing_date AND x.brand = 'VISA'
    AND x.currency_from_code = t.source_currency_code AND x.currency_to = 'EUR') q""",
    "fx_pivot_amounts": """
SELECT app_id, app_hash_file, ccy, round(source_amount * CASE WHEN ccy = 'AUD' THEN 1e0 ELSE a END, 8) AS amount_aud,
  round(source_amount * CASE WHEN ccy = 'JPY' THEN 1e0 ELSE j END, 8) AS amount_jpy,
  round(source_amount * CASE WHEN ccy = 'USD' THEN 1e0 ELSE u END, 8) AS amount_usd
FROM (SELECT t.*, c.currency_alphabetic_code AS ccy, xa.exchange_value AS a, xj.exchange_value AS j, xu.exchange_value AS u
  FROM {txn_text} t JOIN {currencies} c ON CAST(c.currency_numeric_code AS VARCHAR) = t.source_currency_code
  LEFT JOIN {rates} xa ON xa.app_processing_date = t.purchase_date AND xa.brand = 'VISA'
    AND xa.currency_from = c.currency_alphabetic_code AND xa.currency_to = 'AUD'
  LEFT JOIN {rates} xj ON xj.app_processing_date = t.purchase_date AND xj.brand = 'VISA'
    AND xj.currency_from = c.currency_alphabetic_code AND xj.currency_to = 'JPY'
  LEFT JOIN {rates} xu ON xu.app_processing_date = t.purchase_date AND xu.brand = 'VISA'
    AND xu.currency_from = c.currency_alphabetic_code AND xu.currency_to = 'USD') q""",
    "currency_pairs": """
SELECT DISTINCT app_processing_date, currency_from, currency_to FROM {rates} r""",
    "rates_load": """
SELECT date, app_processing_date, 'EXCHANGE_RATE' AS app_type_file, brand, currency_from, currency_to,
       CAST(currency_from_code AS INT) AS currency_from_code, CAST(currency_to_code AS INT) AS currency_to_code, exchange_value
FROM {rates} r WHERE day(date) > 20""",
}
ORACLE = {k: oracle(v, ORACLE_INPUTS) for k, v in _SQL.items()}
