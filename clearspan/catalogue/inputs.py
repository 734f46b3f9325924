"""Card-domain tables derived from the driver's tables.

Each input is one SQL text that Spark and the oracle database both understand;
``{name}`` stands for a driver table or for another input. All of them read the whole
driver tables, so they grow with the data. Small literal lists (currencies,
customers, rule templates) play the part of master tables.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearspan.session import checkpointed, ensure_checkpoint_dir, steps_for, written
from clearspan.sources.rates import currency_pairs

TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]

#: Fact tables with heavy work on their rows, and the column they are spread by.
FACTS = {"orders": "o_orderkey", "lineitem": "l_orderkey"}
#: Rows of a fact table that one task works on, so that tasks grow in number with the table and not in length.
TASK_ROWS = 500_000

CURRENCIES = """
SELECT * FROM (VALUES (840, 'USD', 2), (978, 'EUR', 2), (826, 'GBP', 2), (392, 'JPY', 0), (36, 'AUD', 2))
  AS t(currency_numeric_code, currency_alphabetic_code, currency_decimal_separator)
"""

CUSTOMERS = """
SELECT * FROM (VALUES
  ('AUTOMOBILE', 'AX', 'USD', 'USD', 'USD', '450001,450002', '400000,400003', '40000150', true, true),
  ('BUILDING',   'BX', 'EUR', 'USD', 'EUR', '450003',        '400001',        '40000010', true, false),
  ('FURNITURE',  'CX', 'GBP', 'EUR', 'USD', '450004,450005', '400000',        '40000160', false, true),
  ('HOUSEHOLD',  'DX', 'JPY', 'USD', 'USD', '450006',        '400002',        '40000005', false, false),
  ('MACHINERY',  'EX', 'AUD', 'GBP', 'AUD', '450007,450008', '400001,400009', '40000077', true, true))
  AS t(code, customer_country, local_currency_code, settlement_currency_code, report_currency_code,
       acquiring_bins, issuing_bins_6_digits, issuing_bins_8_digits,
       duplicate_on_us_flag_visa, duplicate_on_us_flag_mastercard)
"""

COUNTRIES = """
SELECT substr('ABCDEFGHIJKLMNOPQRSTUVWXY', n_nationkey + 1, 1) || 'X' AS country_code,
       substr('ABCDEFGHIJKLMNOPQRSTUVWXY', n_nationkey + 1, 1) || 'XY' AS country_code_alternative,
       100 + n_nationkey AS country_numeric,
       CAST(n_regionkey + 1 AS STRING) AS visa_region_code,
       substr('VWXYZ', n_regionkey + 1, 1) AS mastercard_region_code,
       1000 + n_nationkey AS legacy_country_id
FROM {nation}
"""

#: Account ranges of the text brand: twenty prefixes per supplier, some wider, some older.
ARDEF = """
SELECT CAST(400000000 + 20 * s_suppkey AS STRING) || '000' AS low_key_for_range,
       CAST(400000000 + 20 * s_suppkey + width AS STRING) || '999' AS table_key,
       DATE '1990-01-01' + CAST(s_suppkey * 37 % 700 + shift AS INT) AS app_date_valid,
       CASE s_suppkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'D' ELSE ' ' END AS delete_indicator,
       substr('ABCDEFGHIJKLMNOPQRSTUVWXY', CAST((s_nationkey + turn) % 25 AS INT) + 1, 1) || 'X' AS ardef_country,
       substr('ABCDEFGHIJKLMNOPQRSTUVWXY', CAST((s_nationkey + turn + 1) % 25 AS INT) + 1, 1) || 'X' AS country,
       substr('CDHPR', CAST(s_suppkey % 5 AS INT) + 1, 1) AS account_funding_source,
       substr('ABCDEFGH', CAST(s_suppkey % 8 AS INT) + 1, 1) AS product_id,
       CASE WHEN s_suppkey % 6 = 0 THEN 'T' ELSE ' ' END AS technology_indicator,
       CASE WHEN s_suppkey % 7 = 0 THEN 'Y' ELSE 'N' END AS fast_funds,
       CASE WHEN s_suppkey % 9 = 0 THEN 'Y' ELSE 'N' END AS travel_indicator,
       'B' || CAST(s_suppkey % 3 AS STRING) AS b2b_program_id,
       CASE WHEN s_suppkey % 11 = 0 THEN 'Y' ELSE ' ' END AS nnss_indicator,
       'S' || CAST(s_suppkey % 4 AS STRING) AS product_subtype
FROM (
  SELECT s_suppkey, s_nationkey, 19 AS width, 0 AS shift, 0 AS turn FROM {supplier}
  UNION ALL
  SELECT s_suppkey, s_nationkey, 79 AS width, 400 AS shift, 3 AS turn FROM {supplier} WHERE s_suppkey % 3 = 0
  UNION ALL
  SELECT s_suppkey, s_nationkey, 9 AS width, 900 AS shift, 7 AS turn FROM {supplier} WHERE s_suppkey % 5 = 1
) r
"""

#: Clearing transactions of the text brand, one per line item.
TXN_TEXT = """
SELECT l.l_orderkey * 10 + l.l_linenumber AS app_id,
       'H' || CAST(l.l_partkey AS STRING) || '-' || CAST(l.l_suppkey AS STRING) AS app_hash_file,
       c.c_mktsegment AS app_customer_code,
       CASE WHEN l.l_linestatus = 'O' THEN 'OUT' ELSE 'IN' END AS app_type_file,
       CAST(o.o_orderdate AS DATE) AS app_processing_date,
       4000000000000000 + l.l_partkey * 10000000 + l.l_orderkey % 10000000 AS account_number,
       CASE l.l_orderkey % 8 WHEN 0 THEN '05' WHEN 1 THEN '06' WHEN 2 THEN '07' WHEN 3 THEN '15'
            WHEN 4 THEN '25' WHEN 5 THEN '26' WHEN 6 THEN '37' ELSE '05' END AS transaction_code,
       CASE l.l_suppkey % 7 WHEN 0 THEN 4829 WHEN 1 THEN 6051 WHEN 2 THEN 6010 WHEN 3 THEN 6011
            WHEN 4 THEN 5411 WHEN 5 THEN 5812 ELSE 4511 END AS merchant_category_code,
       CASE WHEN l.l_linenumber = 5 THEN 2 WHEN l.l_linenumber = 7 THEN 9 ELSE 1 END AS usage_code,
       CAST(l.l_orderkey % 3 AS INT) AS transaction_code_qualifier_0,
       substr('78 1', CAST(l.l_partkey % 4 AS INT) + 1, 1)
         AS special_condition_indicator_merchant_transaction_indicator,
       CASE l.l_orderkey % 11 WHEN 0 THEN '00000' WHEN 1 THEN 'A1234x' WHEN 2 THEN '     '
            WHEN 3 THEN '0000n' ELSE '123456' END AS authorization_code,
       CASE WHEN l.l_orderkey % 50 = 0 THEN 'C' ELSE ' ' END AS collection_only_flag,
       substr('ABCDEFGHIJKLMNOPQRSTUVWXY',
              CAST(CASE WHEN l.l_orderkey % 3 = 0 THEN i.s_nationkey ELSE s.s_nationkey END AS INT) + 1, 1)
         || 'X' AS merchant_country_code,
       l.l_extendedprice AS source_amount,
       CASE l.l_suppkey % 5 WHEN 0 THEN '840' WHEN 1 THEN '978' WHEN 2 THEN '826' WHEN 3 THEN '392'
            ELSE '36' END AS source_currency_code,
       CAST(l.l_shipdate AS DATE) AS purchase_date,
       CAST(l.l_shipdate AS DATE) + CAST(l.l_orderkey % 15 AS INT) AS central_processing_date,
       l.l_linenumber % 3 AS settlement_flag,
       450000 + l.l_suppkey % 10 AS account_reference_number_acquiring_identifier,
       substr(' 159', CAST(l.l_orderkey % 4 AS INT) + 1, 1) AS motoec_indicator,
       CASE WHEN l.l_orderkey % 6 = 0 THEN '1' WHEN l.l_orderkey % 6 = 1 THEN NULL ELSE ' ' END AS dcc_indicator,
       ' merchant ' || CAST(l.l_suppkey AS STRING) || ' ' AS merchant_name,
       'id' || CAST(l.l_suppkey % 50 AS STRING) AS card_acceptor_id,
       't' || CAST(l.l_linenumber AS STRING) AS terminal_id,
       CASE WHEN l.l_partkey % 9 = 0 THEN 'SP' ELSE ' ' END AS business_format_code_sp,
       l.l_tax * 100 AS surcharge_amount_sp,
       substr('ABC', CAST(l.l_partkey % 3 AS INT) + 1, 1) AS reimbursement_attribute,
       l.l_partkey AS part_no, l.l_suppkey AS supplier_no
FROM {lineitem} l
JOIN {orders} o ON o.o_orderkey = l.l_orderkey
JOIN {customer} c ON c.c_custkey = o.o_custkey
JOIN {supplier} s ON s.s_suppkey = l.l_suppkey
JOIN {supplier} i ON i.s_suppkey = CAST(floor(l.l_partkey / 20e0) AS BIGINT)
"""

#: Online transactions of the text brand, one per line item.
TXN_ONLINE = """
SELECT t.app_id, t.app_hash_file, t.app_customer_code, 'IN' AS app_type_file, t.app_processing_date,
       CAST(t.account_number AS DECIMAL(19,0)) * 1000 AS card_number,
       CASE t.app_id % 5 WHEN 0 THEN '0200' WHEN 1 THEN '0220' WHEN 2 THEN '0400' WHEN 3 THEN '0420'
            ELSE '0800' END AS request_message_type,
       CASE WHEN t.app_id % 9 = 0 THEN '05' ELSE '00' END AS response_code,
       CASE t.app_id % 13 WHEN 0 THEN '000000' WHEN 1 THEN '011000' WHEN 2 THEN '100000' WHEN 3 THEN '110000'
            WHEN 4 THEN '190000' WHEN 5 THEN '200000' WHEN 6 THEN '220000' WHEN 7 THEN '260000'
            WHEN 8 THEN '290000' WHEN 9 THEN '300000' WHEN 10 THEN '400000' WHEN 11 THEN '500000'
            ELSE '000000' END AS processing_code,
       CASE t.app_id % 4 WHEN 0 THEN '13' WHEN 1 THEN '51' ELSE '00' END AS pos_condition_code,
       t.merchant_category_code AS merchants_type,
       t.authorization_code AS authorization_id_resp_code,
       CASE t.app_id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'i' ELSE 'I' END AS issuer_acquirer_indicator,
       t.merchant_country_code AS card_acceptor_country,
       CAST(t.account_reference_number_acquiring_identifier AS STRING) AS acquiring_institution_id_1,
       t.purchase_date AS local_transaction_date,
       CASE WHEN t.app_id % 10 = 0 THEN 0e0 ELSE t.source_amount END AS transaction_amount,
       t.source_currency_code AS transaction_currency_code,
       t.source_amount * 2 AS cryptogram_amount,
       CASE WHEN t.app_id % 20 = 0 THEN '840' ELSE '978' END AS cryptogram_currency_code,
       t.surcharge_amount_sp AS surcharge_amount_sms,
       t.source_amount AS settlement_amount,
       '840' AS settlement_currency_code_sms,
       t.motoec_indicator AS mailtelephone_or_electronic_commerce_indicator,
       t.dcc_indicator AS dcc_indicator_sms,
       substr('CDHPR', CAST(t.app_id % 5 AS INT) + 1, 1) AS account_funding_source,
       'XX' AS pan_extended_country_code,
       substr('ABCDEFGH', CAST(t.app_id % 8 AS INT) + 1, 1) AS product_id_sms,
       t.merchant_name AS card_acceptor_name,
       t.card_acceptor_id AS card_acceptor_id_sms,
       t.terminal_id AS card_acceptor_terminal_id
FROM {txn_text} t
"""

#: Account ranges of the bitmap brand (18-digit bounds in 19-character fields).
IAR = """
SELECT CAST(500000000 + 20 * s_suppkey AS STRING) || '0000000000' AS low_range,
       CAST(500000000 + 20 * s_suppkey + width AS STRING) || '9999999999' AS high_range,
       DATE '1990-01-01' + CAST(s_suppkey * 41 % 700 + shift AS INT) AS app_date_valid,
       substr('ABCDEFGHIJKLMNOPQRSTUVWXY', CAST((s_nationkey + turn) % 25 AS INT) + 1, 1) || 'XY' AS card_country_alpha,
       CAST(s_suppkey % 10 AS STRING) AS card_program_priority,
       'P' || CAST(s_suppkey % 4 AS STRING) AS card_program_identifier,
       'L' || CAST(s_suppkey % 6 AS STRING) AS licensed_product_id,
       CASE WHEN s_suppkey % 17 = 4 THEN 'I' ELSE 'A' END AS active_inactive_code
FROM (
  SELECT s_suppkey, s_nationkey, 19 AS width, 0 AS shift, 0 AS turn FROM {supplier}
  UNION ALL
  SELECT s_suppkey, s_nationkey, 59 AS width, 500 AS shift, 2 AS turn FROM {supplier} WHERE s_suppkey % 4 = 0
) r
"""

BITMAP_PRODUCTS = """
SELECT * FROM (VALUES ('L0', 'MCC', 'C', 'A'), ('L1', 'MCD', 'D', 'A'), ('L2', 'MCP', 'P', 'A'),
                      ('L3', 'MCX', 'C', 'I'), ('L4', 'MCB', 'C', 'A'))
  AS t(licensed_product_id, gcms_product_id, product_category, active_inactive_code)
"""

#: Messages of the bitmap brand: transactions, and one file header per order.
ELEMENTS = """
SELECT t.app_id * 1000000000 + t.part_no * 1000 + t.supplier_no % 1000 AS app_id, 'F' || CAST(CAST(floor(t.app_id / 10e0) AS BIGINT) AS STRING) AS app_hash_file,
       t.app_customer_code, t.app_type_file, t.app_processing_date,
       CASE WHEN t.app_id % 12 = 0 THEN '1442' ELSE '1240' END AS app_message_type,
       200 AS function_code,
       t.account_number + 1000000000000000 AS pan,
       '0' || CAST(t.account_reference_number_acquiring_identifier AS STRING) || '9' AS acquirer_reference_data,
       CAST(t.purchase_date AS TIMESTAMP) AS date_and_time_local_transaction,
       t.merchant_country_code || 'Y' AS card_acceptor_country_code,
       CASE WHEN t.app_id % 40 = 0 THEN 'C' ELSE ' ' END AS settlement_indicator_1,
       t.source_amount AS amount_transaction,
       t.source_amount + 1 AS amount_reconciliation,
       CAST(t.source_currency_code AS INT) AS currency_code_transaction,
       840 AS currency_code_reconciliation,
       CASE t.app_id % 6 WHEN 0 THEN '000000' WHEN 1 THEN '200000' WHEN 2 THEN '010000' WHEN 3 THEN '090000'
            WHEN 4 THEN '500000' ELSE '280000' END AS processing_code,
       CASE WHEN t.app_id % 14 = 0 THEN 'R' WHEN t.app_id % 14 = 1 THEN NULL ELSE '' END AS message_reversal_indicator,
       '12345' || CAST(t.app_id % 3 AS STRING) AS pos_entry_mode,
       t.merchant_category_code AS card_acceptor_business_code_mcc,
       CASE WHEN t.app_id % 5 = 0 THEN '212' ELSE NULL END AS electronic_commerce_indicator_3,
       CASE t.app_id % 3 WHEN 0 THEN '75' WHEN 1 THEN ' 80' ELSE '64' END AS business_activity_4,
       t.merchant_name AS card_acceptor_name,
       t.card_acceptor_id AS card_acceptor_id_code,
       t.terminal_id AS card_acceptor_terminal_id,
       CASE WHEN t.app_id % 7 = 0 THEN 'MCD' ELSE NULL END AS licensed_product_identifier,
       CAST(NULL AS STRING) AS file_id
FROM {txn_text} t
UNION ALL
SELECT 0 AS app_id, 'F' || CAST(o_orderkey AS STRING) AS app_hash_file, 'AUTOMOBILE' AS app_customer_code,
       'IN' AS app_type_file, CAST(o_orderdate AS DATE) AS app_processing_date, '1644' AS app_message_type,
       697 AS function_code, CAST(NULL AS BIGINT) AS pan, NULL, CAST(NULL AS TIMESTAMP), NULL, NULL,
       CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS INT), CAST(NULL AS INT), NULL, NULL, NULL,
       CAST(NULL AS INT), NULL, NULL, NULL, NULL, NULL, NULL, 'ID' || CAST(o_orderkey AS STRING) AS file_id
FROM {orders} WHERE o_orderpriority <> '5-LOW'
"""

TEXT_TYPES = """
SELECT * FROM (VALUES (1, 'PUR', 'Purchase', '100'), (3, 'PUR', 'Quasi cash', '300'), (19, 'CRD', 'Credit', '190'),
                      (20, 'CRD', 'Quasi cash credit', '200'), (21, 'CSH', 'Manual cash', '210'),
                      (22, 'CSH', 'ATM cash', '220'), (25, 'CRD', 'Original credit', '250'),
                      (30, 'PUR', 'Account funding', '310'), (115, 'FEE', 'Fee collection', '519'),
                      (255, 'UNK', 'Unknown', '999'))
  AS t(business_transaction_type_id, transaction_type_id, short_description, business_transaction_type_code)
"""

TEXT_CYCLES = """
SELECT * FROM (VALUES (1, 'Dispute', '1'), (4, 'Dispute return', '4'), (6, 'Rapid', '6'), (11, 'Original', '2'),
                      (23, 'Second', '3'), (25, 'Reversed second', '5'))
  AS t(business_transaction_cycle_id, short_description, business_transaction_cycle_code)
"""

BITMAP_TYPES = """
SELECT * FROM (VALUES ('00', 'PUR', 'Purchase'), ('09', 'PUR', 'Purchase with cash'), ('20', 'CRD', 'Refund'),
                      ('01', 'CSH', 'Cash'), ('50', 'CSH', 'Payment'))
  AS t(business_transaction_type_id, transaction_type_id, short_description)
"""

PRODUCTS = """
SELECT * FROM (VALUES ('A ', 'VISA', '11', 501), ('B', 'VISA', '12', 502), ('C', 'VISA', '13', 503),
                      ('D', 'VISA', '14', 504), ('E', 'VISA', '15', 505), ('F', 'VISA', '16', 506),
                      ('MCC', 'MC', '21', 601), ('MCD', 'MC', '22', 602), ('MCP', 'MC', '23', 603), ('B', 'MC', '24', 604))
  AS t(product_code, brand, range_program_id, legacy_product_id)
"""

BIN_PRODUCTS = """
SELECT trim(product_code) AS bin_product_id, range_program_id FROM {products} WHERE brand = 'VISA'
"""

BITMAP_BIN_PRODUCTS = """
SELECT trim(product_code) AS bin_product_id, range_program_id FROM {products} WHERE brand = 'MC'
"""

FUNDING = """
SELECT * FROM (VALUES ('C', 1), ('D', 2), ('P', 3)) AS t(bin_funding_source_code, bin_funding_source_mc_numeric_code)
"""

#: Rule templates: conditions and fees. Every country gets 1 to 4, every region 1 to 6,
#: the interregional scope all.
RULE_TEMPLATES = """
SELECT * FROM (VALUES
 (1, '05,25', 'NOT:4829,6051', NULL, 'BETWEEN 0 AND 5', '>30000', 'USD', NULL, NULL, NULL, NULL, NULL, NULL,
     'USD', 0.015e0, 0.1e0, 500e0, 1500e0, 'alpha'),
 (2, NULL, NULL, 'Space, 1', NULL, NULL, NULL, 'A,B', NULL, NULL, NULL, NULL, NULL,
     NULL, 0.011e0, NULL, NULL, 900e0, 'beta'),
 (3, NULL, '4000-4999,6010', NULL, NULL, NULL, NULL, NULL, 'VALID', NULL, NULL, NULL, NULL,
     'EUR', 0.02e0, 0.25e0, 100e0, NULL, 'gamma '),
 (4, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'BLANK,7', 'NOT:9', NULL, NULL,
     'GBP', NULL, 2.5e0, NULL, NULL, 'delta'),
 (5, NULL, NULL, NULL, NULL, '<=20000', 'EUR', NULL, NULL, NULL, NULL, 'C', NULL,
     'USD', 0.007e0, 0.05e0, NULL, NULL, 'epsilon'),
 (6, NULL, NULL, NULL, '>8', NULL, NULL, NULL, NULL, NULL, NULL, NULL, '40000000-40000050,40000120',
     'JPY', 0.013e0, NULL, 20e0, 2000e0, 'zeta'),
 (7, 'NOT:07', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, '1.0', NULL, NULL,
     NULL, 0.009e0, 0.3e0, NULL, NULL, 'eta'))
 AS t(template, transaction_code, merchant_category_code, moto_eci_indicator, timeliness, transaction_amount,
      transaction_amount_currency, product_id, authorization_code, special_condition_indicator, usage_code,
      account_funding_source, issuer_bin_8, fee_currency, fee_variable, fee_fixed, fee_min, fee_cap, fee_descriptor)
"""

RULES_TEXT = """
SELECT s.scope AS jurisdiction, s.scope AS region_country_code,
       CAST(s.base + t.template AS STRING) AS rule_id,
       '1990-01-01' AS valid_from,
       CASE WHEN t.template = 3 THEN '1998-06-30' ELSE NULL END AS valid_until,
       t.*
FROM (
  SELECT country_code AS scope, 100 + 10 * (country_numeric - 100) AS base, 4 AS top FROM {countries}
  UNION ALL
  SELECT CAST(r_regionkey + 1 AS STRING) AS scope, 1000 + 10 * r_regionkey AS base, 6 AS top FROM {region}
  UNION ALL
  SELECT '9' AS scope, 2000 AS base, 7 AS top
) s JOIN {rule_templates} t ON t.template <= s.top
"""

RULES_BITMAP = """
SELECT s.scope AS jurisdiction, s.scope AS region_country_code, t.ird,
       CAST(s.base + t.template AS STRING) AS rule_id, '1990-01-01' AS valid_from, CAST(NULL AS STRING) AS valid_until,
       t.template, t.processing_code, t.amount_transaction, t.amount_transaction_currency,
       t.card_acceptor_business_code, t.gcms_product_identifier, t.funding_source, t.acquirer_bin,
       t.electronic_commerce_indicator_3,
       t.rate_currency, t.rate_variable, t.rate_fixed, t.rate_min, t.rate_cap
FROM (
  SELECT country_code AS scope, 100 + 10 * (country_numeric - 100) AS base, 3 AS top FROM {countries}
  UNION ALL
  SELECT substr('VWXYZ', r_regionkey + 1, 1) AS scope, 1000 + 10 * r_regionkey AS base, 5 AS top FROM {region}
  UNION ALL
  SELECT '9' AS scope, 2000 AS base, 6 AS top
) s JOIN (SELECT * FROM (VALUES
 (1, '75', '00,09', '>20000,<60000', 'USD', NULL, NULL, NULL, NULL, NULL, 'USD', 0.012e0, 0.1e0, NULL, 800e0),
 (2, '75', NULL, NULL, NULL, '5000-5999,6010', NULL, 'C', NULL, NULL, 'EUR', 0.02e0, NULL, 50e0, NULL),
 (3, '80', 'NOT:20', NULL, NULL, NULL, 'MCC,MCD', NULL, NULL, NULL, NULL, 0.008e0, 0.2e0, NULL, NULL),
 (4, '64', NULL, NULL, NULL, NULL, NULL, NULL, '450000-450004', NULL, 'GBP', NULL, 1.5e0, NULL, NULL),
 (5, '80', NULL, 'BETWEEN 1000 AND 50000', 'EUR', NULL, NULL, 'BLANK', NULL, NULL, 'USD', 0.004e0, NULL, NULL, NULL),
 (6, '64', NULL, NULL, NULL, NULL, NULL, NULL, NULL, '212', 'JPY', 0.01e0, NULL, 10e0, 1000e0))
 AS v(template, ird, processing_code, amount_transaction, amount_transaction_currency, card_acceptor_business_code,
      gcms_product_identifier, funding_source, acquirer_bin, electronic_commerce_indicator_3,
      rate_currency, rate_variable, rate_fixed, rate_min, rate_cap)) t ON t.template <= s.top
"""

#: Rates of every pair of currencies on every day of the tables.
RATE_DAYS = """
SELECT DISTINCT CAST(l_shipdate AS DATE) AS app_processing_date FROM {lineitem}
UNION
SELECT DISTINCT CAST(o_orderdate AS DATE) AS app_processing_date FROM {orders}
"""

RATES_ORACLE = """
SELECT d.app_processing_date AS date, d.app_processing_date, b.brand, f.ccy AS currency_from, t.ccy AS currency_to,
       f.code AS currency_from_code, t.code AS currency_to_code,
       (3 * f.pos + 2 * t.pos + CAST(day(d.app_processing_date) AS INT) % 5) / 10e0 AS exchange_value
FROM {rate_days} d
CROSS JOIN (VALUES ('VISA'), ('MasterCard')) b(brand)
CROSS JOIN (VALUES ('USD', '840', 1), ('EUR', '978', 2), ('GBP', '826', 3), ('JPY', '392', 4), ('AUD', '36', 5)) f(ccy, code, pos)
JOIN (VALUES ('USD', '840', 1), ('EUR', '978', 2), ('GBP', '826', 3), ('JPY', '392', 4), ('AUD', '36', 5)) t(ccy, code, pos)
  ON f.ccy <> t.ccy
"""

TICKETS = """
SELECT * FROM (VALUES (1, 'VISA', 'AX', 'USD', 0e0, 50000e0), (2, 'VISA', 'AX', 'USD', 50000e0, 9e9),
                      (3, 'VISA', 'BX', 'USD', 0e0, 40000e0), (4, 'VISA', 'BX', 'USD', 40000e0, 90000e0),
                      (5, 'MasterCard', 'AX', 'USD', 0e0, 30000e0), (6, 'MasterCard', 'EX', 'EUR', 1000e0, 9e9))
  AS t(app_id, brand, country_code_list, ticket_currency, size_ticket_min, size_ticket_max)
"""

SWITCH_RANGES = """
SELECT 4000000000000000 + 30 * 10000000 * s_suppkey AS start_value,
       CASE WHEN s_suppkey % 10 = 0 THEN NULL
            ELSE 4000000000000000 + (30 * s_suppkey + 44) * 10000000 + 9999999 END AS end_value,
       'VISA' AS brand,
       CASE s_suppkey % 2 WHEN 0 THEN 'AUTOMOBILE' ELSE 'BUILDING' END AS customer_code,
       'sw' || CAST(s_suppkey % 7 AS STRING) AS switch_code
FROM {supplier}
"""

#: The same ranges for both brands.
SWITCH_RANGES_ALL = """
SELECT * FROM {switch_ranges} v
UNION ALL
SELECT start_value + 1000000000000000, end_value + 1000000000000000, 'MasterCard', customer_code, 'mc' || switch_code
FROM {switch_ranges} m
"""

INPUTS = {
    "currencies": CURRENCIES,
    "customers": CUSTOMERS,
    "countries": COUNTRIES,
    "ardef": ARDEF,
    "txn_text": TXN_TEXT,
    "txn_online": TXN_ONLINE,
    "iar": IAR,
    "bitmap_products": BITMAP_PRODUCTS,
    "elements": ELEMENTS,
    "text_types": TEXT_TYPES,
    "text_cycles": TEXT_CYCLES,
    "bitmap_types": BITMAP_TYPES,
    "products": PRODUCTS,
    "bin_products": BIN_PRODUCTS,
    "bitmap_bin_products": BITMAP_BIN_PRODUCTS,
    "funding": FUNDING,
    "rule_templates": RULE_TEMPLATES,
    "rules_text": RULES_TEXT,
    "rules_bitmap": RULES_BITMAP,
    "rate_days": RATE_DAYS,
    "rates": RATES_ORACLE,
    "tickets": TICKETS,
    "switch_ranges": SWITCH_RANGES,
    "switch_ranges_all": SWITCH_RANGES_ALL,
}

_NAME = re.compile(r"\{([a-z]\w*)\}")


def oracle(sql: str, extra: dict[str, str] | None = None) -> str:
    """SQL for the oracle database, inputs written out in full."""
    known = {**INPUTS, **(extra or {})}

    def fill(match: re.Match) -> str:
        name = match.group(1)
        if name in TABLES:
            return name
        return "(" + oracle(known[name], extra) + ")"

    return _NAME.sub(fill, sql)


class Source:
    """Driver tables and inputs of one scale-factor folder as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._known: dict[str, DataFrame] = {}
        #: Folders of the inputs that are stored, by name.
        self.folders: dict[str, str] = {}

    def stored(self, name: str) -> Source:
        """This source with an input that is read several times written once, so its joins run once and leave no shuffle files."""
        self.folders[name] = f"{ensure_checkpoint_dir(self.spark)}/{name}-{uuid.uuid4().hex}"
        self._known[name] = written(getattr(self, name), folder=self.folders[name])
        return self

    def steps(self, name: str) -> int:
        """Steps for joins of the rows of a stored input, which are counted from its files' footers."""
        return steps_for(self._known[name].count())

    def table(self, name: str) -> DataFrame:
        """A driver table; facts whose rows lie in too few splits are spread over more."""
        if name in self._known:
            return self._known[name]
        frame = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        if name in FACTS:
            frame = self._spread(frame, FACTS[name])
        self._known[name] = frame
        return frame

    def _spread(self, frame: DataFrame, key: str) -> DataFrame:
        """The same rows by a hash of ``key``, if they lie in fewer splits than there are cores or parts of ``TASK_ROWS``.

        A split without the start of a row group has no rows, so few splits are counted by what they hold (from
        the files' footers); a table of many splits is taken as it is.
        """
        wanted = max(self.spark.sparkContext.defaultParallelism, -(-frame.count() // TASK_ROWS))
        splits = frame.rdd.getNumPartitions()
        if splits < 4 * wanted:
            splits = frame.select(F.spark_partition_id().alias("split")).distinct().count()
        return frame if splits >= wanted else frame.repartition(wanted, key)

    def sql(self, text: str) -> DataFrame:
        """Query over driver tables and inputs."""
        used: dict[str, DataFrame] = {}

        def fill(match: re.Match) -> str:
            name = match.group(1)
            if name in TABLES or name in self.folders:
                used[name] = getattr(self, name)
                return "{" + name + "}"
            return "(" + _NAME.sub(fill, INPUTS[name]) + ")"

        return self.spark.sql(_NAME.sub(fill, text), **used)

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.table(name)
        if name not in INPUTS:
            raise AttributeError(name)
        if name not in self._known:
            self._known[name] = self._rates() if name == "rates" else self.sql(INPUTS[name])
        return self._known[name]

    def _rates(self) -> DataFrame:
        pairs = currency_pairs(self.rate_days, self.currencies, "app_processing_date", "currency_alphabetic_code")
        order = F.array(*[F.lit(c) for c in ("USD", "EUR", "GBP", "JPY", "AUD")])
        codes = F.array(*[F.lit(c) for c in ("840", "978", "826", "392", "36")])
        a, b = F.array_position(order, F.col("currency_from")), F.array_position(order, F.col("currency_to"))
        value = (3 * a + 2 * b + F.day("app_processing_date") % 5) / F.lit(10.0)
        # rates are a stored table: written once, read by every lookup
        return checkpointed(pairs.select(
            F.col("app_processing_date").alias("date"),
            "app_processing_date",
            F.explode(F.array(F.lit("VISA"), F.lit("MasterCard"))).alias("brand"),
            "currency_from",
            "currency_to",
            F.element_at(codes, a.cast("int")).alias("currency_from_code"),
            F.element_at(codes, b.cast("int")).alias("currency_to_code"),
            value.alias("exchange_value"),
        ))
