"""Oracle SQL of the calculated fields and the interchange, used by several queries."""

from __future__ import annotations

ON_DATE = "2002-01-01"

RANGES = """
SELECT * FROM (
  SELECT r.*, row_number() OVER (
           PARTITION BY lo ORDER BY app_date_valid DESC, delete_indicator NULLS LAST, hi DESC,
           ardef_country, account_funding_source, product_id, issuer_country, technology_indicator,
           fast_funds, travel_indicator, b2b_program_id, nnss_indicator, product_subtype) AS rn
  FROM (SELECT DISTINCT app_date_valid, delete_indicator, ardef_country, account_funding_source, product_id,
               country AS issuer_country, technology_indicator, fast_funds, travel_indicator, b2b_program_id,
               nnss_indicator, product_subtype,
               CAST(rpad(left(trim(low_key_for_range), 9), %(digits)s, '0') AS DECIMAL(19,0)) AS lo,
               CAST(rpad(left(trim(table_key), 9), %(digits)s, '9') AS DECIMAL(19,0)) AS hi
        FROM {ardef} a WHERE app_date_valid <= DATE '2002-01-01') r) q
WHERE rn = 1
"""

TEXT_MATCHED = """
SELECT * FROM (
  SELECT t.*, u.ardef_country, u.account_funding_source, u.product_id, u.issuer_country, u.technology_indicator,
         u.fast_funds, u.travel_indicator, u.b2b_program_id, u.nnss_indicator, u.product_subtype,
         row_number() OVER (PARTITION BY t.app_id, t.app_hash_file
                            ORDER BY u.app_date_valid DESC, u.hi DESC, u.lo DESC) AS n
  FROM {txn_text} t JOIN {o_ranges} u ON t.account_number BETWEEN u.lo AND u.hi) m
WHERE n = 1
"""

TEXT_CALCULATED = """
SELECT k.*,
  CASE WHEN jurisdiction = 'intraregional' THEN jurisdiction_region
       WHEN jurisdiction = 'interregional' THEN '9' ELSE jurisdiction_country END AS jurisdiction_assigned,
  source_amount * CASE WHEN jurisdiction IN ('on-us', 'off-us') AND settlement_flag <> 0
       THEN to_local ELSE to_settlement END AS settlement_report_amount,
  CASE WHEN jurisdiction IN ('on-us', 'off-us') AND settlement_flag <> 0
       THEN local_currency_code ELSE settlement_currency_code END AS settlement_report_currency_code
FROM (
SELECT t.*, cu.local_currency_code, cu.settlement_currency_code,
  CASE WHEN right(authorization_code, 1) = 'x'
         OR right(authorization_code, 5) IN ('     ', '00000', '0000 ', '0000n', '0000p', '0000y')
       THEN 'INVALID' ELSE 'VALID' END AS authorization_code_valid,
  CASE app_type_file WHEN 'IN' THEN 'issuing' WHEN 'OUT' THEN 'acquiring' ELSE app_type_file END AS business_mode,
  CASE
    WHEN t.ardef_country = t.merchant_country_code THEN
      CASE
        WHEN app_type_file = 'IN' AND (list_contains(string_split(cu.acquiring_bins, ','),
             left(CAST(account_reference_number_acquiring_identifier AS VARCHAR), 6)) OR collection_only_flag = 'C')
          THEN 'on-us'
        WHEN app_type_file = 'OUT' AND (
             list_contains(string_split(cu.issuing_bins_6_digits, ','), left(CAST(account_number AS VARCHAR), 6))
             OR list_contains(string_split(cu.issuing_bins_8_digits, ','), left(CAST(account_number AS VARCHAR), 8))
             OR collection_only_flag = 'C') THEN 'on-us'
        ELSE 'off-us' END
    WHEN ci.visa_region_code = cm.visa_region_code THEN 'intraregional'
    WHEN ci.visa_region_code <> cm.visa_region_code THEN 'interregional' END AS jurisdiction,
  cm.country_code AS jurisdiction_country, cm.visa_region_code AS jurisdiction_region,
  ci.visa_region_code AS issuer_region,
  CAST(central_processing_date - purchase_date AS INTEGER) AS timeless,
  account_funding_source AS funding_source,
  CASE WHEN CAST(transaction_code AS INT) BETWEEN 20 AND 29 AND usage_code IN (1, 9) THEN 1 ELSE 0 END
    AS reversal_indicator,
  CASE
    WHEN transaction_code IN ('05', '15', '25', '35') AND app_type_file = 'IN' THEN
      CASE WHEN special_condition_indicator_merchant_transaction_indicator IN ('7', '8') THEN 3
           WHEN special_condition_indicator_merchant_transaction_indicator IS NULL THEN 255 ELSE 1 END
    WHEN transaction_code IN ('05', '15', '25', '35') THEN
      CASE WHEN merchant_category_code IN (4829, 6051, 7995) THEN 3
           WHEN merchant_category_code IS NULL THEN 255 ELSE 1 END
    WHEN transaction_code IN ('07', '17', '27', '37') THEN
      CASE merchant_category_code WHEN 6010 THEN 21 WHEN 6011 THEN 22 ELSE 255 END
    WHEN transaction_code IN ('06', '16', '26', '36') THEN
      CASE WHEN usage_code = 1 AND transaction_code_qualifier_0 = 2 THEN 25 WHEN usage_code = 1 THEN 19 ELSE 255 END
    ELSE 255 END AS business_transaction_type,
  CASE
    WHEN transaction_code IN ('05', '06', '07') THEN CASE usage_code WHEN 1 THEN 11 WHEN 2 THEN 23 WHEN 9 THEN 6 ELSE 255 END
    WHEN transaction_code IN ('15', '16', '17', '35', '36', '37') THEN CASE usage_code WHEN 1 THEN 1 WHEN 9 THEN 4 ELSE 255 END
    WHEN transaction_code IN ('25', '26', '27') THEN CASE usage_code WHEN 1 THEN 11 WHEN 9 THEN 6 WHEN 2 THEN 25 ELSE 255 END
    ELSE 255 END AS business_transaction_cycle,
  CASE WHEN t.source_currency_code = CAST(ms.currency_numeric_code AS VARCHAR) THEN 1e0 ELSE xs.exchange_value END AS to_settlement,
  CASE WHEN t.source_currency_code = CAST(ml.currency_numeric_code AS VARCHAR) THEN 1e0 ELSE xl.exchange_value END AS to_local
FROM {o_matched} t
LEFT JOIN {countries} cm ON cm.country_code = t.merchant_country_code
LEFT JOIN {countries} ci ON ci.country_code = t.ardef_country
LEFT JOIN {customers} cu ON cu.code = t.app_customer_code
LEFT JOIN {currencies} ms ON ms.currency_alphabetic_code = cu.settlement_currency_code
LEFT JOIN {currencies} ml ON ml.currency_alphabetic_code = cu.local_currency_code
LEFT JOIN {rates} xs ON xs.app_processing_date = t.app_processing_date AND xs.brand = 'VISA'
  AND xs.currency_from_code = t.source_currency_code AND xs.currency_to = cu.settlement_currency_code
LEFT JOIN {rates} xl ON xl.app_processing_date = t.app_processing_date AND xl.brand = 'VISA'
  AND xl.currency_from_code = t.source_currency_code AND xl.currency_to = cu.local_currency_code) k
"""

#: First rule of every transaction; the template number stands for its conditions.
TEXT_RULED = """
SELECT * FROM (
SELECT e.*, r.rule_id, r.region_country_code, r.fee_currency, r.fee_variable, r.fee_fixed, r.fee_min, r.fee_cap,
       r.fee_descriptor,
       row_number() OVER (PARTITION BY e.app_id, e.app_hash_file ORDER BY CAST(r.rule_id AS DOUBLE)) AS pick
FROM (
  SELECT t.*, m.currency_alphabetic_code AS ccy,
         t.source_amount * CASE WHEN m.currency_alphabetic_code = 'USD' THEN 1e0 ELSE xu.exchange_value END AS amount_usd,
         t.source_amount * CASE WHEN m.currency_alphabetic_code = 'EUR' THEN 1e0 ELSE xe.exchange_value END AS amount_eur
  FROM {o_calculated} t
  LEFT JOIN {currencies} m ON m.currency_numeric_code = CAST(t.source_currency_code AS INT)
  LEFT JOIN {rates} xu ON xu.app_processing_date = t.purchase_date AND xu.brand = 'VISA'
    AND xu.currency_from = m.currency_alphabetic_code AND xu.currency_to = 'USD'
  LEFT JOIN {rates} xe ON xe.app_processing_date = t.purchase_date AND xe.brand = 'VISA'
    AND xe.currency_from = m.currency_alphabetic_code AND xe.currency_to = 'EUR') e
LEFT JOIN (SELECT rule_id, region_country_code, template, valid_from, valid_until, fee_currency, fee_variable, fee_fixed,
                  fee_min, fee_cap, fee_descriptor FROM {rules_text} z) r ON r.region_country_code = e.jurisdiction_assigned
  AND e.app_processing_date BETWEEN CAST(r.valid_from AS DATE) AND coalesce(CAST(r.valid_until AS DATE), current_date)
  AND CASE r.template
    WHEN 1 THEN transaction_code IN ('05', '25') AND merchant_category_code NOT IN (4829, 6051)
                AND timeless BETWEEN 0 AND 5 AND amount_usd > 30000
    WHEN 2 THEN motoec_indicator IN (' ', '1') AND product_id IN ('A', 'B')
    WHEN 3 THEN (merchant_category_code BETWEEN 4000 AND 4999 OR merchant_category_code = 6010)
                AND authorization_code_valid = 'VALID'
    WHEN 4 THEN trim(special_condition_indicator_merchant_transaction_indicator) IN ('', '7') AND usage_code <> 9
    WHEN 5 THEN account_funding_source = 'C' AND amount_eur <= 20000
    WHEN 6 THEN timeless > 8 AND (CAST(left(CAST(account_number AS VARCHAR), 8) AS BIGINT) BETWEEN 40000000 AND 40000050
                OR left(CAST(account_number AS VARCHAR), 8) = '40000120')
    WHEN 7 THEN transaction_code <> '07' AND usage_code = 1 END) z
WHERE pick = 1
"""

TEXT_FEE = """
SELECT y.*, x2.exchange_value AS fee_x,
  CASE WHEN fee_variable IS NULL THEN fee_fixed
       WHEN raw <= fee_min THEN fee_min WHEN raw >= fee_cap THEN fee_cap ELSE raw END AS calculated_value
FROM (
  SELECT w.*, fee_variable * (source_amount * CASE WHEN fee_currency IS NULL OR fee_currency = ccy THEN 1e0
                                              ELSE x.exchange_value END) + coalesce(fee_fixed, 0e0) AS raw
  FROM {o_ruled} w
  LEFT JOIN {rates} x ON x.app_processing_date = w.purchase_date AND x.brand = 'VISA'
    AND x.currency_from = w.ccy AND x.currency_to = w.fee_currency) y
LEFT JOIN {customers} cu ON cu.code = y.app_customer_code
LEFT JOIN {rates} x2 ON x2.app_processing_date = y.app_processing_date AND x2.brand = 'VISA'
    AND x2.currency_from = y.fee_currency AND x2.currency_to = cu.report_currency_code
"""

ONLINE_CALCULATED = """
SELECT k.*,
  CASE WHEN jurisdiction = 'intraregional' THEN jurisdiction_region
       WHEN jurisdiction = 'interregional' THEN '9' ELSE jurisdiction_country END AS jurisdiction_assigned,
  CASE WHEN ty.transaction_type_id = 'PUR' THEN CASE reversal_indicator WHEN 0 THEN '05' WHEN 1 THEN '25' END
       WHEN ty.transaction_type_id = 'CRD' THEN CASE reversal_indicator WHEN 0 THEN '06' WHEN 1 THEN '26' END
       WHEN ty.transaction_type_id = 'CSH' THEN CASE reversal_indicator WHEN 0 THEN '07' WHEN 1 THEN '27' END
  END AS transaction_code_sms,
  ty.transaction_type_id AS type_group,
  mc.currency_alphabetic_code AS settlement_report_currency_code
FROM (
SELECT t.*,
  CASE WHEN right(authorization_id_resp_code, 1) = 'x'
         OR right(authorization_id_resp_code, 5) IN ('     ', '00000', '0000 ', '0000n', '0000p', '0000y')
       THEN 'INVALID' ELSE 'VALID' END AS authorization_code_valid,
  CASE upper(issuer_acquirer_indicator) WHEN 'A' THEN 'acquiring' WHEN 'I' THEN 'issuing' END AS business_mode,
  CASE
    WHEN t.ardef_country = t.card_acceptor_country THEN
      CASE
        WHEN upper(issuer_acquirer_indicator) = 'I' AND list_contains(string_split(cu.acquiring_bins, ','),
             left(acquiring_institution_id_1, 6)) THEN 'on-us'
        WHEN upper(issuer_acquirer_indicator) = 'A' AND (
             list_contains(string_split(cu.issuing_bins_6_digits, ','), left(CAST(card_number AS VARCHAR), 6))
             OR list_contains(string_split(cu.issuing_bins_8_digits, ','), left(CAST(card_number AS VARCHAR), 8)))
          THEN 'on-us'
        ELSE 'off-us' END
    WHEN ci.visa_region_code = cm.visa_region_code THEN 'intraregional'
    WHEN ci.visa_region_code <> cm.visa_region_code THEN 'interregional' END AS jurisdiction,
  cm.country_code AS jurisdiction_country, cm.visa_region_code AS jurisdiction_region,
  CAST(app_processing_date - local_transaction_date AS INTEGER) AS timeless,
  range_funding AS funding_source,
  CASE WHEN response_code = '00' THEN CASE WHEN request_message_type IN ('0200', '0220') THEN 0
       WHEN request_message_type IN ('0400', '0420') THEN 1 END END AS reversal_indicator,
  CASE
    WHEN request_message_type NOT IN ('0200', '0220', '0400', '0420') THEN NULL
    WHEN response_code <> '00' THEN CASE WHEN merchants_type = 6011 THEN 249 ELSE 236 END
    WHEN left(processing_code, 2) = '22' THEN
      CASE WHEN pos_condition_code = '13' AND merchants_type NOT IN (4815, 6010, 6011) THEN 20 END
    WHEN pos_condition_code IN ('13', '51') THEN NULL
    WHEN left(processing_code, 2) = '01' THEN CASE merchants_type WHEN 6010 THEN 21 WHEN 6011 THEN 22 END
    WHEN left(processing_code, 2) = '30' THEN CASE merchants_type WHEN 6011 THEN 247 END
    WHEN left(processing_code, 2) = '40' THEN CASE merchants_type WHEN 6011 THEN 250 END
    WHEN merchants_type IN (4815, 6010, 6011) THEN NULL
    ELSE CASE left(processing_code, 2) WHEN '00' THEN 1 WHEN '10' THEN 30 WHEN '11' THEN 3 WHEN '19' THEN 115
         WHEN '20' THEN 19 WHEN '26' THEN 25 WHEN '29' THEN 200 WHEN '50' THEN 27 END
  END AS business_transaction_type
FROM (SELECT * FROM (
  SELECT t.*, u.ardef_country, u.account_funding_source AS range_funding, u.product_id, u.issuer_country,
         row_number() OVER (PARTITION BY t.app_id, t.app_hash_file
                            ORDER BY u.app_date_valid DESC, u.hi DESC, u.lo DESC) AS n
  FROM {txn_online} t JOIN {o_ranges19} u ON t.card_number BETWEEN u.lo AND u.hi) m WHERE n = 1) t
LEFT JOIN {countries} cm ON cm.country_code = t.card_acceptor_country
LEFT JOIN {countries} ci ON ci.country_code = t.ardef_country
LEFT JOIN {customers} cu ON cu.code = t.app_customer_code) k
LEFT JOIN {text_types} ty ON ty.business_transaction_type_id = k.business_transaction_type
LEFT JOIN {currencies} mc ON CAST(mc.currency_numeric_code AS VARCHAR) = k.settlement_currency_code_sms
"""

ONLINE_RULED = """
SELECT * FROM (
SELECT e.*, r.rule_id, r.region_country_code, r.fee_currency, r.fee_variable, r.fee_fixed, r.fee_min, r.fee_cap,
       r.fee_descriptor,
       row_number() OVER (PARTITION BY e.app_id, e.app_hash_file ORDER BY CAST(r.rule_id AS DOUBLE)) AS pick
FROM (
  SELECT t.*, m.currency_alphabetic_code AS ccy, m2.currency_alphabetic_code AS ccy2,
         t.transaction_amount * CASE WHEN m.currency_alphabetic_code = 'USD' THEN 1e0 ELSE xu.exchange_value END AS amount_usd,
         t.transaction_amount * CASE WHEN m.currency_alphabetic_code = 'EUR' THEN 1e0 ELSE xe.exchange_value END AS amount_eur
  FROM {o_online} t
  LEFT JOIN {currencies} m ON m.currency_numeric_code = CAST(t.transaction_currency_code AS INT)
  LEFT JOIN {currencies} m2 ON m2.currency_numeric_code = CAST(t.cryptogram_currency_code AS INT)
  LEFT JOIN {rates} xu ON xu.app_processing_date = t.local_transaction_date AND xu.brand = 'VISA'
    AND xu.currency_from = m.currency_alphabetic_code AND xu.currency_to = 'USD'
  LEFT JOIN {rates} xe ON xe.app_processing_date = t.local_transaction_date AND xe.brand = 'VISA'
    AND xe.currency_from = m.currency_alphabetic_code AND xe.currency_to = 'EUR') e
LEFT JOIN (SELECT rule_id, region_country_code, template, valid_from, valid_until, fee_currency, fee_variable, fee_fixed,
                  fee_min, fee_cap, fee_descriptor FROM {rules_text} z) r ON r.region_country_code = e.jurisdiction_assigned
  AND e.app_processing_date BETWEEN CAST(r.valid_from AS DATE) AND coalesce(CAST(r.valid_until AS DATE), current_date)
  AND CASE r.template
    WHEN 1 THEN coalesce(transaction_code_sms, 'BLANK') IN ('05', '25') AND merchants_type NOT IN (4829, 6051)
                AND timeless BETWEEN 0 AND 5 AND amount_usd > 30000
    WHEN 2 THEN mailtelephone_or_electronic_commerce_indicator IN (' ', '1') AND product_id IN ('A', 'B')
    WHEN 3 THEN (merchants_type BETWEEN 4000 AND 4999 OR merchants_type = 6010) AND authorization_code_valid = 'VALID'
    WHEN 4 THEN true
    WHEN 5 THEN funding_source = 'C' AND amount_eur <= 20000
    WHEN 6 THEN timeless > 8 AND (CAST(left(CAST(card_number AS VARCHAR), 8) AS BIGINT) BETWEEN 40000000 AND 40000050
                OR left(CAST(card_number AS VARCHAR), 8) = '40000120')
    WHEN 7 THEN coalesce(transaction_code_sms, 'BLANK') <> '07' END) z
WHERE pick = 1
"""

ONLINE_FEE = """
SELECT y.*, CASE WHEN fee_variable IS NULL THEN fee_fixed
       WHEN raw <= fee_min THEN fee_min WHEN raw >= fee_cap THEN fee_cap ELSE raw END AS calculated_value
FROM (
  SELECT v.*, fee_variable * (fee_base * CASE WHEN fee_currency IS NULL OR fee_currency = fee_from THEN 1e0
                                              ELSE x.exchange_value END) + coalesce(fee_fixed, 0e0) AS raw
  FROM (SELECT w.*, CASE WHEN transaction_amount <> 0 THEN transaction_amount
                         ELSE cryptogram_amount + surcharge_amount_sms END AS fee_base,
                    CASE WHEN transaction_amount <> 0 THEN ccy ELSE ccy2 END AS fee_from FROM {o_online_ruled} w) v
  LEFT JOIN {rates} x ON x.app_processing_date = v.local_transaction_date AND x.brand = 'VISA'
    AND x.currency_from = v.fee_from AND x.currency_to = v.fee_currency) y
"""

BITMAP_RANGES = """
SELECT * FROM (
  SELECT a.app_date_valid, CAST(left(a.low_range, 18) AS BIGINT) AS lo, CAST(left(a.high_range, 18) AS BIGINT) AS hi,
         a.card_country_alpha AS iar_country, b.gcms_product_id AS gcms_product_identifier,
         b.product_category AS funding_source, a.card_program_identifier,
         row_number() OVER (PARTITION BY left(a.low_range, 18) ORDER BY a.app_date_valid DESC,
           CAST(a.card_program_priority AS DOUBLE) NULLS LAST, a.card_country_alpha NULLS FIRST,
           b.gcms_product_id NULLS FIRST, b.product_category NULLS FIRST, a.card_program_identifier NULLS FIRST) AS rn
  FROM {iar} a LEFT JOIN {bitmap_products} b
    ON b.licensed_product_id = a.licensed_product_id AND b.active_inactive_code = 'A'
  WHERE a.app_date_valid <= DATE '2002-01-01' AND a.active_inactive_code = 'A') q WHERE rn = 1
"""

BITMAP_CALCULATED = """
SELECT k.*,
  CASE WHEN jurisdiction = 'intraregional' THEN jurisdiction_region
       WHEN jurisdiction = 'interregional' THEN '9' ELSE jurisdiction_country END AS jurisdiction_assigned,
  CASE WHEN given THEN CASE WHEN app_type_file = 'IN' THEN rec_ccy WHEN domestic THEN local_currency_code
       ELSE settlement_currency_code END END AS settlement_report_currency_code,
  CASE WHEN given THEN CASE WHEN app_type_file = 'IN' THEN amount_reconciliation
       ELSE amount_transaction * CASE WHEN domestic THEN to_local ELSE to_settlement END END END AS settlement_report_amount,
  CASE WHEN given THEN header_id END AS mc_file_id
FROM (SELECT j.*, coalesce(jurisdiction IN ('on-us', 'off-us') AND currency_code_transaction = local_num, false) AS domestic,
             header_id IS NOT NULL AND iar_country IS NOT NULL AS given
FROM (
SELECT t.*, cu.local_currency_code, cu.settlement_currency_code, ml.currency_numeric_code AS local_num,
  h.header_id, mr.currency_alphabetic_code AS rec_ccy,
  CASE app_type_file WHEN 'IN' THEN 'issuing' WHEN 'OUT' THEN 'acquiring' ELSE app_type_file END AS business_mode,
  CASE
    WHEN t.iar_country = t.card_acceptor_country_code THEN
      CASE
        WHEN app_type_file = 'IN' AND (list_contains(string_split(cu.acquiring_bins, ','), acquirer_bin)
             OR settlement_indicator_1 = 'C') THEN 'on-us'
        WHEN app_type_file = 'OUT' AND (
             list_contains(string_split(cu.issuing_bins_6_digits, ','), left(CAST(num_card AS VARCHAR), 6))
             OR list_contains(string_split(cu.issuing_bins_8_digits, ','), left(CAST(num_card AS VARCHAR), 8))
             OR settlement_indicator_1 = 'C') THEN 'on-us'
        ELSE 'off-us' END
    WHEN ci.mastercard_region_code = cm.mastercard_region_code THEN 'intraregional'
    WHEN ci.mastercard_region_code <> cm.mastercard_region_code THEN 'interregional' END AS jurisdiction,
  ci.country_code AS jurisdiction_country, ci.mastercard_region_code AS jurisdiction_region,
  CASE WHEN t.currency_code_transaction = ms.currency_numeric_code THEN 1e0 ELSE xs.exchange_value END AS to_settlement,
  CASE WHEN t.currency_code_transaction = ml.currency_numeric_code THEN 1e0 ELSE xl.exchange_value END AS to_local
FROM (SELECT * FROM (
  SELECT e.*, u.iar_country, u.gcms_product_identifier, u.funding_source, u.card_program_identifier,
         row_number() OVER (PARTITION BY e.app_id, e.app_hash_file, e.pan
                            ORDER BY u.app_date_valid DESC, u.hi DESC, u.lo DESC) AS n
  FROM (SELECT x.*, CAST(left(rpad(CAST(pan AS VARCHAR), 18, '0'), 18) AS BIGINT) AS num_card,
               substr(acquirer_reference_data, 2, 6) AS acquirer_bin
        FROM {elements} x WHERE app_message_type IN ('1240', '1442')) e
  LEFT JOIN {o_bitmap_ranges} u ON e.num_card BETWEEN u.lo AND u.hi) m WHERE n = 1) t
LEFT JOIN {countries} cm ON cm.country_code_alternative = t.card_acceptor_country_code
LEFT JOIN {countries} ci ON ci.country_code_alternative = t.iar_country
LEFT JOIN {customers} cu ON cu.code = t.app_customer_code
LEFT JOIN {currencies} ms ON ms.currency_alphabetic_code = cu.settlement_currency_code
LEFT JOIN {currencies} ml ON ml.currency_alphabetic_code = cu.local_currency_code
LEFT JOIN {currencies} mr ON mr.currency_numeric_code = t.currency_code_reconciliation
LEFT JOIN (SELECT app_hash_file AS hf, min(file_id) AS header_id FROM {elements} z
           WHERE app_message_type = '1644' AND function_code = 697 GROUP BY app_hash_file) h ON h.hf = t.app_hash_file
LEFT JOIN {rates} xs ON xs.app_processing_date = t.app_processing_date AND xs.brand = 'MasterCard'
  AND CAST(xs.currency_from_code AS INT) = t.currency_code_transaction AND xs.currency_to = cu.settlement_currency_code
LEFT JOIN {rates} xl ON xl.app_processing_date = t.app_processing_date AND xl.brand = 'MasterCard'
  AND CAST(xl.currency_from_code AS INT) = t.currency_code_transaction AND xl.currency_to = cu.local_currency_code
) j) k
"""

BITMAP_FEE = """
SELECT y.*, CASE WHEN rate_variable IS NULL THEN rate_fixed
       WHEN raw <= rate_min THEN rate_min WHEN raw >= rate_cap THEN rate_cap ELSE raw END AS calculated_value
FROM (
  SELECT w.*, rate_variable * (amount_transaction * CASE WHEN rate_currency IS NULL OR rate_currency = ccy THEN 1e0
                               ELSE x.exchange_value END) + coalesce(rate_fixed, 0e0) AS raw
  FROM (SELECT * FROM (
    SELECT e.*, r.rule_id, r.region_country_code, r.ird, r.rate_currency, r.rate_variable, r.rate_fixed, r.rate_min,
           r.rate_cap,
           row_number() OVER (PARTITION BY e.app_id, e.app_hash_file, e.pan ORDER BY CAST(r.rule_id AS DOUBLE)) AS pick
    FROM (
      SELECT t.*, m.currency_alphabetic_code AS ccy,
             amount_transaction * CASE WHEN m.currency_alphabetic_code = 'USD' THEN 1e0 ELSE xu.exchange_value END AS amount_usd,
             amount_transaction * CASE WHEN m.currency_alphabetic_code = 'EUR' THEN 1e0 ELSE xe.exchange_value END AS amount_eur
      FROM {o_bitmap} t
      LEFT JOIN {currencies} m ON m.currency_numeric_code = t.currency_code_transaction
      LEFT JOIN {rates} xu ON xu.app_processing_date = CAST(t.date_and_time_local_transaction AS DATE)
        AND xu.brand = 'MasterCard' AND xu.currency_from = m.currency_alphabetic_code AND xu.currency_to = 'USD'
      LEFT JOIN {rates} xe ON xe.app_processing_date = CAST(t.date_and_time_local_transaction AS DATE)
        AND xe.brand = 'MasterCard' AND xe.currency_from = m.currency_alphabetic_code AND xe.currency_to = 'EUR') e
    LEFT JOIN (SELECT rule_id, region_country_code, ird, template, rate_currency, rate_variable, rate_fixed, rate_min,
                      rate_cap FROM {rules_bitmap} z) r ON r.region_country_code = e.jurisdiction_assigned AND r.ird = trim(e.business_activity_4)
      AND CASE r.template
        WHEN 1 THEN left(processing_code, 2) IN ('00', '09') AND amount_usd > 20000 AND amount_usd < 60000
        WHEN 2 THEN (card_acceptor_business_code_mcc BETWEEN 5000 AND 5999 OR card_acceptor_business_code_mcc = 6010)
                    AND e.funding_source = 'C'
        WHEN 3 THEN left(processing_code, 2) <> '20' AND e.gcms_product_identifier IN ('MCC', 'MCD')
        WHEN 4 THEN CAST(e.acquirer_bin AS BIGINT) BETWEEN 450000 AND 450004
        WHEN 5 THEN amount_eur BETWEEN 1000 AND 50000 AND e.funding_source IS NULL
        WHEN 6 THEN e.electronic_commerce_indicator_3 = '212' END) q WHERE pick = 1) w
  LEFT JOIN {rates} x ON x.app_processing_date = CAST(w.date_and_time_local_transaction AS DATE)
    AND x.brand = 'MasterCard' AND x.currency_from = w.ccy AND x.currency_to = w.rate_currency) y
"""

ORACLE_INPUTS = {
    "o_ranges": RANGES % {"digits": 16},
    "o_ranges19": RANGES % {"digits": 19},
    "o_matched": TEXT_MATCHED,
    "o_calculated": TEXT_CALCULATED,
    "o_ruled": TEXT_RULED,
    "o_fee": TEXT_FEE,
    "o_online": ONLINE_CALCULATED,
    "o_online_ruled": ONLINE_RULED,
    "o_online_fee": ONLINE_FEE,
    "o_bitmap_ranges": BITMAP_RANGES,
    "o_bitmap": BITMAP_CALCULATED,
    "o_bitmap_fee": BITMAP_FEE,
}
