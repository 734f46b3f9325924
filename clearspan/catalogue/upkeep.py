"""Data quality, versions, hierarchy, rule sheets, file ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearspan.catalogue.inputs import Source, oracle
from clearspan.operators import quality, rules, versions
from clearspan.operators.hierarchy import with_aggregation_level
from clearspan.sources import ledger, tables

KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_KEY = ", ".join(KEY)

CHECKS = [
    {"name": "ship", "kind": "Date", "format": "%y%m%d"},
    {"name": "julian", "kind": "date_julian", "format": ""},
    {"name": "part", "kind": "int", "format": ""},
    {"name": "price", "kind": "float", "format": ""},
    {"name": "absent", "kind": "int", "format": ""},
]


def staged_items(s: Source) -> DataFrame:
    """Line items as text, some fields broken on purpose."""
    n = F.col("l_orderkey")
    return s.lineitem.select(
        *KEY,
        F.when(n % 31 == 0, "991345").when(n % 31 == 1, "").otherwise(F.date_format("l_shipdate", "yyMMdd")).alias("ship"),
        F.when(n % 37 == 0, "4400").when(n % 37 == 1, F.lit(None)).otherwise(
            F.concat(F.lit("4"), F.date_format("l_shipdate", "DDD"))
        ).alias("julian"),
        F.when(n % 41 == 0, "1e3").otherwise(F.concat(F.lit(" "), F.col("l_partkey"))).alias("part"),
        F.when(n % 43 == 0, F.concat(F.lit("x"), F.col("l_tax"))).otherwise(F.col("l_quantity").cast("string")).alias("price"),
    )


def _checked(s: Source) -> DataFrame:
    return quality.with_errors(staged_items(s), CHECKS, today=F.lit("2024-05-01").cast("date"))


def dq_profile(spark: SparkSession, sf: str) -> DataFrame:
    return quality.error_profile(_checked(Source(spark, sf)))


def dq_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quarantine(_checked(Source(spark, sf))).select(*KEY, "message_error")


def dq_clean(spark: SparkSession, sf: str) -> DataFrame:
    return quality.clean(_checked(Source(spark, sf))).select(*KEY, "ship", "julian", "part")


def _detail_like(s: Source) -> DataFrame:
    n = F.col("l_orderkey")

    def holed(c, k: int):
        return F.when(n % k != 0, c)

    return s.lineitem.select(
        *KEY,
        holed(F.col("l_extendedprice"), 5).alias("report_amount"),
        holed(F.lit("PE"), 7).alias("account_range_country"),
        holed(F.col("l_returnflag"), 11).alias("account_funding_source"),
        holed(F.col("l_partkey").cast("string"), 13).alias("account_number"),
        holed(F.lit("on-us"), 10).alias("jurisdiction"),
        holed(F.lit("F"), 15).alias("product_id"),
        holed(F.lit("17"), 4).alias("range_program_id"),
    )


def unknown_defaults(spark: SparkSession, sf: str) -> DataFrame:
    return quality.fill_unknown(_detail_like(Source(spark, sf)))


def null_reject(spark: SparkSession, sf: str) -> DataFrame:
    return quality.reject_incomplete(_detail_like(Source(spark, sf)))


def rule_sheet_problems(spark: SparkSession, sf: str) -> DataFrame:
    s = Source(spark, sf)
    sheet = s.lineitem.select(
        F.when(F.col("l_orderkey") % 500 != 0, F.col("l_returnflag")).alias("jurisdiction"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("valid_from"),
        F.when(F.col("l_partkey") % 300 == 0, "n/a").otherwise(F.col("l_tax").cast("string")).alias("rate_variable"),
        F.when(F.col("l_linenumber") < 7, F.col("l_discount").cast("string")).alias("rate_min"),
    )
    return rules.rule_sheet_problems(sheet, ["jurisdiction", "valid_from"], ["rate_variable", "rate_min"])


def rule_fields(spark: SparkSession, sf: str) -> DataFrame:
    s = Source(spark, sf)
    sheet = s.part.select(
        "p_partkey",
        F.when(F.col("p_partkey") % 9 != 0, F.col("p_type")).alias("category"),
        F.col("p_brand").alias("payment_product"),
        F.when(F.col("p_size") > 25, F.col("p_name")).alias("fee_tier"),
    )
    return rules.derive_bitmap_rule_fields(sheet).select("p_partkey", "fee_category", "fee_tier")


def rules_merge(spark: SparkSession, sf: str) -> DataFrame:
    s = Source(spark, sf)
    base = s.part.select(
        F.col("p_brand").alias("jurisdiction"),
        F.col("p_partkey").cast("string").alias("rule_id"),
        F.col("p_retailprice").alias("rate_variable"),
    )
    number = F.col("rule_id").cast("bigint")
    current = base.filter(number % 3 != 0)
    sheet = base.filter(number % 2 == 0).withColumn("rate_variable", F.col("rate_variable") + 1)
    return rules.merge_rules(current, sheet, ["jurisdiction", "rule_id"])


def _versions(s: Source) -> tuple[DataFrame, DataFrame]:
    """Stored and incoming range versions from the orders of each customer."""
    rows = s.orders.select(
        (F.col("o_custkey") % 200).alias("low_range"),
        F.col("o_orderstatus").alias("product"),
        F.to_date("o_orderdate").alias("effective"),
        F.to_date("o_orderdate").alias("app_date_valid"),
        "o_orderkey",
    )
    open_end = F.lit(None).cast("date")
    history = rows.filter(F.col("o_orderkey") % 3 != 0).withColumn(
        "app_date_end", F.when(F.col("o_orderkey") % 3 == 1, F.date_add("app_date_valid", 30)).otherwise(open_end)
    )
    incoming = rows.filter(F.col("o_orderkey") % 3 == 0).withColumn("app_date_end", open_end)
    return history, incoming


_RANGE = ["low_range", "product"]
_VERSION = ("effective", "app_date_valid", "app_date_end", "1 DAY")


def scd2_close(spark: SparkSession, sf: str) -> DataFrame:
    history, incoming = _versions(Source(spark, sf))
    return versions.close_open_versions(history, incoming, _RANGE, *_VERSION)


def scd2_late(spark: SparkSession, sf: str) -> DataFrame:
    history, incoming = _versions(Source(spark, sf))
    return versions.end_late_versions(history, incoming, _RANGE, *_VERSION)


def scd2_insert(spark: SparkSession, sf: str) -> DataFrame:
    history, incoming = _versions(Source(spark, sf))
    return versions.new_versions(history, incoming, [*_RANGE, "effective"])


def scd2_merge(spark: SparkSession, sf: str) -> DataFrame:
    history, incoming = _versions(Source(spark, sf))
    return versions.merge_versions(history, incoming, _RANGE, *_VERSION, [*_RANGE, "effective"])


def _timed_versions(s: Source) -> tuple[DataFrame, DataFrame]:
    """Stored and incoming versions of the bitmap brand: a text timestamp orders them, ends are a second apart."""
    stamp = F.to_timestamp_ntz(F.date_format("o_orderdate", "yyyy-MM-dd")) + F.make_dt_interval(secs=F.col("o_orderkey") % 86400)
    rows = s.orders.select(
        (F.col("o_custkey") % 200).alias("low_range"),
        F.when(F.col("o_orderkey") % 40 != 0, F.col("o_orderstatus")).alias("gcms_product"),
        F.date_format(stamp, "yyyyMMddHHmmss").alias("effective_timestamp"),
        stamp.alias("app_date_valid"),
        "o_orderkey",
    )
    open_end = F.lit(None).cast("timestamp_ntz")
    history = rows.filter(F.col("o_orderkey") % 3 != 0).withColumn(
        "app_date_end", F.when(F.col("o_orderkey") % 3 == 1, F.col("app_date_valid") + F.expr("INTERVAL 9 HOUR")).otherwise(open_end)
    )
    # a fifth of the incoming rows repeats a stored version under another number
    again = history.filter(F.col("o_orderkey") % 5 == 1).withColumns({"o_orderkey": -F.col("o_orderkey"), "app_date_end": open_end})
    return history, rows.filter(F.col("o_orderkey") % 3 == 0).withColumn("app_date_end", open_end).unionByName(again)


def scd2_timeline(spark: SparkSession, sf: str) -> DataFrame:
    history, incoming = _timed_versions(Source(spark, sf))
    keys = ["low_range", "gcms_product"]
    return versions.merge_versions(
        history, incoming, keys, "effective_timestamp", "app_date_valid", "app_date_end", "1 SECOND", [*keys, "effective_timestamp"]
    )


def hierarchy_level(spark: SparkSession, sf: str) -> DataFrame:
    s = Source(spark, sf)
    rows = s.customer.select(
        "c_custkey",
        F.col("c_mktsegment").alias("file"),
        F.floor(F.col("c_custkey") / 7).cast("string").alias("rollup_to"),
        F.col("c_custkey").cast("string").alias("reporting_for"),
    )
    return with_aggregation_level(rows, "rollup_to", "reporting_for", ["file"])


def update_costs(spark: SparkSession, sf: str) -> DataFrame:
    s = Source(spark, sf)
    target = s.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    changes = s.orders.filter(F.col("o_orderkey") % 4 == 0).select(
        "o_orderkey", (F.col("o_totalprice") * 2).alias("o_totalprice"), F.lit(None).cast("string").alias("o_orderstatus")
    )
    return versions.update_from(target, changes, ["o_orderkey"], ["o_totalprice", "o_orderstatus"])


def delete_before_reprocess(spark: SparkSession, sf: str) -> DataFrame:
    s = Source(spark, sf)
    table = s.txn_text.select("app_id", "app_hash_file", "source_amount")
    hashes = s.supplier.filter(F.col("s_suppkey") % 2 == 0).select(
        F.concat(F.lit("H"), F.col("s_suppkey"), F.lit("-"), F.col("s_suppkey")).alias("hash_file")
    )
    return versions.delete_files(table, hashes)


def replace_month(spark: SparkSession, sf: str) -> DataFrame:
    s = Source(spark, sf)
    month = F.date_format("o_orderdate", "yyyyMM")
    stored = s.orders.groupBy("o_orderpriority", month.alias("report_month")).agg(F.count(F.lit(1)).alias("rows"))
    fresh = (
        s.orders.filter((F.col("o_orderstatus") == "F") & (month >= "200101"))
        .groupBy("o_orderpriority", month.alias("report_month"))
        .agg((F.count(F.lit(1)) * -1).alias("rows"))
    )
    return versions.replace_execution(stored, fresh, ["o_orderpriority", "report_month"])


def file_revision(spark: SparkSession, sf: str) -> DataFrame:
    s = Source(spark, sf)
    rows = s.orders.select(
        "o_orderkey",
        (F.col("o_custkey") % 700).alias("code"),
        F.col("o_orderpriority").alias("customer"),
        F.lit("VI").alias("brand"),
        F.col("o_orderstatus").alias("file_type"),
    )
    return ledger.mark_repeats(rows, ["code", "customer", "brand", "file_type"])


PATTERNS = [
    ("VI Incoming", r"^https://.*/en/\d+"),
    ("VI Outgoing", r"^http://.*/en/\d+"),
    ("MC Incoming", r"/fr/"),
    ("MC Incoming", r"/de/"),
    ("MC Outgoing", r"^http://blog\."),
    ("IAR (T067)", r"\.org/es/"),
]


def file_classify(spark: SparkSession, sf: str) -> DataFrame:
    pages = Source(spark, sf).pages.select("page_id", "url")
    return ledger.classify(pages, F.col("url"), PATTERNS)


def reprocess_queue(spark: SparkSession, sf: str) -> DataFrame:
    s = Source(spark, sf)
    files = s.orders.select(
        F.col("o_orderkey").alias("code"),
        F.when(F.col("o_orderstatus") == "P", "REVISION").otherwise("PROCESSED").alias("description_status"),
        F.col("o_orderpriority").alias("customer"),
        F.lit("VI").alias("brand"),
        F.when(F.col("o_custkey") % 3 == 0, "IN").when(F.col("o_custkey") % 3 == 1, "OUT").otherwise("OTHER").alias("file_type"),
        F.to_date("o_orderdate").alias("file_date"),
    )
    return ledger.reprocess_queue(files, "1-URGENT", "VI", "1996-01-01", "1999-12-31")


def appended_by_name(spark: SparkSession, sf: str) -> DataFrame:
    s = Source(spark, sf)
    target = s.orders.select("o_orderkey", "o_custkey", "o_totalprice").withColumn("note", F.lit("old"))
    fresh = s.orders.select((F.col("o_totalprice") * 2).alias("o_totalprice"), F.col("o_orderkey"), F.lit(1).alias("extra"))
    return target.unionByName(tables.align(fresh, target))


def export_fill(spark: SparkSession, sf: str) -> DataFrame:
    s = Source(spark, sf)
    n = F.col("l_orderkey")
    report = s.lineitem.select(
        *KEY,
        F.when(n % 3 != 0, F.col("l_linenumber")).alias("bus_id"),
        F.when(n % 4 != 0, F.col("l_extendedprice")).alias("txn_amt"),
        F.when(n % 5 != 0, F.col("l_linenumber")).alias("txn_cnt"),
        F.when(n % 7 != 0, F.col("l_partkey").cast("string")).alias("mct_cd"),
    )
    return tables.report_for_export(report)


def unit_costs(spark: SparkSession, sf: str) -> DataFrame:
    s = Source(spark, sf)
    raw = s.lineitem.select(
        *KEY,
        F.when(F.col("l_linenumber") == 7, F.lit("#N/A")).otherwise(F.col("l_extendedprice").cast("string")).alias("txn_sfc"),
        (F.col("l_linenumber") % 4).alias("txn_cnt"),
        F.lit(3.0).alias("est_sch_fee_amt"),
    )
    cleaned = raw.withColumn("txn_sfc", tables.missing_to_null(F.col("txn_sfc")).try_cast("double"))
    return tables.with_unit_costs(cleaned).select(*KEY, "unt_sfc", "unt_est_sch_fee_amt")


QUERIES = {
    "dq_profile": dq_profile,
    "dq_quarantine": dq_quarantine,
    "dq_clean": dq_clean,
    "unknown_defaults": unknown_defaults,
    "null_reject": null_reject,
    "rule_sheet_problems": rule_sheet_problems,
    "rule_fields": rule_fields,
    "rules_merge": rules_merge,
    "scd2_close": scd2_close,
    "scd2_late": scd2_late,
    "scd2_insert": scd2_insert,
    "scd2_merge": scd2_merge,
    "scd2_timeline": scd2_timeline,
    "hierarchy_level": hierarchy_level,
    "update_costs": update_costs,
    "delete_before_reprocess": delete_before_reprocess,
    "replace_month": replace_month,
    "file_revision": file_revision,
    "file_classify": file_classify,
    "reprocess_queue": reprocess_queue,
    "appended_by_name": appended_by_name,
    "export_fill": export_fill,
    "unit_costs": unit_costs,
}

_BAD = """
SELECT *, n % 31 = 0 AS bad_ship,
  n % 37 = 0 OR (n % 37 <> 1 AND dayofyear(l_shipdate) > 366) AS bad_julian, n % 41 = 0 AS bad_part, n % 43 = 0 AS bad_price
FROM (SELECT *, l_orderkey AS n FROM lineitem) q
"""
_MESSAGES = " UNION ALL ".join(
    f"SELECT {_KEY}, 'cannot convert {c} to {kind}' AS message_error FROM ({_BAD}) b WHERE bad_{c}"
    for c, kind in (("ship", "date"), ("julian", "date_julian"), ("part", "int"), ("price", "float"))
)
_HOLES = f"""
SELECT {_KEY}, CASE WHEN l_orderkey % 5 <> 0 THEN l_extendedprice END AS report_amount,
  CASE WHEN l_orderkey % 7 <> 0 THEN 'PE' END AS account_range_country,
  CASE WHEN l_orderkey % 11 <> 0 THEN l_returnflag END AS account_funding_source,
  CASE WHEN l_orderkey % 13 <> 0 THEN CAST(l_partkey AS VARCHAR) END AS account_number,
  CASE WHEN l_orderkey % 10 <> 0 THEN 'on-us' END AS jurisdiction, CASE WHEN l_orderkey % 15 <> 0 THEN 'F' END AS product_id,
  CASE WHEN l_orderkey % 4 <> 0 THEN '17' END AS range_program_id FROM lineitem
"""
_ROWS = """SELECT o_custkey % 200 AS low_range, o_orderstatus AS product, CAST(o_orderdate AS DATE) AS effective,
  CAST(o_orderdate AS DATE) AS app_date_valid, o_orderkey FROM orders"""
_HISTORY = f"""(SELECT *, CASE WHEN o_orderkey % 3 = 1 THEN app_date_valid + 30 END AS app_date_end FROM ({_ROWS}) r WHERE o_orderkey % 3 <> 0)"""
_INCOMING = f"""(SELECT *, CAST(NULL AS DATE) AS app_date_end FROM ({_ROWS}) r WHERE o_orderkey % 3 = 0)"""
_CLOSED = f"""
SELECT h.low_range, h.product, h.effective, h.app_date_valid, h.o_orderkey,
  coalesce(h.app_date_end, (SELECT min(i.app_date_valid) FROM {_INCOMING} i WHERE i.low_range = h.low_range
     AND i.product = h.product AND i.effective > h.effective) - 1) AS app_date_end FROM {_HISTORY} h"""
_LATE = f"""
SELECT i.low_range, i.product, i.effective, i.app_date_valid, i.o_orderkey,
  (SELECT min(h.app_date_valid) FROM {_HISTORY} h WHERE i.low_range = h.low_range
     AND i.product = h.product AND h.effective > i.effective) - 1 AS app_date_end FROM {_INCOMING} i"""
_NEW = f"""NOT EXISTS (SELECT 1 FROM {_HISTORY} h WHERE h.low_range = i.low_range AND h.product = i.product AND h.effective = i.effective)"""

_SQL = {
    "dq_profile": f"SELECT message_error, count(*) AS rows_failed FROM ({_MESSAGES}) m GROUP BY message_error",
    "dq_quarantine": _MESSAGES,
    "dq_clean": f"""
SELECT {_KEY}, CASE WHEN n % 31 = 1 THEN '' ELSE strftime(l_shipdate, '%y%m%d') END AS ship,
  CASE WHEN n % 37 <> 1 THEN '4' || strftime(l_shipdate, '%j') END AS julian, ' ' || CAST(l_partkey AS VARCHAR) AS part
FROM ({_BAD}) b WHERE NOT (bad_ship OR bad_julian OR bad_part OR bad_price)""",
    "unknown_defaults": f"""
SELECT {_KEY}, coalesce(report_amount, 0) AS report_amount, coalesce(account_range_country, 'UNK') AS account_range_country,
  coalesce(account_funding_source, 'UNK') AS account_funding_source, coalesce(account_number, '9999999999999999') AS account_number,
  CASE WHEN jurisdiction IS NULL AND report_amount IS NULL THEN 'UNK' ELSE jurisdiction END AS jurisdiction,
  CASE WHEN product_id IS NULL AND report_amount IS NULL THEN 'UNK' ELSE product_id END AS product_id,
  CASE WHEN product_id IS NULL AND report_amount IS NULL THEN 'UNK' ELSE coalesce(range_program_id, 'UNK') END AS range_program_id
FROM ({_HOLES}) h""",
    "null_reject": f"""
SELECT * FROM ({_HOLES}) h WHERE report_amount IS NOT NULL AND account_range_country IS NOT NULL AND account_funding_source IS NOT NULL
  AND account_number IS NOT NULL AND jurisdiction IS NOT NULL AND product_id IS NOT NULL AND range_program_id IS NOT NULL""",
    "rule_sheet_problems": """
SELECT count(*) FILTER (l_orderkey % 500 = 0) AS missing_jurisdiction, 0 AS missing_valid_from,
  count(*) FILTER (l_partkey % 300 = 0) AS unreadable_rate_variable, 0 AS unreadable_rate_min FROM lineitem""",
    "rule_fields": """
SELECT p_partkey, CASE WHEN p_partkey % 9 <> 0 THEN p_type || ' ' || p_brand END AS fee_category,
  CASE WHEN p_size > 25 THEN p_name ELSE 'S/I' END AS fee_tier FROM part""",
    "rules_merge": """
SELECT p_brand AS jurisdiction, CAST(p_partkey AS VARCHAR) AS rule_id,
  CASE WHEN p_partkey % 3 <> 0 THEN p_retailprice ELSE p_retailprice + 1 END AS rate_variable
FROM part WHERE p_partkey % 3 <> 0 OR p_partkey % 2 = 0""",
    "scd2_close": _CLOSED,
    "scd2_late": _LATE,
    "scd2_insert": f"SELECT * FROM {_INCOMING} i WHERE {_NEW}",
    "scd2_timeline": """
WITH r AS (
  SELECT o_custkey % 200 AS low_range, CASE WHEN o_orderkey % 40 <> 0 THEN o_orderstatus END AS gcms_product,
    strftime(CAST(o_orderdate AS TIMESTAMP) + to_seconds(o_orderkey % 86400), '%Y%m%d%H%M%S') AS effective_timestamp,
    CAST(o_orderdate AS TIMESTAMP) + to_seconds(o_orderkey % 86400) AS app_date_valid, o_orderkey FROM orders
), h AS (
  SELECT *, CASE WHEN o_orderkey % 3 = 1 THEN app_date_valid + INTERVAL 9 HOUR END AS app_date_end FROM r WHERE o_orderkey % 3 <> 0
), n AS (
  SELECT *, CAST(NULL AS TIMESTAMP) AS app_date_end FROM r WHERE o_orderkey % 3 = 0
  UNION ALL SELECT low_range, gcms_product, effective_timestamp, app_date_valid, -o_orderkey, NULL FROM h WHERE o_orderkey % 5 = 1
)
SELECT low_range, gcms_product, effective_timestamp, app_date_valid, o_orderkey, coalesce(app_date_end, (
    SELECT min(n.app_date_valid) FROM n WHERE n.low_range = h.low_range AND n.gcms_product IS NOT DISTINCT FROM h.gcms_product
    AND n.effective_timestamp > h.effective_timestamp) - INTERVAL 1 SECOND) AS app_date_end
FROM h
UNION ALL
SELECT low_range, gcms_product, effective_timestamp, app_date_valid, o_orderkey, (
    SELECT min(h.app_date_valid) FROM h WHERE n.low_range = h.low_range AND n.gcms_product IS NOT DISTINCT FROM h.gcms_product
    AND h.effective_timestamp > n.effective_timestamp) - INTERVAL 1 SECOND AS app_date_end
FROM n WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.low_range = n.low_range AND h.gcms_product = n.gcms_product
  AND h.effective_timestamp = n.effective_timestamp)""",
    "scd2_merge": f"{_CLOSED} UNION ALL SELECT * FROM ({_LATE}) i WHERE {_NEW}",
    "hierarchy_level": """
SELECT c_custkey, c_mktsegment AS file, CAST(c_custkey // 7 AS VARCHAR) AS rollup_to, CAST(c_custkey AS VARCHAR) AS reporting_for,
  CASE WHEN c_custkey // 7 = c_custkey THEN 10 WHEN EXISTS (SELECT 1 FROM customer p WHERE p.c_mktsegment = c.c_mktsegment
    AND p.c_custkey // 7 <> p.c_custkey AND p.c_custkey // 7 = c.c_custkey) THEN 1 ELSE 0 END AS aggregation_level
FROM customer c""",
    "update_costs": """
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 4 = 0 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice FROM orders""",
    "delete_before_reprocess": """
SELECT app_id, app_hash_file, source_amount FROM {txn_text} t
WHERE app_hash_file NOT IN (SELECT 'H' || CAST(s_suppkey AS VARCHAR) || '-' || CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_suppkey % 2 = 0)""",
    "replace_month": """
WITH m AS (SELECT *, strftime(o_orderdate, '%Y%m') AS report_month FROM orders),
f AS (SELECT o_orderpriority, report_month, -count(*) AS rows FROM m WHERE o_orderstatus = 'F' AND report_month >= '200101' GROUP BY ALL)
SELECT o_orderpriority, report_month, count(*) AS rows FROM m
WHERE (o_orderpriority, report_month) NOT IN (SELECT (o_orderpriority, report_month) FROM f) GROUP BY ALL
UNION ALL SELECT * FROM f""",
    "file_revision": """
SELECT o_orderkey, o_custkey % 700 AS code, o_orderpriority AS customer, 'VI' AS brand, o_orderstatus AS file_type,
  CASE WHEN count(*) OVER (PARTITION BY o_custkey % 700, o_orderpriority, o_orderstatus) > 1 THEN 'REVISION' ELSE 'PROCESSED' END AS status
FROM orders""",
    "file_classify": r"""
SELECT page_id, url, CASE WHEN hits > 1 THEN '' WHEN mi + mo + mx > 0 THEN 'MC' WHEN vi + vo > 0 THEN 'VI' ELSE '' END AS brand,
  CASE WHEN hits > 1 THEN 'CHECK' WHEN mi + vi > 0 THEN 'IN' WHEN mo + vo > 0 THEN 'OUT' WHEN mx > 0 THEN 'MC/OTHER' ELSE 'OTHER' END AS filetype
FROM (SELECT *, mi + mo + mx + vi + vo AS hits FROM (SELECT page_id, url,
  CAST(regexp_matches(url, '/fr/|/de/') AS INT) AS mi, CAST(regexp_matches(url, '^http://blog\.') AS INT) AS mo,
  CAST(regexp_matches(url, '\.org/es/') AS INT) AS mx, CAST(regexp_matches(url, '^https://.*/en/\d+') AS INT) AS vi,
  CAST(regexp_matches(url, '^http://.*/en/\d+') AS INT) AS vo FROM pages) a) b""",
    "reprocess_queue": """
SELECT row_number() OVER (ORDER BY type_file, file_date, hash_file) AS number_file, hash_file, type_file, header_date
FROM (SELECT o_orderkey AS hash_file, CASE o_custkey % 3 WHEN 0 THEN 'IN' WHEN 1 THEN 'OUT' END AS type_file,
        CAST(o_orderdate AS DATE) AS file_date, strftime(o_orderdate, '%Y%m%d') AS header_date
      FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority = '1-URGENT' AND o_custkey % 3 <> 2
        AND CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1999-12-31') q""",
    "appended_by_name": """
SELECT o_orderkey, o_custkey, o_totalprice, 'old' AS note FROM orders
UNION ALL SELECT o_orderkey, NULL, o_totalprice * 2, NULL FROM orders""",
    "export_fill": f"""
SELECT {_KEY}, CASE WHEN l_orderkey % 3 <> 0 THEN l_linenumber ELSE 255 END AS bus_id,
  CASE WHEN l_orderkey % 4 <> 0 THEN l_extendedprice ELSE 0 END AS txn_amt,
  CASE WHEN l_orderkey % 5 <> 0 THEN l_linenumber ELSE 0 END AS txn_cnt,
  CASE WHEN l_orderkey % 7 <> 0 THEN CAST(l_partkey AS VARCHAR) ELSE '9999999999999999' END AS mct_cd FROM lineitem""",
    "unit_costs": f"""
SELECT {_KEY}, CASE WHEN l_linenumber <> 7 AND l_linenumber % 4 <> 0 THEN round_even(l_extendedprice / (l_linenumber % 4), 6) END AS unt_sfc,
  CASE WHEN l_linenumber % 4 <> 0 THEN round_even(3e0 / (l_linenumber % 4), 6) END AS unt_est_sch_fee_amt FROM lineitem""",
}
ORACLE = {k: oracle(v) for k, v in _SQL.items()}
