"""Audit, reconciliation, scheme fees, analytics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clearspan.catalogue.enrichment import calculated_bitmap, calculated_online, calculated_text, money
from clearspan.catalogue.inputs import Source, oracle
from clearspan.catalogue.interchange import interchange_bitmap, interchange_online, interchange_text
from clearspan.catalogue.oracles import ORACLE_INPUTS
from clearspan.operators.fx import attach_rate, brand_rates, to_report_currency
from clearspan.plans import analytics, audit, reconcile, schemefee, schememonth
from clearspan.session import checkpointed

EXECUTION, MONTH = "run1", "199801"


def exact(name: str, places: int = 6) -> Column:
    """Money as a decimal, so that sums do not depend on their order."""
    return F.round(F.col(name), places).cast(f"decimal(20,{places})").alias(name)


# --- audit -------------------------------------------------------------------------


def _ledger(s: Source) -> DataFrame:
    return s.orders.select(
        (F.col("o_orderkey") % 4000).alias("code"),
        F.lit("AUTOMOBILE").alias("customer"),
        F.to_date("o_orderdate").alias("file_date"),
        F.when(F.col("o_custkey") % 2 == 0, "IN").otherwise("OUT").alias("file_type"),
        F.when(F.col("o_orderstatus") == "P", "REVISION").otherwise("PROCESSED").alias("description_status"),
        F.date_add("o_orderdate", (F.col("o_orderkey") % 5).cast("int")).alias("process_date"),
        F.col("o_orderkey").alias("execution_id"),
        (F.col("o_custkey") % 100).alias("records_number"),
    )


def load_audit(spark: SparkSession, sf: str) -> DataFrame:
    s = Source(spark, sf)
    online = s.txn_online.select("app_processing_date", "app_type_file")
    return audit.load_audit(
        [s.txn_text.select("app_processing_date", "app_type_file"), online, s.elements.select("app_processing_date", "app_type_file")],
        _ledger(s),
    )


# --- reconciliation -------------------------------------------------------------------


def settlement_lines(s: Source) -> DataFrame:
    """Settlement report lines of the text brand, one per line item."""
    n, p = F.col("l_orderkey"), F.col("l_partkey")
    nation = (F.col("l_suppkey") % 25).cast("int")
    return s.lineitem.select(
        F.to_date("l_shipdate").alias("app_processing_date"),
        F.lit(130).alias("report_type"),
        F.when(n % 9 == 0, 1).otherwise(0).alias("aggregation_level"),
        F.lit("x").alias("summary_level"),
        F.when(n % 8 == 0, "00").otherwise("01").alias("jurisdiction_code"),
        F.when(n % 2 == 0, "2").otherwise("1").alias("business_mode"),
        (100 + nation).cast("string").alias("source_country_code"),
        F.when(n % 4 < 2, (100 + nation).cast("string")).otherwise((100 + (nation + 6) % 25).cast("string")).alias(
            "destination_country_code"
        ),
        F.element_at(F.array(*[F.lit(x) for x in ("alpha ", "beta", "gamma", "delta", " ")]), (p % 5 + 1).cast("int")).alias(
            "fee_level_descriptor"
        ),
        F.element_at(F.array(*[F.lit(x) for x in ("100", "300", "190", "310", "519", "220")]), (p % 6 + 1).cast("int")).alias(
            "business_transaction_type"
        ),
        F.element_at(F.array(*[F.lit(x) for x in ("2", "1", "7", "3")]), (n % 4 + 1).cast("int")).alias(
            "business_transaction_cycle"
        ),
        F.when(F.col("l_linenumber") == 7, "Y").otherwise("N").alias("reversal_indicator"),
        F.when(F.col("l_linenumber") == 6, "Y").otherwise(" ").alias("return_indicator"),
        F.when(F.col("l_linenumber") == 5, "  ").otherwise(F.col("l_quantity").cast("int").cast("string")).alias("count"),
        F.lit("840").alias("settlement_currency_code"),
        F.round("l_extendedprice", 2).cast("decimal(20,6)").alias("interchange_amount"),
        F.round("l_tax", 2).cast("decimal(20,6)").alias("fee_debits"),
        F.round("l_discount", 2).cast("decimal(20,6)").alias("fee_credits"),
    )


def _settlement(s: Source, only_type: str | None = None) -> DataFrame:
    return reconcile.settlement_report_text(
        settlement_lines(s), s.countries, s.currencies, s.text_types, s.text_cycles, "2", only_type
    )


def settlement_report(spark: SparkSession, sf: str) -> DataFrame:
    out = _settlement(Source(spark, sf))
    return out.select(
        *[c for c in out.columns if not c.endswith("amount")],
        F.col("settlement_amount").cast("double").alias("settlement_amount"),
        F.col("settlement_irf_amount").cast("double").alias("settlement_irf_amount"),
    )


def settlement_report_online(spark: SparkSession, sf: str) -> DataFrame:
    out = _settlement(Source(spark, sf), "310")
    return out.select(
        "app_processing_date", "jurisdiction_assigned", "fee_descriptor", "business_transaction_type",
        "business_transaction_cycle", "reversal_flag", "settlement_count",
        F.col("settlement_amount").cast("double").alias("settlement_amount"),
    )


_TEXT_KEYS = [
    "jurisdiction_assigned",
    "business_mode",
    "fee_descriptor",
    "business_transaction_type",
    "business_transaction_cycle",
    "reversal_flag",
]


def _assigned(s: Source) -> DataFrame:
    """Computed interchange in local currency with the names the settlement report uses."""
    types = s.text_types.select(
        F.col("business_transaction_type_id").alias("business_transaction_type"), F.col("short_description").alias("type_name")
    )
    cycles = s.text_cycles.select(
        F.col("business_transaction_cycle_id").alias("business_transaction_cycle"), F.col("short_description").alias("cycle_name")
    )
    names = s.rules_text.select("region_country_code", "rule_id", F.trim("fee_descriptor").alias("fee_descriptor"))
    owner = s.customers.select(F.col("code").alias("app_customer_code"), "local_currency_code")
    rows = (
        interchange_text(s)
        .join(names, ["region_country_code", "rule_id"])
        .join(owner, "app_customer_code")
        .join(types, "business_transaction_type", "left")
        .join(cycles, "business_transaction_cycle", "left")
    )
    rows = attach_rate(
        rows, brand_rates(s.rates, "VISA"), "_local", F.col("purchase_date"), F.col("currency_transaction"),
        F.col("local_currency_code"), from_field="currency_from_code", same=F.lit(False),
    )
    rate = F.coalesce("_local", F.lit(1.0))
    return rows.select(
        F.col("purchase_date").alias("app_processing_date"),
        "jurisdiction_assigned",
        "business_mode",
        "fee_descriptor",
        F.col("type_name").alias("business_transaction_type"),
        F.col("cycle_name").alias("business_transaction_cycle"),
        F.col("reversal_indicator").alias("reversal_flag"),
        F.round(F.col("source_amount") * rate, 6).cast("decimal(20,6)").alias("local_amount"),
        F.round(F.col("calculated_value") * rate, 8).cast("decimal(24,8)").alias("local_fee"),
    )


def _reconciled(s: Source) -> DataFrame:
    ours = reconcile.interchange_report(_assigned(s), ["app_processing_date", *_TEXT_KEYS])
    # whole-history match: the day is carried, not joined, so both sides are summed over days first
    days = [c for c in ours.columns if c not in ("app_processing_date",)]
    total = ours.groupBy(*_TEXT_KEYS).agg(
        F.max("app_processing_date").alias("app_processing_date"),
        *[F.sum(c).alias(c) for c in days if c not in _TEXT_KEYS],
    )
    theirs = (
        _settlement(s)
        .groupBy(*_TEXT_KEYS)
        .agg(
            F.max("app_processing_date").alias("app_processing_date"),
            F.sum("settlement_count").alias("settlement_count"),
            F.sum("settlement_amount").alias("settlement_amount"),
            F.sum("settlement_irf_amount").alias("settlement_irf_amount"),
        )
    )
    ours_d = total.withColumns({c: F.col(c).cast("double") for c in ("interchange_amount", "interchange_irf_amount")})
    theirs_d = theirs.withColumns({c: F.col(c).cast("double") for c in ("settlement_amount", "settlement_irf_amount")})
    return reconcile.reconcile(
        theirs_d, ours_d, _TEXT_KEYS, ["business_transaction_type", "business_transaction_cycle"]
    )


def reconciliation(spark: SparkSession, sf: str) -> DataFrame:
    s = Source(spark, sf)
    out = reconcile.with_rule_order(
        _reconciled(s), reconcile.rule_order(s.rules_text), "jurisdiction_assigned", "fee_descriptor"
    )
    return out


def reconcile_summary(spark: SparkSession, sf: str) -> DataFrame:
    out = reconcile.reconciliation_summary(_reconciled(Source(spark, sf)))
    return out.withColumn("absolute_error", F.round("absolute_error", 8))


def reconcile_bitmap(spark: SparkSession, sf: str) -> DataFrame:
    s = Source(spark, sf)
    keys = ["jurisdiction", "business_mode", "ird", "business_transaction_type", "reversal_flag"]
    types = s.bitmap_types.select(
        F.col("business_transaction_type_id").alias("_t"), F.col("short_description").alias("business_transaction_type")
    )
    ours = (
        interchange_bitmap(s)
        .filter(F.col("rule_id").isNotNull())
        .join(types, F.left("processing_code", F.lit(2)) == F.col("_t"), "left")
        .select(
            F.lit("2001-01-01").cast("date").alias("app_processing_date"),
            "jurisdiction",
            "business_mode",
            "ird",
            "business_transaction_type",
            F.when(F.upper(F.left("message_reversal_indicator", F.lit(1))) == "R", 1).otherwise(0).alias("reversal_flag"),
            exact("amount_transaction", 4).alias("local_amount"),
            F.round("calculated_value", 8).cast("decimal(24,8)").alias("local_fee"),
        )
    )
    n = F.col("l_orderkey")
    totals = s.lineitem.select(
        F.lit("2001-01-01").cast("date").alias("app_processing_date"),
        F.lit("1644").alias("app_message_type"),
        F.lit(685).alias("function_code"),
        F.lit("I").alias("reconciled_member_activity"),
        F.lit("1240").alias("reconciled_transaction_function_1"),
        F.when(n % 5 == 0, "00399").when(n % 5 == 1, "00199").alias("reconciled_file"),
        F.element_at(F.array(*[F.lit(x) for x in ("4", "1", "2", "8")]), (n % 4 + 1).cast("int")).alias("reconciled_business_activity_2"),
        F.element_at(F.array(*[F.lit(x) for x in ("75", "80", "64", " ")]), (F.col("l_partkey") % 4 + 1).cast("int")).alias(
            "reconciled_business_activity_4"
        ),
        F.element_at(F.array(F.lit("00"), F.lit("20"), F.lit("77")), (n % 3 + 1).cast("int")).alias("reconciled_processing_code"),
        F.when(F.col("l_linenumber") == 1, "R").otherwise("O").alias("original_reversal_totals_indicator"),
        F.col("l_linenumber").alias("total_transaction_number"),
        exact("l_extendedprice", 4).alias("amount_net_transaction"),
        exact("l_tax", 4).alias("amount_net_fee"),
    )
    theirs = reconcile.settlement_report_bitmap(totals, s.bitmap_types, "I")
    return _doubles(
        reconcile.reconcile(
            _doubles(theirs),
            _doubles(reconcile.interchange_report(ours, ["app_processing_date", *keys])),
            keys,
            ["business_transaction_type"],
        )
    )


def _both_sides(s: Source, only_type: str | None = None) -> DataFrame:
    """Settlement rows of issuing and acquiring reports."""
    report = settlement_lines(s)
    masters = (s.countries, s.currencies, s.text_types, s.text_cycles)
    return reconcile.settlement_report_text(report, *masters, "2", only_type).unionByName(
        reconcile.settlement_report_text(report, *masters, "1", only_type)
    )


def _named(rows: DataFrame, s: Source) -> DataFrame:
    """Assigned text records with the names that the settlement report uses."""
    types = s.text_types.select(F.col("business_transaction_type_id").alias("business_transaction_type"), F.col("short_description").alias("type_name"))
    cycles = s.text_cycles.select(F.col("business_transaction_cycle_id").alias("business_transaction_cycle"), F.col("short_description").alias("cycle_name"))
    names = s.rules_text.select("region_country_code", "rule_id", F.trim("fee_descriptor").alias("fee_descriptor"))
    return (
        rows.join(names, ["region_country_code", "rule_id"])
        .join(types, "business_transaction_type", "left")
        .join(cycles, "business_transaction_cycle", "left")
        .drop("business_transaction_type", "business_transaction_cycle")
        .withColumnsRenamed({"type_name": "business_transaction_type", "cycle_name": "business_transaction_cycle", "reversal_indicator": "reversal_flag"})
    )


_OPTIONAL = ["business_transaction_type", "business_transaction_cycle"]


def reconcile_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Clearing records of both sides against the reports of each day, numbered after the ids in use."""
    s = Source(spark, sf)
    rows = _named(interchange_text(s).drop("app_processing_date").withColumnRenamed("purchase_date", "app_processing_date"), s)
    ours = reconcile.in_local_currency(
        rows, s.customers, s.rates, "VISA", F.col("app_processing_date"), F.col("currency_transaction"), F.col("source_amount"), F.col("calculated_value")
    )
    out = reconcile.reconcile_daily(_both_sides(s), ours, _TEXT_KEYS, _OPTIONAL)
    order = [F.asc_nulls_first(c) for c in ("report_processing_date", *[f"{side}_{k}" for side in ("settlement", "interchange") for k in _TEXT_KEYS])]
    last = reconcile.last_report_id(s.orders.select(F.col("o_orderkey").alias("app_id")))
    return _doubles(reconcile.with_report_ids(out, order, last))


def reconcile_daily_online(spark: SparkSession, sf: str) -> DataFrame:
    """Online records of both sides against the reports of each day."""
    s = Source(spark, sf)
    rows = _named(interchange_online(s).drop("app_processing_date").withColumnRenamed("local_transaction_date", "app_processing_date"), s)
    ours = reconcile.in_local_currency(
        rows, s.customers, s.rates, "VISA", F.col("app_processing_date"), F.col("currency_transaction"), F.col("amount_transaction"), F.col("calculated_value")
    )
    return _doubles(reconcile.reconcile_daily(_both_sides(s, "310"), ours, _TEXT_KEYS, _OPTIONAL))


def reconcile_daily_bitmap(spark: SparkSession, sf: str) -> DataFrame:
    """Bitmap records in local currency against the totals of both members of each day."""
    s = Source(spark, sf)
    keys = ["jurisdiction", "business_mode", "ird", "business_transaction_type", "reversal_flag"]
    types = s.bitmap_types.select(
        F.col("business_transaction_type_id").alias("_t"), F.col("short_description").alias("business_transaction_type")
    )
    rows = (
        interchange_bitmap(s)
        .filter(F.col("rule_id").isNotNull())
        .join(types, F.left("processing_code", F.lit(2)) == F.col("_t"), "left")
        .withColumn("app_processing_date", F.to_date("date_and_time_local_transaction"))
        .withColumn("reversal_flag", F.when(F.upper(F.left("message_reversal_indicator", F.lit(1))) == "R", 1).otherwise(0))
    )
    ours = reconcile.in_local_currency(
        rows, s.customers, s.rates, "MasterCard", F.col("app_processing_date"), F.col("currency_transaction"), F.col("amount_transaction"),
        F.col("calculated_value"),
    )
    n = F.col("l_orderkey")
    totals = s.lineitem.select(
        F.to_date("l_shipdate").alias("app_processing_date"),
        F.lit("1644").alias("app_message_type"),
        F.lit(685).alias("function_code"),
        F.when(F.col("l_linenumber") % 2 == 0, "I").otherwise("A").alias("reconciled_member_activity"),
        F.lit("1240").alias("reconciled_transaction_function_1"),
        F.when(n % 5 == 0, "00399").when(n % 5 == 1, "00199").alias("reconciled_file"),
        F.element_at(F.array(*[F.lit(x) for x in ("4", "1", "2", "8")]), (n % 4 + 1).cast("int")).alias("reconciled_business_activity_2"),
        F.element_at(F.array(*[F.lit(x) for x in ("75", "80", "64", " ")]), (F.col("l_partkey") % 4 + 1).cast("int")).alias(
            "reconciled_business_activity_4"
        ),
        F.element_at(F.array(F.lit("00"), F.lit("20"), F.lit("77")), (n % 3 + 1).cast("int")).alias("reconciled_processing_code"),
        F.when(F.col("l_linenumber") == 1, "R").otherwise("O").alias("original_reversal_totals_indicator"),
        F.col("l_linenumber").alias("total_transaction_number"),
        exact("l_extendedprice", 4).alias("amount_net_transaction"),
        exact("l_tax", 4).alias("amount_net_fee"),
    )
    theirs = reconcile.settlement_report_bitmap(totals, s.bitmap_types, "I").unionByName(reconcile.settlement_report_bitmap(totals, s.bitmap_types, "A"))
    return _doubles(reconcile.reconcile_daily(theirs, ours, keys, ["business_transaction_type"]))


def _doubles(df: DataFrame) -> DataFrame:
    return df.select(
        *[F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f.name) for f in df.schema]
    )


def report_ids(spark: SparkSession, sf: str) -> DataFrame:
    s = Source(spark, sf)
    report = _settlement(s).select("jurisdiction_assigned", "fee_descriptor", "app_processing_date", "business_transaction_type",
                                   "business_transaction_cycle", "reversal_flag", "settlement_count")
    order = [F.col(c) for c in report.columns]
    return reconcile.with_report_ids(report, order, 100)


# --- scheme fees -----------------------------------------------------------------------


def _detail_text(s: Source) -> DataFrame:
    return schemefee.detail_text(
        calculated_text(s), s.customers, s.currencies, s.text_types, s.products, s.rates, EXECUTION, MONTH, True
    )


_DETAIL_SHOWN = [
    "app_id", "app_hash_file", "table_description", "account_number", "account_funding_source", "account_range_country",
    "product_id", "range_program_id", "jurisdiction", "business_transaction_type_id", "reversal_indicator",
    "currency_local_indicator", "motoec_indicator", "merchant_country_code", "bank_country", "business_mode_id",
    "exchange_rate", "report_currency",
]


def scheme_fee_detail(spark: SparkSession, sf: str) -> DataFrame:
    return _detail_text(Source(spark, sf)).select(*_DETAIL_SHOWN, money("report_amount"), money("settlement_amount"))


def scheme_fee_detail_online(spark: SparkSession, sf: str) -> DataFrame:
    s = Source(spark, sf)
    out = schemefee.detail_online(
        calculated_online(s), s.customers, s.currencies, s.text_types, s.products, s.rates, EXECUTION, MONTH, True
    )
    return out.select(*_DETAIL_SHOWN, money("report_amount"), money("settlement_amount"))


def scheme_fee_detail_bitmap(spark: SparkSession, sf: str) -> DataFrame:
    s = Source(spark, sf)
    out = schemefee.detail_bitmap(
        calculated_bitmap(s), s.customers, s.currencies, s.bitmap_types, s.products, s.rates, EXECUTION, MONTH, True
    )
    return out.select(*_DETAIL_SHOWN, money("report_amount"))


def range_open_end_lookup(spark: SparkSession, sf: str) -> DataFrame:
    s = Source(spark, sf)
    detail = s.txn_text.select(
        "app_id", "app_hash_file", "app_customer_code", F.lit("VISA").alias("transaction_brand"),
        F.col("account_number").cast("string").alias("account_number"), F.lit("").alias("switch_code"),
    )
    return schemefee.with_switch_codes(detail, s.switch_ranges).select("app_id", "app_hash_file", "switch_code")


def size_tickets(spark: SparkSession, sf: str) -> DataFrame:
    s = Source(spark, sf)
    out = schemefee.with_size_tickets(_detail_text(s), s.tickets, s.rates)
    return out.select("app_id", "app_hash_file", "table_description", "size_ticket")


def report_currency(spark: SparkSession, sf: str) -> DataFrame:
    s = Source(spark, sf)
    rows = s.txn_text.select(
        "app_id", "app_hash_file", "app_customer_code", "app_processing_date", F.lit("VISA").alias("transaction_brand"),
        F.lit("EUR").alias("settlement_currency"), F.col("source_amount").alias("settlement_amount"),
    )
    return to_report_currency(rows, s.rates, s.customers, 4).select(
        "app_id", "app_hash_file", "exchange_rate", "report_amount", "report_currency"
    )


def _cube(s: Source) -> DataFrame:
    detail = _detail_text(s)
    return schemefee.monthly_cube(detail.withColumn("report_amount", exact("report_amount", 4)))


def monthly_cube(spark: SparkSession, sf: str) -> DataFrame:
    return _doubles(_cube(Source(spark, sf)))


def surrogate_ids(spark: SparkSession, sf: str) -> DataFrame:
    return _doubles(schemefee.monthly_report(_cube(Source(spark, sf)), "hash", "1998-01-01")).drop(
        "app_processing_date", "app_hash_file", "app_type_file"
    )


def legacy_map(spark: SparkSession, sf: str) -> DataFrame:
    s = Source(spark, sf)
    return _doubles(schemefee.legacy_report(_cube(s), s.products, s.funding, s.countries))


def cost_pushback(spark: SparkSession, sf: str) -> DataFrame:
    s = Source(spark, sf)
    # the detail of a month is a stored table
    detail = checkpointed(_detail_text(s))
    report = schemefee.monthly_cube(detail).withColumns(
        {
            "transaction_scheme_fee_cost": F.col("transaction_count") * 0.5,
            "unitary_scheme_fee_cost": F.lit(0.5),
            "estimated_scheme_fee_amount": F.col("transaction_count") * 0.25,
            "unitary_estimated_scheme_fee_amount": F.lit(0.25),
        }
    )
    out = schemefee.push_back_costs(detail, report)
    return out.select(
        "app_id", "app_hash_file", "table_description", "transaction_scheme_fee_cost", "unitary_scheme_fee_cost",
        "estimated_scheme_fee_cost", "unitary_estimated_scheme_fee_cost",
    )


def detail_count_check(spark: SparkSession, sf: str) -> DataFrame:
    s = Source(spark, sf)
    detail = _detail_text(s)
    return schemefee.count_check(detail, schemefee.monthly_cube(detail))


def returned_costs(spark: SparkSession, sf: str) -> DataFrame:
    s = Source(spark, sf)
    report = s.orders.select(
        F.col("o_orderkey").alias("app_id"),
        *[F.lit(0.0).alias(c) for c in schemefee.COSTS],
    )
    returned = s.orders.filter(F.col("o_orderstatus") != "P").select(
        F.col("o_orderkey").alias("app_id"),
        F.col("o_totalprice").alias("txn_sfc"),
        F.lit(None).cast("double").alias("est_sch_fee_amt"),
        F.lit(0.5).alias("unt_sfc"),
        F.lit(0.75).alias("unt_est_sch_fee_amt"),
    )
    return schemefee.apply_returned_costs(report, returned)


def _month(spark: SparkSession, sf: str) -> schememonth.Month:
    """The month's chain over all brands; costs come back for groups without reversals."""
    s = Source(spark, sf).stored("txn_text")
    masters = (s.customers, s.currencies)
    frames = [
        schemefee.detail_text(calculated_text(s), *masters, s.text_types, s.products, s.rates, EXECUTION, MONTH, None),
        schemefee.detail_online(calculated_online(s), *masters, s.text_types, s.products, s.rates, EXECUTION, MONTH, None),
        schemefee.detail_bitmap(calculated_bitmap(s), *masters, s.bitmap_types, s.products, s.rates, EXECUTION, MONTH, None),
    ]

    def returned(report: DataFrame) -> DataFrame:
        n = F.col("transaction_count")
        return report.filter("reversal_indicator = 0").select(
            "app_id", (n * 0.5).alias("txn_sfc"), (n * 0.25).alias("est_sch_fee_amt"), F.lit(0.5).alias("unt_sfc"), F.lit(0.25).alias("unt_est_sch_fee_amt")
        )

    return schememonth.run_month(
        frames, s.switch_ranges_all, s.tickets, s.rates, s.products, s.funding, s.countries, returned, EXECUTION, MONTH, "1998-01-01",
        spent=list(s.folders.values()),
    )


def scheme_fee_month(spark: SparkSession, sf: str) -> DataFrame:
    return _month(spark, sf).detail.select(
        "app_id", "app_hash_file", "table_description", "transaction_brand", "business_mode_id", "switch_code", "size_ticket",
        "account_funding_source", "range_program_id", *schemefee.COSTS.values(),
    )


def scheme_fee_month_report(spark: SparkSession, sf: str) -> DataFrame:
    return _month(spark, sf).legacy.withColumn("txn_amt", F.round("txn_amt", 4))


def scheme_fee_month_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _month(spark, sf).summary


# --- analytics -----------------------------------------------------------------------------


def _costs(s: Source) -> DataFrame:
    """Stored unit costs: one row per clearing transaction, one more for outgoing ones."""
    rows = s.txn_text.filter(F.col("transaction_code").isin(*schemefee.CLEARING_CODES))
    kinds = F.when(
        F.col("app_type_file") == "OUT", F.array(F.lit(schemefee.LABELS["acquiring"]), F.lit(schemefee.LABELS["text_mirror"]))
    ).otherwise(F.array(F.lit(schemefee.LABELS["issuing"])))
    mirror = F.col("table_description") == schemefee.LABELS["text_mirror"]
    return rows.select(
        "app_customer_code", "app_type_file", "app_processing_date", "app_hash_file", "app_id",
        F.lit("VISA").alias("transaction_brand"), F.explode(kinds).alias("table_description"),
    ).withColumn("unitary_scheme_fee_cost", F.col("app_id") % 100 / 100 + F.when(mirror, 1.0).otherwise(0.0))


def _shown(view: DataFrame) -> DataFrame:
    return view.withColumns(
        {c: F.round(c, 8) for c in ("transaction_amount", "interchange_fees_amount", "scheme_fees_amount")}
    )


def analytics_text(spark: SparkSession, sf: str) -> DataFrame:
    s = Source(spark, sf).stored("txn_text")
    return _shown(
        analytics.text_transactions(
            interchange_text(s), s.countries, s.customers, s.rules_text, s.bin_products, s.rates, _costs(s), mirrored=True,
            steps=s.steps("txn_text"),
        )
    )


def analytics_online(spark: SparkSession, sf: str) -> DataFrame:
    s = Source(spark, sf).stored("txn_text")
    costs = s.txn_online.select(
        "app_customer_code", "app_type_file", "app_processing_date", "app_hash_file", "app_id",
        F.lit("VISA").alias("transaction_brand"), F.lit("VISA SMS").alias("table_description"),
        (F.col("app_id") % 100 / 100).alias("unitary_scheme_fee_cost"),
    ).filter(F.col("app_customer_code") != "BUILDING")
    return _shown(
        analytics.online_transactions(
            interchange_online(s), s.countries, s.customers, s.rules_text, s.bin_products, s.rates, costs,
            steps=s.steps("txn_text"),
        )
    )


def analytics_bitmap(spark: SparkSession, sf: str) -> DataFrame:
    s = Source(spark, sf).stored("txn_text")
    rows = interchange_bitmap(s)
    costs = s.elements.select(
        "app_customer_code", "app_type_file", "app_processing_date", "app_hash_file", "app_id",
        F.lit("MasterCard").alias("transaction_brand"), F.lit("MASTERCARD ISS AND ACQ").alias("table_description"),
        (F.col("app_id") % 100 / 100).alias("unitary_scheme_fee_cost"),
    ).filter((F.col("app_customer_code") != "BUILDING") & (F.col("app_id") > 0))
    return _shown(
        analytics.bitmap_transactions(rows, s.countries, s.customers, s.bitmap_bin_products, s.rates, costs, steps=s.steps("txn_text"))
    )


def analytics_online_mirrored(spark: SparkSession, sf: str) -> DataFrame:
    """Online records, on-us ones from both sides; those without a stored cost are left out."""
    s = Source(spark, sf).stored("txn_text")
    kinds = F.when(
        F.col("issuer_acquirer_indicator") == "A", F.array(F.lit(schemefee.LABELS["online"]), F.lit(schemefee.LABELS["online_mirror"]))
    ).otherwise(F.array(F.lit(schemefee.LABELS["online"])))
    costs = _two_sided_costs(s.txn_online, "VISA", kinds, schemefee.LABELS["online_mirror"])
    return _shown(
        analytics.online_transactions(
            interchange_online(s), s.countries, s.customers, s.rules_text, s.bin_products, s.rates, costs, mirrored=True,
            steps=s.steps("txn_text"),
        )
    )


def analytics_bitmap_mirrored(spark: SparkSession, sf: str) -> DataFrame:
    """Bitmap records, on-us ones from both sides; those without a stored cost are left out."""
    s = Source(spark, sf).stored("txn_text")
    kinds = F.when(
        F.col("app_type_file") == "OUT", F.array(F.lit(schemefee.LABELS["bitmap"]), F.lit(schemefee.LABELS["bitmap_mirror"]))
    ).otherwise(F.array(F.lit(schemefee.LABELS["bitmap"])))
    costs = _two_sided_costs(s.elements.filter("app_id > 0"), "MasterCard", kinds, schemefee.LABELS["bitmap_mirror"])
    return _shown(
        analytics.bitmap_transactions(
            interchange_bitmap(s), s.countries, s.customers, s.bitmap_bin_products, s.rates, costs, mirrored=True,
            steps=s.steps("txn_text"),
        )
    )


def _two_sided_costs(rows: DataFrame, brand: str, kinds: Column, mirror: str) -> DataFrame:
    """Stored unit costs of the records, and of their mirror rows."""
    listed = rows.filter(F.col("app_customer_code") != "BUILDING").select(
        "app_customer_code", "app_type_file", "app_processing_date", "app_hash_file", "app_id", F.lit(brand).alias("transaction_brand"),
        F.explode(kinds).alias("table_description"),
    )
    extra = F.when(F.col("table_description") == mirror, 1.0).otherwise(0.0)
    return listed.withColumn("unitary_scheme_fee_cost", F.col("app_id") % 100 / 100 + extra)


QUERIES = {
    "load_audit": load_audit,
    "settlement_report": settlement_report,
    "settlement_report_online": settlement_report_online,
    "reconcile": reconciliation,
    "reconcile_summary": reconcile_summary,
    "reconcile_bitmap": reconcile_bitmap,
    "report_ids": report_ids,
    "reconcile_daily": reconcile_daily,
    "reconcile_daily_online": reconcile_daily_online,
    "reconcile_daily_bitmap": reconcile_daily_bitmap,
    "scheme_fee_detail": scheme_fee_detail,
    "scheme_fee_detail_online": scheme_fee_detail_online,
    "scheme_fee_detail_bitmap": scheme_fee_detail_bitmap,
    "range_open_end_lookup": range_open_end_lookup,
    "size_tickets": size_tickets,
    "report_currency": report_currency,
    "monthly_cube": monthly_cube,
    "surrogate_ids": surrogate_ids,
    "legacy_map": legacy_map,
    "cost_pushback": cost_pushback,
    "detail_count_check": detail_count_check,
    "returned_costs": returned_costs,
    "scheme_fee_month": scheme_fee_month,
    "scheme_fee_month_report": scheme_fee_month_report,
    "scheme_fee_month_summary": scheme_fee_month_summary,
    "analytics_text": analytics_text,
    "analytics_online": analytics_online,
    "analytics_bitmap": analytics_bitmap,
    "analytics_online_mirrored": analytics_online_mirrored,
    "analytics_bitmap_mirrored": analytics_bitmap_mirrored,
}

_SETTLEMENT_ROWS = """
SELECT q.*, CASE WHEN jc = '00' THEN '9' WHEN src <> dst THEN c.visa_region_code ELSE c.country_code END AS jurisdiction_assigned,
  ty.short_description AS business_transaction_type, cy.short_description AS business_transaction_cycle
FROM (SELECT CAST(l_shipdate AS DATE) AS app_processing_date, CASE WHEN l_orderkey % 8 = 0 THEN '00' ELSE '01' END AS jc,
    100 + l_suppkey % 25 AS src, CASE WHEN l_orderkey % 4 < 2 THEN 100 + l_suppkey % 25 ELSE 100 + (l_suppkey % 25 + 6) % 25 END AS dst,
    trim(CASE l_partkey % 5 WHEN 0 THEN 'alpha ' WHEN 1 THEN 'beta' WHEN 2 THEN 'gamma' WHEN 3 THEN 'delta' ELSE ' ' END) AS fee_descriptor,
    CASE l_partkey % 6 WHEN 0 THEN '100' WHEN 1 THEN '300' WHEN 2 THEN '190' WHEN 3 THEN '310' WHEN 4 THEN '519' ELSE '220' END AS type_code,
    CASE l_orderkey % 4 WHEN 0 THEN '2' WHEN 1 THEN '1' WHEN 2 THEN '7' ELSE '3' END AS cycle_code,
    CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END AS reversal_flag,
    CASE WHEN l_linenumber = 5 THEN 0 ELSE CAST(l_quantity AS INT) END AS n,
    CAST(l_extendedprice AS DECIMAL(20,6)) AS amount, CAST(l_tax AS DECIMAL(20,6)) + CAST(l_discount AS DECIMAL(20,6)) AS irf
  FROM lineitem WHERE l_orderkey % 2 = 0 AND l_orderkey % 9 <> 0 AND l_linenumber <> 6 AND l_partkey % 5 <> 4) q
LEFT JOIN {countries} c ON c.country_numeric = dst
LEFT JOIN {text_types} ty ON ty.business_transaction_type_code = type_code
LEFT JOIN {text_cycles} cy ON cy.business_transaction_cycle_code = cycle_code
"""
_CLEARING = "CAST(type_code AS INT) < 519 AND cycle_code NOT IN ('7', '8', '0')"

_OURS = """
SELECT f.jurisdiction_assigned, f.business_mode, trim(f.fee_descriptor) AS fee_descriptor, ty.short_description AS business_transaction_type,
  cy.short_description AS business_transaction_cycle, f.reversal_indicator AS reversal_flag, f.purchase_date,
  CAST(round(f.source_amount * coalesce(x.exchange_value, 1e0), 6) AS DECIMAL(20,6)) AS local_amount,
  CAST(round(f.calculated_value * coalesce(x.exchange_value, 1e0), 8) AS DECIMAL(24,8)) AS local_fee
FROM {o_fee} f
LEFT JOIN {text_types} ty ON ty.business_transaction_type_id = f.business_transaction_type
LEFT JOIN {text_cycles} cy ON cy.business_transaction_cycle_id = f.business_transaction_cycle
LEFT JOIN {rates} x ON x.app_processing_date = f.purchase_date AND x.brand = 'VISA'
  AND x.currency_from_code = f.source_currency_code AND x.currency_to = f.local_currency_code
WHERE f.rule_id IS NOT NULL
"""
_RECONCILED = f"""
SELECT *, settled - ours AS diff_count, coalesce(settlement_amount, 0e0) - coalesce(interchange_amount, 0e0) AS diff_amount,
  coalesce(settlement_irf_amount, 0e0) - coalesce(interchange_irf_amount, 0e0) AS diff_irf_amount, abs(ours - settled) AS diff_count_abs,
  least(ours, settled) AS metric_count, greatest(ours - settled, 0) AS metric_excess_count,
  CASE WHEN coalesce(settlement_count, 1) <> 0 THEN CAST(abs(ours - settled) - greatest(ours - settled, 0) AS DOUBLE)
    / CAST(coalesce(settlement_count, 1) AS DOUBLE) END AS absolute_error
FROM (
SELECT a.*, b.*, coalesce(settlement_count, 0) AS settled, coalesce(interchange_count, 0) AS ours,
  coalesce(day_a, day_b) AS report_processing_date
FROM (SELECT jurisdiction_assigned AS settlement_jurisdiction_assigned, 'issuing' AS settlement_business_mode, fee_descriptor AS settlement_fee_descriptor,
        business_transaction_type AS settlement_business_transaction_type, business_transaction_cycle AS settlement_business_transaction_cycle,
        reversal_flag AS settlement_reversal_flag, CAST(sum(n) AS BIGINT) AS settlement_count, CAST(sum(amount) AS DOUBLE) AS settlement_amount,
        CAST(sum(irf) AS DOUBLE) AS settlement_irf_amount, max(app_processing_date) AS day_a
      FROM {{o_settlement}} s WHERE {_CLEARING} GROUP BY ALL) a
FULL JOIN (SELECT jurisdiction_assigned AS interchange_jurisdiction_assigned, business_mode AS interchange_business_mode,
        fee_descriptor AS interchange_fee_descriptor, business_transaction_type AS interchange_business_transaction_type,
        business_transaction_cycle AS interchange_business_transaction_cycle, reversal_flag AS interchange_reversal_flag,
        count(*) AS interchange_count, CAST(sum(local_amount) AS DOUBLE) AS interchange_amount, CAST(sum(local_fee) AS DOUBLE) AS interchange_irf_amount,
        max(purchase_date) AS day_b FROM {{o_ours}} o GROUP BY ALL) b
ON settlement_jurisdiction_assigned = interchange_jurisdiction_assigned AND settlement_business_mode = interchange_business_mode
  AND settlement_fee_descriptor = interchange_fee_descriptor AND settlement_reversal_flag = interchange_reversal_flag
  AND coalesce(settlement_business_transaction_type, '') = coalesce(interchange_business_transaction_type, '')
  AND coalesce(settlement_business_transaction_cycle, '') = coalesce(interchange_business_transaction_cycle, '')) j
"""

_DETAIL = """
SELECT app_id, app_hash_file, app_customer_code, app_type_file, k.app_processing_date, purchase_date,
  CASE WHEN app_type_file = 'IN' THEN 'VISA ISS' ELSE 'VISA ACQ' END AS table_description,
  CAST(account_number AS VARCHAR) AS account_number,
  CASE WHEN funding_source IN ('C', 'H', 'R') THEN 'C' WHEN funding_source IN ('D', 'P') THEN 'D' END AS account_funding_source,
  ardef_country AS account_range_country, k.product_id, p.range_program_id, jurisdiction,
  ty.transaction_type_id AS business_transaction_type_id, reversal_indicator,
  CASE WHEN m.currency_alphabetic_code = cu.local_currency_code OR dcc_indicator <> '1' OR dcc_indicator IS NULL THEN 1 ELSE 0 END AS currency_local_indicator,
  CASE WHEN motoec_indicator = ' ' THEN 1 ELSE 0 END AS motoec_indicator, merchant_country_code, cu.customer_country AS bank_country,
  business_mode AS business_mode_id, coalesce(x.exchange_value, 1e0) AS exchange_rate, cu.report_currency_code AS report_currency,
  coalesce(x.exchange_value, 1e0) * source_amount AS report_amount, settlement_report_amount AS settlement_amount
FROM {o_calculated} k
JOIN {customers} cu ON cu.code = k.app_customer_code
JOIN {text_types} ty ON ty.business_transaction_type_id = k.business_transaction_type AND ty.transaction_type_id IN ('PUR', 'CRD', 'CSH')
LEFT JOIN {currencies} m ON CAST(m.currency_numeric_code AS VARCHAR) = k.source_currency_code
LEFT JOIN {products} p ON p.brand = 'VISA' AND trim(p.product_code) = trim(k.product_id)
LEFT JOIN {rates} x ON x.app_processing_date = k.app_processing_date AND x.brand = 'VISA'
  AND x.currency_from_code = k.source_currency_code AND x.currency_to = cu.report_currency_code
WHERE transaction_code IN ('05', '06', '07', '25', '26', '27')
"""
_DETAIL_ALL = """
SELECT * FROM {o_detail} a
UNION ALL
SELECT * REPLACE ('VISA ON-US DUP (ACQ TO ISS)' AS table_description, 'issuing' AS business_mode_id)
FROM {o_detail} b WHERE app_type_file = 'OUT' AND jurisdiction = 'on-us'
"""
_DETAIL_ONLINE = """
SELECT app_id, app_hash_file, app_customer_code, k.app_processing_date, 'VISA SMS' AS table_description, CAST(CAST(card_number AS DECIMAL(19,0)) AS VARCHAR) AS account_number,
  CASE WHEN account_funding_source IN ('C', 'H', 'R') THEN 'C' WHEN account_funding_source IN ('D', 'P') THEN 'D' END AS account_funding_source,
  pan_extended_country_code AS account_range_country, product_id_sms AS product_id, p.range_program_id, jurisdiction,
  type_group AS business_transaction_type_id, reversal_indicator,
  CASE WHEN transaction_currency_code = cu.local_currency_code OR dcc_indicator_sms <> '1' OR dcc_indicator_sms IS NULL THEN 1 ELSE 0 END AS currency_local_indicator,
  CASE WHEN mailtelephone_or_electronic_commerce_indicator = ' ' THEN 1 ELSE 0 END AS motoec_indicator,
  card_acceptor_country AS merchant_country_code, cu.customer_country AS bank_country, business_mode AS business_mode_id,
  CASE WHEN transaction_amount = 0 THEN coalesce(x2.exchange_value, 1e0) ELSE coalesce(x1.exchange_value, 1e0) END AS exchange_rate,
  cu.report_currency_code AS report_currency,
  CASE WHEN transaction_amount = 0 THEN coalesce(x2.exchange_value, 1e0) * (cryptogram_amount + surcharge_amount_sms)
       ELSE coalesce(x1.exchange_value, 1e0) * transaction_amount END AS report_amount, settlement_amount
FROM {o_online} k
JOIN {customers} cu ON cu.code = k.app_customer_code
LEFT JOIN {products} p ON p.brand = 'VISA' AND trim(p.product_code) = trim(k.product_id_sms)
LEFT JOIN {rates} x1 ON x1.app_processing_date = k.app_processing_date AND x1.brand = 'VISA'
  AND x1.currency_from_code = k.transaction_currency_code AND x1.currency_to = cu.report_currency_code
LEFT JOIN {rates} x2 ON x2.app_processing_date = k.app_processing_date AND x2.brand = 'VISA'
  AND x2.currency_from_code = k.cryptogram_currency_code AND x2.currency_to = cu.report_currency_code
WHERE transaction_code_sms IN ('05', '06', '07', '25', '26', '27')
"""
_DETAIL_BITMAP = """
SELECT app_id, app_hash_file, app_type_file, app_customer_code, k.app_processing_date, 'MASTERCARD ISS AND ACQ' AS table_description, CAST(pan AS VARCHAR) AS account_number,
  funding_source AS account_funding_source, iar_country AS account_range_country, gcms_product_identifier AS product_id,
  p.range_program_id, jurisdiction, ty.transaction_type_id AS business_transaction_type_id,
  CASE WHEN (app_message_type = '1240' AND message_reversal_indicator = 'R')
         OR (app_message_type = '1442' AND message_reversal_indicator <> 'R') THEN 1 ELSE 0 END AS reversal_indicator,
  CASE WHEN m.currency_alphabetic_code = cu.local_currency_code THEN 1 ELSE 0 END AS currency_local_indicator,
  CASE WHEN pos_entry_mode LIKE '%0' THEN 0 ELSE 1 END AS motoec_indicator, card_acceptor_country_code AS merchant_country_code,
  cu.customer_country AS bank_country, business_mode AS business_mode_id, coalesce(x.exchange_value, 1e0) AS exchange_rate,
  cu.report_currency_code AS report_currency, coalesce(x.exchange_value, 1e0) * amount_transaction AS report_amount
FROM {o_bitmap} k
JOIN {customers} cu ON cu.code = k.app_customer_code
LEFT JOIN {bitmap_types} ty ON ty.business_transaction_type_id = left(k.processing_code, 2)
LEFT JOIN {currencies} m ON m.currency_numeric_code = k.currency_code_transaction
LEFT JOIN {products} p ON p.brand = 'MC' AND trim(p.product_code) = trim(k.gcms_product_identifier)
LEFT JOIN {rates} x ON x.app_processing_date = k.app_processing_date AND x.brand = 'MasterCard'
  AND CAST(x.currency_from_code AS INT) = k.currency_code_transaction AND x.currency_to = cu.report_currency_code
"""
_CUBE = """
SELECT 'run1' AS app_execution_id, '199801' AS report_month, report_currency, app_customer_code AS customer_code, bank_country AS bank_country_code,
  business_mode_id AS business_mode, 'VISA' AS brand, 0 AS size_ticket, product_id, range_program_id, account_funding_source AS founding_source,
  business_transaction_type_id AS transaction_type, jurisdiction, reversal_indicator, currency_local_indicator, motoec_indicator AS card_present_indicator,
  account_number, merchant_country_code, '' AS switch_code, count(*) AS transaction_count,
  CAST(sum(CAST(round(report_amount, 4) AS DECIMAL(20,4))) AS DOUBLE) AS transaction_amount
FROM {o_detail_all} d GROUP BY ALL
"""
_MONTH_COLUMNS = ("app_id, app_hash_file, app_customer_code, app_processing_date, table_description, account_number, account_funding_source, "
    "account_range_country, product_id, range_program_id, jurisdiction, business_transaction_type_id, reversal_indicator, currency_local_indicator, "
    "motoec_indicator, merchant_country_code, bank_country, business_mode_id, report_currency, report_amount")
_MONTH_DETAIL = f"""
SELECT * REPLACE (coalesce(account_range_country, 'UNK') AS account_range_country, coalesce(account_funding_source, 'UNK') AS account_funding_source,
    coalesce(account_number, '9999999999999999') AS account_number,
    CASE WHEN jurisdiction IS NULL AND report_amount IS NULL THEN 'UNK' ELSE jurisdiction END AS jurisdiction,
    CASE WHEN product_id IS NULL AND report_amount IS NULL THEN 'UNK' ELSE product_id END AS product_id,
    coalesce(range_program_id, 'UNK') AS range_program_id, coalesce(report_amount, 0) AS report_amount)
FROM (
SELECT d.*, coalesce((SELECT min(r.switch_code) FROM {{switch_ranges_all}} r WHERE r.brand = d.transaction_brand AND r.customer_code = d.app_customer_code
    AND CAST(d.account_number AS BIGINT) BETWEEN r.start_value AND coalesce(r.end_value, r.start_value)), '') AS switch_code,
  coalesce(st.app_id, 0) AS size_ticket
FROM (SELECT d.*, m.ticket_currency, CASE WHEN report_currency = m.ticket_currency THEN report_amount ELSE report_amount * x.exchange_value END AS ticket_amount
  FROM (
    SELECT {_MONTH_COLUMNS}, 'VISA' AS transaction_brand FROM {{o_detail}} a
    UNION ALL SELECT {_MONTH_COLUMNS}, 'VISA' FROM (SELECT * REPLACE ('VISA ON-US DUP (ACQ TO ISS)' AS table_description, 'issuing' AS business_mode_id)
      FROM {{o_detail}} b WHERE app_type_file = 'OUT' AND jurisdiction = 'on-us'
      AND app_customer_code IN (SELECT code FROM {{customers}} u WHERE duplicate_on_us_flag_visa)) q
    UNION ALL SELECT {_MONTH_COLUMNS}, 'VISA' FROM {{o_detail_online}} a
    UNION ALL SELECT {_MONTH_COLUMNS}, 'VISA' FROM (SELECT * REPLACE ('VISA ON-US DUP (SMS TO ISS)' AS table_description, 'issuing' AS business_mode_id)
      FROM {{o_detail_online}} b WHERE business_mode_id = 'acquiring' AND jurisdiction = 'on-us'
      AND app_customer_code IN (SELECT code FROM {{customers}} u WHERE duplicate_on_us_flag_visa)) q
    UNION ALL SELECT {_MONTH_COLUMNS}, 'MasterCard' FROM {{o_detail_bitmap}} a
    UNION ALL SELECT {_MONTH_COLUMNS}, 'MasterCard' FROM (SELECT * REPLACE ('MASTERCARD ON-US DUP (ACQ TO ISS)' AS table_description, 'issuing' AS business_mode_id)
      FROM {{o_detail_bitmap}} b WHERE app_type_file = 'OUT' AND jurisdiction = 'on-us'
      AND app_customer_code IN (SELECT code FROM {{customers}} u WHERE duplicate_on_us_flag_mastercard)) q) d
  LEFT JOIN (SELECT DISTINCT brand, country_code_list, ticket_currency FROM {{tickets}} t) m ON m.brand = d.transaction_brand AND m.country_code_list = d.bank_country
  LEFT JOIN {{rates}} x ON x.app_processing_date = d.app_processing_date AND x.brand = d.transaction_brand AND x.currency_from = d.report_currency
    AND x.currency_to = m.ticket_currency) d
LEFT JOIN {{tickets}} st ON st.brand = d.transaction_brand AND st.country_code_list = d.bank_country AND st.ticket_currency = d.ticket_currency
  AND ticket_amount >= st.size_ticket_min AND ticket_amount < st.size_ticket_max) w
"""
_MONTH_KEYS = ("account_number, bank_country, business_mode_id, transaction_brand, jurisdiction, account_funding_source, product_id, range_program_id, "
    "business_transaction_type_id, reversal_indicator, motoec_indicator, currency_local_indicator, merchant_country_code, size_ticket, switch_code, "
    "report_currency, app_customer_code")
_EXTRA = {
    **ORACLE_INPUTS,
    "o_month": _MONTH_DETAIL,
    "o_settlement": _SETTLEMENT_ROWS,
    "o_ours": _OURS,
    "o_reconciled": _RECONCILED,
    "o_detail": _DETAIL,
    "o_detail_all": _DETAIL_ALL,
    "o_detail_online": _DETAIL_ONLINE,
    "o_detail_bitmap": _DETAIL_BITMAP,
    "o_cube": _CUBE,
}
_SHOW = ", ".join(_DETAIL_SHOWN)
_R = ("settlement_jurisdiction_assigned, settlement_business_mode, settlement_fee_descriptor, settlement_business_transaction_type, "
      "settlement_business_transaction_cycle, settlement_reversal_flag, settlement_count, settlement_amount, settlement_irf_amount, "
      "interchange_jurisdiction_assigned, interchange_business_mode, interchange_fee_descriptor, interchange_business_transaction_type, "
      "interchange_business_transaction_cycle, interchange_reversal_flag, interchange_count, interchange_amount, interchange_irf_amount, "
      "report_processing_date, diff_count, diff_amount, diff_irf_amount, "
      "diff_count_abs, metric_count, metric_excess_count, absolute_error")

_SQL = {
    "load_audit": """
WITH l AS (SELECT o_orderkey % 4000 AS code, 'AUTOMOBILE' AS customer, CAST(o_orderdate AS DATE) AS file_date,
    CASE WHEN o_custkey % 2 = 0 THEN 'IN' ELSE 'OUT' END AS file_type, o_orderstatus <> 'P' AS done,
    CAST(o_orderdate AS DATE) + CAST(o_orderkey % 5 AS INT) AS process_date, o_orderkey AS execution_id, o_custkey % 100 AS records_number FROM orders),
a AS (SELECT customer, file_date, file_type, count(DISTINCT code) AS unique_files, count(file_date) // count(DISTINCT code) AS file_times_processed
      FROM l GROUP BY ALL),
b AS (SELECT file_date, max(process_date) AS last_processed_date, sum(records_number) AS total_records_files FROM (
      SELECT *, row_number() OVER (PARTITION BY code ORDER BY process_date DESC, execution_id DESC) AS n FROM l WHERE done) q WHERE n = 1 GROUP BY file_date),
t AS (SELECT app_processing_date AS file_date, app_type_file AS file_type, count(*) AS total_row_loaded FROM (
      SELECT app_processing_date, app_type_file FROM {txn_text} x UNION ALL SELECT app_processing_date, app_type_file FROM {txn_online} y
      UNION ALL SELECT app_processing_date, app_type_file FROM {elements} z) u GROUP BY ALL)
SELECT a.*, b.last_processed_date, CAST(b.total_records_files AS BIGINT) AS total_records_files, t.total_row_loaded
FROM a JOIN b USING (file_date) JOIN t USING (file_date, file_type)""",
    "settlement_report": f"""
SELECT app_processing_date, 130 AS report_type, 0 AS aggregation_level, 'x' AS summary_level, jurisdiction_assigned, 'issuing' AS business_mode,
  fee_descriptor, 'USD' AS settlement_currency, business_transaction_type, business_transaction_cycle, reversal_flag,
  CAST(sum(n) AS BIGINT) AS settlement_count, CAST(sum(amount) AS DOUBLE) AS settlement_amount, CAST(sum(irf) AS DOUBLE) AS settlement_irf_amount
FROM {{o_settlement}} s WHERE {_CLEARING} GROUP BY ALL""",
    "settlement_report_online": """
SELECT app_processing_date, jurisdiction_assigned, fee_descriptor, business_transaction_type, business_transaction_cycle, reversal_flag,
  CAST(sum(n) AS BIGINT) AS settlement_count, CAST(sum(amount) AS DOUBLE) AS settlement_amount
FROM {o_settlement} s WHERE type_code = '310' AND cycle_code NOT IN ('7', '8', '0') GROUP BY ALL""",
    "reconcile": f"""
SELECT {_R}, o.region_country_code AS jurisdiction_rule, o.fee_descriptor AS descriptor_rule, o.order_rule
FROM {{o_reconciled}} r LEFT JOIN (SELECT region_country_code, trim(fee_descriptor) AS fee_descriptor, min(CAST(rule_id AS DOUBLE)) AS order_rule
  FROM {{rules_text}} z GROUP BY jurisdiction, region_country_code, trim(fee_descriptor)) o
ON o.region_country_code = coalesce(settlement_jurisdiction_assigned, interchange_jurisdiction_assigned)
  AND o.fee_descriptor = coalesce(settlement_fee_descriptor, interchange_fee_descriptor)""",
    "reconcile_summary": """
SELECT CAST(sum(settlement_count) AS BIGINT) AS settlement_count, CAST(sum(diff_count_abs) - sum(metric_excess_count) AS BIGINT) AS diff,
  round(CAST(sum(diff_count_abs) - sum(metric_excess_count) AS DOUBLE) / CAST(sum(settlement_count) AS DOUBLE), 8) AS absolute_error
FROM {o_reconciled} r""",
    "reconcile_bitmap": """
SELECT settlement_jurisdiction, settlement_business_mode, settlement_ird, settlement_business_transaction_type, settlement_reversal_flag,
  settlement_count, settlement_amount, settlement_irf_amount, interchange_jurisdiction, interchange_business_mode, interchange_ird,
  interchange_business_transaction_type, interchange_reversal_flag, interchange_count, interchange_amount, interchange_irf_amount,
  DATE '2001-01-01' AS report_processing_date, settled - ours AS diff_count,
  coalesce(settlement_amount, 0e0) - coalesce(interchange_amount, 0e0) AS diff_amount,
  coalesce(settlement_irf_amount, 0e0) - coalesce(interchange_irf_amount, 0e0) AS diff_irf_amount, abs(ours - settled) AS diff_count_abs,
  least(ours, settled) AS metric_count, greatest(ours - settled, 0) AS metric_excess_count,
  CAST(abs(ours - settled) - greatest(ours - settled, 0) AS DOUBLE) / CAST(coalesce(settlement_count, 1) AS DOUBLE) AS absolute_error
FROM (SELECT *, coalesce(settlement_count, 0) AS settled, coalesce(interchange_count, 0) AS ours FROM (
  SELECT CASE l_orderkey % 4 WHEN 0 THEN 'off-us' WHEN 2 THEN 'intraregional' ELSE 'interregional' END AS settlement_jurisdiction,
    'issuing' AS settlement_business_mode, CASE l_partkey % 4 WHEN 0 THEN '75' WHEN 1 THEN '80' ELSE '64' END AS settlement_ird,
    CASE l_orderkey % 3 WHEN 0 THEN 'Purchase' WHEN 1 THEN 'Refund' END AS settlement_business_transaction_type,
    CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END AS settlement_reversal_flag, CAST(sum(l_linenumber) AS BIGINT) AS settlement_count,
    CAST(sum(CAST(round(l_extendedprice, 4) AS DECIMAL(20,4))) AS DOUBLE) AS settlement_amount,
    CAST(sum(CAST(round(l_tax, 4) AS DECIMAL(20,4))) AS DOUBLE) AS settlement_irf_amount
  FROM lineitem WHERE l_orderkey % 5 <> 0 AND l_partkey % 4 <> 3 GROUP BY ALL) a
FULL JOIN (SELECT jurisdiction AS interchange_jurisdiction, business_mode AS interchange_business_mode, ird AS interchange_ird,
    ty.short_description AS interchange_business_transaction_type, CASE WHEN message_reversal_indicator = 'R' THEN 1 ELSE 0 END AS interchange_reversal_flag,
    count(*) AS interchange_count, CAST(sum(CAST(round(amount_transaction, 4) AS DECIMAL(20,4))) AS DOUBLE) AS interchange_amount,
    CAST(sum(CAST(round(calculated_value, 8) AS DECIMAL(24,8))) AS DOUBLE) AS interchange_irf_amount
  FROM {o_bitmap_fee} f LEFT JOIN {bitmap_types} ty ON ty.business_transaction_type_id = left(processing_code, 2)
  WHERE rule_id IS NOT NULL GROUP BY ALL) b
ON settlement_jurisdiction = interchange_jurisdiction AND settlement_business_mode = interchange_business_mode AND settlement_ird = interchange_ird
  AND settlement_reversal_flag = interchange_reversal_flag
  AND coalesce(settlement_business_transaction_type, '') = coalesce(interchange_business_transaction_type, '')) j""",
    "report_ids": f"""
SELECT *, 100 + row_number() OVER (ORDER BY jurisdiction_assigned NULLS FIRST, fee_descriptor NULLS FIRST, app_processing_date,
  business_transaction_type NULLS FIRST, business_transaction_cycle NULLS FIRST, reversal_flag) AS app_id
FROM (SELECT jurisdiction_assigned, fee_descriptor, app_processing_date, business_transaction_type, business_transaction_cycle, reversal_flag,
  CAST(sum(n) AS BIGINT) AS settlement_count FROM {{o_settlement}} s WHERE {_CLEARING} GROUP BY ALL) q""",
    "scheme_fee_detail": f"SELECT {_SHOW}, round(report_amount, 8) AS report_amount, round(settlement_amount, 8) AS settlement_amount FROM {{o_detail_all}} d",
    "scheme_fee_detail_online": f"""
SELECT {_SHOW}, round(report_amount, 8) AS report_amount, round(settlement_amount, 8) AS settlement_amount FROM (
  SELECT * FROM {{o_detail_online}} a UNION ALL
  SELECT * REPLACE ('VISA ON-US DUP (SMS TO ISS)' AS table_description, 'issuing' AS business_mode_id) FROM {{o_detail_online}} b
  WHERE business_mode_id = 'acquiring' AND jurisdiction = 'on-us') q""",
    "scheme_fee_detail_bitmap": f"""
SELECT {_SHOW}, round(report_amount, 8) AS report_amount FROM (
  SELECT * FROM {{o_detail_bitmap}} a UNION ALL
  SELECT * REPLACE ('MASTERCARD ON-US DUP (ACQ TO ISS)' AS table_description, 'issuing' AS business_mode_id) FROM {{o_detail_bitmap}} b
  WHERE app_type_file = 'OUT' AND jurisdiction = 'on-us') q""",
    "range_open_end_lookup": """
SELECT t.app_id, t.app_hash_file, coalesce(min(r.switch_code), '') AS switch_code
FROM {txn_text} t LEFT JOIN {switch_ranges} r ON r.customer_code = t.app_customer_code
  AND t.account_number BETWEEN r.start_value AND coalesce(r.end_value, r.start_value)
GROUP BY t.app_id, t.app_hash_file""",
    "size_tickets": """
SELECT d.app_id, d.app_hash_file, d.table_description, coalesce(st.app_id, 0) AS size_ticket
FROM (SELECT d.*, CASE WHEN report_currency = m.ticket_currency THEN report_amount ELSE report_amount * x.exchange_value END AS amount, m.ticket_currency
  FROM {o_detail_all} d LEFT JOIN (SELECT DISTINCT brand, country_code_list, ticket_currency FROM {tickets} t) m
    ON m.brand = 'VISA' AND m.country_code_list = d.bank_country
  LEFT JOIN {rates} x ON x.app_processing_date = d.app_processing_date AND x.brand = 'VISA' AND x.currency_from = d.report_currency
    AND x.currency_to = m.ticket_currency) d
LEFT JOIN {tickets} st ON st.brand = 'VISA' AND st.country_code_list = d.bank_country AND amount >= st.size_ticket_min AND amount < st.size_ticket_max""",
    "report_currency": """
SELECT app_id, app_hash_file, rate AS exchange_rate, round(source_amount * rate, 4) AS report_amount, report_currency_code AS report_currency
FROM (SELECT t.*, c.report_currency_code, CASE WHEN c.report_currency_code = 'EUR' THEN 1e0 ELSE x.exchange_value END AS rate
  FROM {txn_text} t JOIN {customers} c ON c.code = t.app_customer_code
  LEFT JOIN {rates} x ON x.app_processing_date = t.app_processing_date AND x.brand = 'VISA' AND x.currency_from = 'EUR'
    AND x.currency_to = c.report_currency_code) q""",
    "monthly_cube": "SELECT * FROM {o_cube} c",
    "surrogate_ids": """
SELECT *, row_number() OVER (ORDER BY account_number NULLS FIRST, bank_country_code, business_mode, brand, jurisdiction NULLS FIRST,
  founding_source NULLS FIRST, product_id NULLS FIRST, range_program_id NULLS FIRST, transaction_type, reversal_indicator, card_present_indicator,
  currency_local_indicator, merchant_country_code NULLS FIRST, size_ticket, switch_code, report_currency, customer_code) AS app_id,
  0e0 AS transaction_scheme_fee_cost, 0e0 AS unitary_scheme_fee_cost, 0e0 AS estimated_scheme_fee_amount, 0e0 AS unitary_estimated_scheme_fee_amount
FROM {o_cube} c""",
    "legacy_map": """
SELECT app_execution_id, customer_code, report_month, customer_code AS rpt_bnk_id, 199801 AS set_mth,
  CASE business_mode WHEN 'acquiring' THEN 1 WHEN 'issuing' THEN 2 END AS bus_id, 2 AS sch_id, 0 AS tkt_siz_id, p.legacy_product_id AS prd_id,
  CAST(c.range_program_id AS INT) AS prg_id, f.bin_funding_source_mc_numeric_code AS fnd_src_id,
  CASE jurisdiction WHEN 'on-us' THEN 1 WHEN 'off-us' THEN 2 WHEN 'intraregional' THEN 3 WHEN 'interregional' THEN 4 END AS txn_scp_id,
  CASE transaction_type WHEN 'CSH' THEN 8 ELSE 1 END AS txn_typ_id, reversal_indicator AS txn_rvsl_flg_id,
  currency_local_indicator AS txn_crncy_lcl_flg_id, card_present_indicator AS txn_crd_prs_flg_id, account_number AS mct_cd, '' AS swt_cd,
  transaction_count AS txn_cnt, transaction_amount AS txn_amt, 0e0 AS txn_sfc, n.legacy_country_id AS mct_ctry_id, 0e0 AS unt_sfc,
  0e0 AS est_sch_fee_amt, 0e0 AS unt_est_sch_fee_amt
FROM {o_cube} c LEFT JOIN {products} p ON p.brand = 'VISA' AND trim(p.product_code) = c.product_id
LEFT JOIN {funding} f ON f.bin_funding_source_code = c.founding_source
LEFT JOIN {countries} n ON n.country_code = c.merchant_country_code""",
    "cost_pushback": """
SELECT app_id, app_hash_file, table_description, n * 0.5e0 AS transaction_scheme_fee_cost, 0.5e0 AS unitary_scheme_fee_cost,
  n * 0.25e0 AS estimated_scheme_fee_cost, 0.25e0 AS unitary_estimated_scheme_fee_cost
FROM (SELECT *, count(*) OVER (PARTITION BY report_currency, app_customer_code, bank_country, business_mode_id, product_id, range_program_id,
  account_funding_source, business_transaction_type_id, jurisdiction, reversal_indicator, currency_local_indicator, motoec_indicator,
  account_number, merchant_country_code) AS n FROM {o_detail_all} d) q""",
    "detail_count_check": """
SELECT count(*) AS detail_rows, (SELECT count(*) FROM (SELECT 1 FROM {o_detail_all} d GROUP BY report_currency, app_customer_code, bank_country,
  business_mode_id, product_id, range_program_id, account_funding_source, business_transaction_type_id, jurisdiction, reversal_indicator,
  currency_local_indicator, motoec_indicator, account_number, merchant_country_code) g) AS report_rows, count(*) AS report_transactions, true AS consistent
FROM {o_detail_all} e""",
    "scheme_fee_month": f"""
SELECT app_id, app_hash_file, table_description, transaction_brand, business_mode_id, switch_code, size_ticket, account_funding_source, range_program_id,
  CASE WHEN reversal_indicator = 0 THEN n * 0.5e0 ELSE 0e0 END AS transaction_scheme_fee_cost,
  CASE WHEN reversal_indicator = 0 THEN 0.5e0 ELSE 0e0 END AS unitary_scheme_fee_cost,
  CASE WHEN reversal_indicator = 0 THEN n * 0.25e0 ELSE 0e0 END AS estimated_scheme_fee_cost,
  CASE WHEN reversal_indicator = 0 THEN 0.25e0 ELSE 0e0 END AS unitary_estimated_scheme_fee_cost
FROM (SELECT *, count(*) OVER (PARTITION BY {_MONTH_KEYS}) AS n FROM {{o_month}} d) q""",
    "scheme_fee_month_report": f"""
SELECT c.app_id, 'run1' AS app_execution_id, c.app_customer_code AS customer_code, '199801' AS report_month, c.app_customer_code AS rpt_bnk_id, 199801 AS set_mth,
  CASE business_mode_id WHEN 'acquiring' THEN 1 WHEN 'issuing' THEN 2 END AS bus_id, CASE transaction_brand WHEN 'VISA' THEN 2 ELSE 1 END AS sch_id,
  CAST(size_ticket AS INT) AS tkt_siz_id, p.legacy_product_id AS prd_id, TRY_CAST(c.range_program_id AS INT) AS prg_id,
  f.bin_funding_source_mc_numeric_code AS fnd_src_id,
  CASE WHEN transaction_brand = 'VISA' THEN CASE jurisdiction WHEN 'on-us' THEN 1 WHEN 'off-us' THEN 2 WHEN 'intraregional' THEN 3 WHEN 'interregional' THEN 4 END
       ELSE CASE jurisdiction WHEN 'on-us' THEN 1 WHEN 'off-us' THEN 2 WHEN 'intraregional' THEN 4 WHEN 'interregional' THEN 8 END END AS txn_scp_id,
  CASE business_transaction_type_id WHEN 'PUR' THEN 1 WHEN 'CSH' THEN 8 WHEN 'CRD' THEN 1 END AS txn_typ_id, reversal_indicator AS txn_rvsl_flg_id,
  currency_local_indicator AS txn_crncy_lcl_flg_id, motoec_indicator AS txn_crd_prs_flg_id, left(account_number, 16) AS mct_cd, switch_code AS swt_cd,
  n AS txn_cnt, round(amount, 4) AS txn_amt, CASE WHEN reversal_indicator = 0 THEN n * 0.5e0 ELSE 0e0 END AS txn_sfc,
  CASE WHEN transaction_brand = 'VISA' THEN own.legacy_country_id ELSE alt.legacy_country_id END AS mct_ctry_id,
  CASE WHEN reversal_indicator = 0 THEN 0.5e0 ELSE 0e0 END AS unt_sfc, CASE WHEN reversal_indicator = 0 THEN n * 0.25e0 ELSE 0e0 END AS est_sch_fee_amt,
  CASE WHEN reversal_indicator = 0 THEN 0.25e0 ELSE 0e0 END AS unt_est_sch_fee_amt
FROM (SELECT {_MONTH_KEYS}, count(*) AS n, CAST(sum(CAST(round(report_amount, 4) AS DECIMAL(20,4))) AS DOUBLE) AS amount,
        row_number() OVER (ORDER BY {", ".join(k.strip() + " NULLS FIRST" for k in _MONTH_KEYS.split(","))}) AS app_id
      FROM {{o_month}} d GROUP BY {_MONTH_KEYS}) c
LEFT JOIN {{products}} p ON trim(p.product_code) = trim(c.product_id) AND p.brand = CASE transaction_brand WHEN 'VISA' THEN 'VISA' ELSE 'MC' END
LEFT JOIN {{funding}} f ON f.bin_funding_source_code = c.account_funding_source
LEFT JOIN {{countries}} own ON own.country_code = c.merchant_country_code
LEFT JOIN {{countries}} alt ON alt.country_code_alternative = c.merchant_country_code""",
    "scheme_fee_month_summary": f"""
SELECT 'run1' AS app_execution_id, '199801' AS report_month, CAST(sum(n) AS BIGINT) AS number_of_inserted_rows, count(*) AS number_of_groups,
  CAST(sum(n) AS BIGINT) AS number_of_transactions, CAST(sum(n) AS BIGINT) AS number_of_updated_rows
FROM (SELECT count(*) AS n FROM {{o_month}} d GROUP BY {_MONTH_KEYS}) q""",
    "returned_costs": """
SELECT o_orderkey AS app_id, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice ELSE 0 END AS transaction_scheme_fee_cost,
  CASE WHEN o_orderstatus <> 'P' THEN 0.5e0 ELSE 0 END AS unitary_scheme_fee_cost, 0e0 AS estimated_scheme_fee_amount,
  CASE WHEN o_orderstatus <> 'P' THEN 0.75e0 ELSE 0 END AS unitary_estimated_scheme_fee_amount FROM orders""",
    "analytics_text": """
WITH v AS (
SELECT f.app_customer_code AS customer_code, f.app_hash_file AS file_id, f.app_id AS row_id,
  CASE WHEN f.app_type_file = 'IN' THEN i.country_code_alternative ELSE m.country_code_alternative END AS customer_country_code,
  CASE WHEN f.app_type_file = 'IN' THEN 'I' ELSE 'A' END AS business_mode_code, 'VI' AS brand_code, f.app_processing_date AS processing_date,
  strftime(f.app_processing_date, '%Y-%m') AS processing_month, f.purchase_date AS transaction_date, strftime(f.purchase_date, '%Y-%m') AS transaction_month,
  CASE right(f.transaction_code, 1) WHEN '5' THEN 'PUR' WHEN '6' THEN 'CRD' ELSE 'CSH' END AS transaction_group_code,
  f.business_transaction_type AS transaction_type_id, f.jurisdiction AS jurisdiction_code, m.country_code_alternative AS merchant_country_code,
  f.merchant_category_code AS mcc_code, trim(upper(f.merchant_name)) AS merchant, upper(f.card_acceptor_id) AS merchant_id, upper(f.terminal_id) AS terminal_id,
  f.account_reference_number_acquiring_identifier AS acquirer_bin, i.country_code_alternative AS issuer_country_code,
  CAST(left(CAST(f.account_number AS VARCHAR), 6) AS INT) AS issuer_bin_6, CAST(left(CAST(f.account_number AS VARCHAR), 8) AS INT) AS issuer_bin_8,
  f.funding_source AS funding_source_code, CAST(p.range_program_id AS INT) AS product_program_id, f.product_id AS product_code,
  CASE WHEN f.motoec_indicator = ' ' THEN 'CPR' ELSE 'CNP' END AS card_present_code, f.reversal_indicator = 1 AS is_reversal_or_chargeback,
  f.fee_descriptor AS interchange_rule, cu.report_currency_code AS reported_currency_code,
  coalesce(x1.exchange_value, 1e0) * f.source_amount AS amount, coalesce(f.fee_x, x1.exchange_value, 1e0) * f.calculated_value AS fee
FROM {o_fee} f JOIN {customers} cu ON cu.code = f.app_customer_code
LEFT JOIN {countries} m ON m.country_code = f.merchant_country_code LEFT JOIN {countries} i ON i.country_code = f.ardef_country
LEFT JOIN {bin_products} p ON p.bin_product_id = f.product_id
LEFT JOIN {rates} x1 ON x1.app_processing_date = f.app_processing_date AND x1.brand = 'VISA'
  AND x1.currency_from_code = f.source_currency_code AND x1.currency_to = cu.report_currency_code
WHERE f.transaction_code IN ('05', '06', '07', '25', '26', '27'))
SELECT * EXCLUDE (amount, fee), round(CASE WHEN is_reversal_or_chargeback THEN -amount ELSE amount END, 8) AS transaction_amount,
  round(CASE WHEN is_reversal_or_chargeback THEN -fee ELSE fee END, 8) AS interchange_fees_amount, row_id % 100 / 100e0 AS scheme_fees_amount FROM v
UNION ALL
SELECT * EXCLUDE (amount, fee) REPLACE ('I' AS business_mode_code), round(CASE WHEN is_reversal_or_chargeback THEN -amount ELSE amount END, 8) AS transaction_amount,
  round(CASE WHEN is_reversal_or_chargeback THEN -fee ELSE fee END, 8) AS interchange_fees_amount, round(row_id % 100 / 100e0 + 1e0, 8) AS scheme_fees_amount
FROM v WHERE jurisdiction_code = 'on-us' AND business_mode_code = 'A'""",
    "analytics_online": """
SELECT * EXCLUDE (amount, fee), round(CASE WHEN is_reversal_or_chargeback THEN -amount ELSE amount END, 8) AS transaction_amount,
  round(CASE WHEN is_reversal_or_chargeback THEN -fee ELSE fee END, 8) AS interchange_fees_amount,
  CASE WHEN customer_code <> 'BUILDING' THEN row_id % 100 / 100e0 END AS scheme_fees_amount FROM (
SELECT f.app_customer_code AS customer_code, f.app_hash_file AS file_id, f.app_id AS row_id,
  CASE f.issuer_acquirer_indicator WHEN 'I' THEN i.country_code_alternative WHEN 'A' THEN m.country_code_alternative END AS customer_country_code,
  f.issuer_acquirer_indicator AS business_mode_code, 'VI' AS brand_code, f.app_processing_date AS processing_date,
  strftime(f.app_processing_date, '%Y-%m') AS processing_month, f.local_transaction_date AS transaction_date,
  strftime(f.local_transaction_date, '%Y-%m') AS transaction_month,
  CASE right(f.transaction_code_sms, 1) WHEN '5' THEN 'PUR' WHEN '6' THEN 'CRD' WHEN '7' THEN 'CSH' ELSE 'OTH' END AS transaction_group_code,
  f.business_transaction_type AS transaction_type_id, f.jurisdiction AS jurisdiction_code, m.country_code_alternative AS merchant_country_code,
  f.merchants_type AS mcc_code, trim(upper(f.card_acceptor_name)) AS merchant, upper(f.card_acceptor_id_sms) AS merchant_id,
  upper(f.card_acceptor_terminal_id) AS terminal_id, CAST(f.acquiring_institution_id_1 AS INT) AS acquirer_bin,
  i.country_code_alternative AS issuer_country_code, CAST(left(CAST(f.card_number AS VARCHAR), 6) AS INT) AS issuer_bin_6,
  CAST(left(CAST(f.card_number AS VARCHAR), 8) AS INT) AS issuer_bin_8, f.funding_source AS funding_source_code,
  CAST(p.range_program_id AS INT) AS product_program_id, f.product_id AS product_code,
  CASE WHEN f.mailtelephone_or_electronic_commerce_indicator = ' ' THEN 'CPR' ELSE 'CNP' END AS card_present_code,
  CAST(f.reversal_indicator AS BOOLEAN) AS is_reversal_or_chargeback, f.fee_descriptor AS interchange_rule,
  cu.report_currency_code AS reported_currency_code,
  CASE WHEN f.transaction_amount = 0 THEN coalesce(x3.exchange_value, 1e0) * (f.cryptogram_amount + f.surcharge_amount_sms)
       ELSE coalesce(x1.exchange_value, 1e0) * f.transaction_amount END AS amount,
  CASE WHEN f.transaction_amount = 0 AND (f.fee_currency IS NULL OR f.fee_currency <> cu.report_currency_code) THEN coalesce(x3.exchange_value, 1e0)
       WHEN f.transaction_amount = 0 THEN coalesce(x2.exchange_value, 1e0)
       ELSE coalesce(x2.exchange_value, x1.exchange_value, 1e0) END * f.calculated_value AS fee
FROM {o_online_fee} f JOIN {customers} cu ON cu.code = f.app_customer_code
LEFT JOIN {countries} m ON m.country_code = f.card_acceptor_country LEFT JOIN {countries} i ON i.country_code = f.ardef_country
LEFT JOIN {bin_products} p ON p.bin_product_id = f.product_id
LEFT JOIN {rates} x1 ON x1.app_processing_date = f.app_processing_date AND x1.brand = 'VISA'
  AND x1.currency_from_code = f.transaction_currency_code AND x1.currency_to = cu.report_currency_code
LEFT JOIN {rates} x2 ON x2.app_processing_date = f.app_processing_date AND x2.brand = 'VISA'
  AND x2.currency_from = f.fee_currency AND x2.currency_to = cu.report_currency_code
LEFT JOIN {rates} x3 ON x3.app_processing_date = f.app_processing_date AND x3.brand = 'VISA'
  AND x3.currency_from = 'USD' AND x3.currency_to = cu.report_currency_code) v""",
    "analytics_bitmap": """
SELECT * EXCLUDE (amount, fee), round(CASE WHEN is_reversal_or_chargeback THEN -amount ELSE amount END, 8) AS transaction_amount,
  round(CASE WHEN is_reversal_or_chargeback THEN -fee ELSE fee END, 8) AS interchange_fees_amount,
  CASE WHEN customer_code <> 'BUILDING' THEN row_id % 100 / 100e0 END AS scheme_fees_amount FROM (
SELECT f.app_customer_code AS customer_code, f.app_hash_file AS file_id, f.app_id AS row_id,
  CASE WHEN (f.app_type_file = 'IN') = (f.app_message_type = '1240') THEN i.country_code_alternative ELSE m.country_code_alternative END AS customer_country_code,
  CASE WHEN f.app_type_file = 'IN' THEN 'I' ELSE 'A' END AS business_mode_code, 'MC' AS brand_code, f.app_processing_date AS processing_date,
  strftime(f.app_processing_date, '%Y-%m') AS processing_month, CAST(f.date_and_time_local_transaction AS DATE) AS transaction_date,
  strftime(f.date_and_time_local_transaction, '%Y-%m') AS transaction_month,
  CASE WHEN left(f.processing_code, 2) IN ('00', '09', '18') THEN 'PUR' WHEN left(f.processing_code, 2) = '20' THEN 'CRD'
       WHEN left(f.processing_code, 2) IN ('01', '12', '17', '28', '50') THEN 'CSH' ELSE 'OTH' END AS transaction_group_code,
  CAST(left(f.processing_code, 2) AS INT) AS transaction_type_id, f.jurisdiction AS jurisdiction_code,
  CASE WHEN f.app_message_type = '1240' THEN m.country_code_alternative ELSE i.country_code_alternative END AS merchant_country_code,
  f.card_acceptor_business_code_mcc AS mcc_code, trim(upper(f.card_acceptor_name)) AS merchant, upper(f.card_acceptor_id_code) AS merchant_id,
  upper(f.card_acceptor_terminal_id) AS terminal_id, CAST(f.acquirer_bin AS INT) AS acquirer_bin,
  CASE WHEN f.app_message_type = '1240' THEN i.country_code_alternative ELSE m.country_code_alternative END AS issuer_country_code,
  CAST(left(CAST(f.pan AS VARCHAR), 6) AS INT) AS issuer_bin_6, CAST(left(CAST(f.pan AS VARCHAR), 8) AS INT) AS issuer_bin_8,
  f.funding_source AS funding_source_code, CAST(p.range_program_id AS INT) AS product_program_id,
  coalesce(f.licensed_product_identifier, f.gcms_product_identifier) AS product_code,
  CASE right(f.pos_entry_mode, 1) WHEN '1' THEN 'CPR' WHEN '0' THEN 'CNP' ELSE 'UNK' END AS card_present_code,
  (f.app_message_type = '1240') = (coalesce(f.message_reversal_indicator, '') <> '') AS is_reversal_or_chargeback,
  f.jurisdiction_assigned || '-' || f.ird AS interchange_rule, cu.report_currency_code AS reported_currency_code,
  coalesce(x1.exchange_value, 1e0) * f.amount_transaction AS amount, coalesce(x2.exchange_value, x1.exchange_value, 1e0) * f.calculated_value AS fee
FROM {o_bitmap_fee} f JOIN {customers} cu ON cu.code = f.app_customer_code
LEFT JOIN {countries} m ON m.country_code_alternative = f.card_acceptor_country_code
LEFT JOIN {countries} i ON i.country_code_alternative = f.iar_country
LEFT JOIN {bitmap_bin_products} p ON p.bin_product_id = coalesce(f.licensed_product_identifier, f.gcms_product_identifier)
LEFT JOIN {rates} x1 ON x1.app_processing_date = f.app_processing_date AND x1.brand = 'MasterCard'
  AND CAST(x1.currency_from_code AS INT) = f.currency_code_transaction AND x1.currency_to = cu.report_currency_code
LEFT JOIN {rates} x2 ON x2.app_processing_date = f.app_processing_date AND x2.brand = 'MasterCard'
  AND x2.currency_from = f.rate_currency AND x2.currency_to = cu.report_currency_code) v""",
}
#: Settlement rows of both sides: the country is the destination's for issuing, the source's for acquiring reports.
_BOTH_ROWS = _SETTLEMENT_ROWS.replace("SELECT q.*,", "SELECT q.*, side AS business_mode,").replace(
    "CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END AS reversal_flag",
    "CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END AS reversal_flag, CASE WHEN l_orderkey % 2 = 0 THEN 'issuing' ELSE 'acquiring' END AS side",
).replace("l_orderkey % 2 = 0 AND l_orderkey % 9", "l_orderkey % 9").replace("c.country_numeric = dst", "c.country_numeric = CASE side WHEN 'issuing' THEN dst ELSE src END")


def _daily(keys: Sequence[str], theirs: str, ours: str, optional: Sequence[str]) -> str:
    """Full match by day and key, with the differences."""
    left = ", ".join(f"{k} AS settlement_{k}" for k in keys)
    right = ", ".join(f"{k} AS interchange_{k}" for k in keys)
    same = " AND ".join(
        f"coalesce(settlement_{k}, '') = coalesce(interchange_{k}, '')" if k in optional else f"settlement_{k} = interchange_{k}" for k in keys
    )
    return f"""
SELECT * EXCLUDE (settled, ours, day_a, day_b), coalesce(day_a, day_b) AS report_processing_date, settled - ours AS diff_count,
  coalesce(settlement_amount, 0e0) - coalesce(interchange_amount, 0e0) AS diff_amount,
  coalesce(settlement_irf_amount, 0e0) - coalesce(interchange_irf_amount, 0e0) AS diff_irf_amount, abs(ours - settled) AS diff_count_abs,
  least(ours, settled) AS metric_count, greatest(ours - settled, 0) AS metric_excess_count,
  CASE WHEN coalesce(settlement_count, 1) <> 0 THEN CAST(abs(ours - settled) - greatest(ours - settled, 0) AS DOUBLE)
    / CAST(coalesce(settlement_count, 1) AS DOUBLE) END AS absolute_error
FROM (SELECT *, coalesce(settlement_count, 0) AS settled, coalesce(interchange_count, 0) AS ours FROM (
  SELECT app_processing_date AS day_a, {left}, CAST(sum(n) AS BIGINT) AS settlement_count, CAST(sum(amount) AS DOUBLE) AS settlement_amount,
    CAST(sum(irf) AS DOUBLE) AS settlement_irf_amount FROM ({theirs}) t GROUP BY app_processing_date, {", ".join(keys)}) a
FULL JOIN (SELECT day AS day_b, {right}, count(*) AS interchange_count, CAST(sum(local_amount) AS DOUBLE) AS interchange_amount,
    CAST(sum(local_fee) AS DOUBLE) AS interchange_irf_amount FROM ({ours}) o GROUP BY day, {", ".join(keys)}) b
ON day_a = day_b AND {same}) j"""


_DAILY_ONLINE = """
SELECT f.jurisdiction_assigned, f.business_mode, trim(f.fee_descriptor) AS fee_descriptor, ty.short_description AS business_transaction_type,
  CAST(NULL AS VARCHAR) AS business_transaction_cycle, f.reversal_indicator AS reversal_flag, f.local_transaction_date AS day,
  CAST(round(f.fee_base * coalesce(x.exchange_value, 1e0), 6) AS DECIMAL(24,6)) AS local_amount,
  CAST(round(f.calculated_value * coalesce(x.exchange_value, 1e0), 8) AS DECIMAL(24,8)) AS local_fee
FROM {o_online_fee} f JOIN {customers} cu ON cu.code = f.app_customer_code
LEFT JOIN {text_types} ty ON ty.business_transaction_type_id = f.business_transaction_type
LEFT JOIN {rates} x ON x.app_processing_date = f.local_transaction_date AND x.brand = 'VISA'
  AND x.currency_from_code = f.transaction_currency_code AND x.currency_to = cu.local_currency_code
WHERE f.rule_id IS NOT NULL"""
_DAILY_BITMAP = """
SELECT f.jurisdiction, f.business_mode, f.ird, ty.short_description AS business_transaction_type,
  CASE WHEN message_reversal_indicator = 'R' THEN 1 ELSE 0 END AS reversal_flag, CAST(f.date_and_time_local_transaction AS DATE) AS day,
  CAST(round(f.amount_transaction * coalesce(x.exchange_value, 1e0), 6) AS DECIMAL(24,6)) AS local_amount,
  CAST(round(f.calculated_value * coalesce(x.exchange_value, 1e0), 8) AS DECIMAL(24,8)) AS local_fee
FROM {o_bitmap_fee} f LEFT JOIN {bitmap_types} ty ON ty.business_transaction_type_id = left(f.processing_code, 2)
LEFT JOIN {rates} x ON x.app_processing_date = CAST(f.date_and_time_local_transaction AS DATE) AND x.brand = 'MasterCard'
  AND CAST(x.currency_from_code AS INT) = f.currency_code_transaction AND x.currency_to = f.local_currency_code
WHERE f.rule_id IS NOT NULL"""
_DAILY_TOTALS = """
SELECT CAST(l_shipdate AS DATE) AS app_processing_date, CASE l_orderkey % 4 WHEN 0 THEN 'off-us' WHEN 2 THEN 'intraregional' ELSE 'interregional' END AS jurisdiction,
  CASE WHEN l_linenumber % 2 = 0 THEN 'issuing' ELSE 'acquiring' END AS business_mode,
  CASE l_partkey % 4 WHEN 0 THEN '75' WHEN 1 THEN '80' ELSE '64' END AS ird,
  CASE l_orderkey % 3 WHEN 0 THEN 'Purchase' WHEN 1 THEN 'Refund' END AS business_transaction_type,
  CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END AS reversal_flag, l_linenumber AS n,
  CAST(round(l_extendedprice, 4) AS DECIMAL(20,4)) AS amount, CAST(round(l_tax, 4) AS DECIMAL(20,4)) AS irf
FROM lineitem WHERE l_partkey % 4 <> 3 AND (l_orderkey % 5 = 1 OR (l_orderkey % 5 > 1 AND l_linenumber % 2 = 0))"""
_DAILY_TEXT = _daily(
    _TEXT_KEYS, f"SELECT * FROM {{o_both}} s WHERE {_CLEARING} AND (type_code <> '310' OR business_mode = 'issuing')",
    "SELECT *, purchase_date AS day FROM {o_ours} x", _OPTIONAL,
)
_SQL |= {
    "reconcile_daily": f"""
SELECT *, (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY report_processing_date,
  {", ".join(f"{side}_{k} NULLS FIRST" for side in ("settlement", "interchange") for k in _TEXT_KEYS)}) AS app_id FROM ({_DAILY_TEXT}) d""",
    "reconcile_daily_online": _daily(
        _TEXT_KEYS, "SELECT * FROM {o_both} s WHERE type_code = '310' AND cycle_code NOT IN ('7', '8', '0')", _DAILY_ONLINE, _OPTIONAL
    ),
    "reconcile_daily_bitmap": _daily(
        ["jurisdiction", "business_mode", "ird", "business_transaction_type", "reversal_flag"], _DAILY_TOTALS, _DAILY_BITMAP, ["business_transaction_type"]
    ),
}
_EXTRA["o_both"] = _BOTH_ROWS
_TWINS = """
WITH v AS ({view})
SELECT * FROM v WHERE customer_code <> 'BUILDING'
UNION ALL
SELECT * REPLACE ('I' AS business_mode_code, round(row_id % 100 / 100e0 + 1e0, 8) AS scheme_fees_amount)
FROM v WHERE customer_code <> 'BUILDING' AND jurisdiction_code = 'on-us' AND business_mode_code = 'A'"""
_SQL |= {f"{name}_mirrored": _TWINS.replace("{view}", _SQL[name]) for name in ("analytics_online", "analytics_bitmap")}
ORACLE = {k: oracle(v, _EXTRA) for k, v in _SQL.items()}
