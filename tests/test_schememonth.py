"""The month's chain on a small detail: hot groups, nulls in group columns, refusals."""

import glob

import pytest
from pyspark.sql import functions as F

from clearspan.plans import schemefee, schememonth

TEXT = {c: "string" for c in schemefee.DETAIL_COLUMNS} | {
    "app_id": "bigint", "app_processing_date": "date", "reversal_indicator": "int", "currency_local_indicator": "int", "motoec_indicator": "int",
    "transaction_count": "int", "settlement_amount": "double", "transaction_scheme_fee_cost": "double", "size_ticket": "int",
    "unitary_scheme_fee_cost": "double", "estimated_scheme_fee_cost": "double", "unitary_estimated_scheme_fee_cost": "double",
    "transaction_purchase_date": "date", "exchange_rate": "double", "report_amount": "double",
}


def frame(spark, rows):
    """Detail rows from (id, account, amount, customer); all else is alike."""
    base = spark.createDataFrame(rows, "app_id bigint, account_number string, report_amount double, app_customer_code string")
    alike = {
        "transaction_brand": "VISA", "report_currency": "USD", "bank_country": "AX", "product_id": "A", "switch_code": "", "business_mode_id": "issuing",
        "jurisdiction": "on-us", "business_transaction_type_id": "PUR", "app_processing_date": "1998-01-05", "scheme_fee_execution_month": "199801",
    }
    given = {c: F.col(c) for c in base.columns} | {c: F.lit(v) for c, v in alike.items()}
    numbers = {"transaction_count": 1, "reversal_indicator": 0, "currency_local_indicator": 1, "motoec_indicator": 1, "size_ticket": 0}
    given |= {c: F.lit(v) for c, v in numbers.items()} | {c: F.lit(0.0) for c in schemefee.COSTS.values()}
    return base.select(*[given.get(c, F.lit(None)).cast(TEXT[c]).alias(c) for c in schemefee.DETAIL_COLUMNS])


@pytest.fixture(scope="module")
def masters(spark):
    return {
        "ranges": spark.createDataFrame([(1000, 1999, "VISA", "C1", "s1"), (1500, None, "VISA", "C1", "s0")], "start_value bigint, end_value bigint, brand string, customer_code string, switch_code string"),
        "tickets": spark.createDataFrame([(7, "VISA", "AX", "USD", 0.0, 100.0), (8, "VISA", "AX", "USD", 100.0, 1e9)], "app_id int, brand string, country_code_list string, ticket_currency string, size_ticket_min double, size_ticket_max double"),
        "rates": spark.createDataFrame([], "app_processing_date date, brand string, currency_from string, currency_to string, exchange_value double"),
        "products": spark.createDataFrame([("A ", "VISA", 501)], "product_code string, brand string, legacy_product_id int"),
        "funding": spark.createDataFrame([("C", 1)], "bin_funding_source_code string, bin_funding_source_mc_numeric_code int"),
        "countries": spark.createDataFrame([("AX", "AXY", 1000)], "country_code string, country_code_alternative string, legacy_country_id int"),
    }


ROWS = [(1, "1500", 20.0, "C1"), (2, "1500", 30.0, "C1"), (3, "1501", 150.0, "C1"), (4, None, None, "C1"), (5, "1500", 40.0, "C2"), (1, "1500", 20.0, "C1")]


def half(report):
    n = F.col("transaction_count")
    return report.select("app_id", (n * 0.5).alias("txn_sfc"), F.lit(None).cast("double").alias("est_sch_fee_amt"), F.lit(0.5).alias("unt_sfc"), F.lit(0.1).alias("unt_est_sch_fee_amt"))


def test_costs_reach_every_detail_row(spark, masters, tmp_path):
    frames = [frame(spark, ROWS[:4]), frame(spark, ROWS[4:])]
    month = schememonth.run_month(frames, returned=half, execution="e", month="199801", first_day="1998-01-01", folder=f"file://{tmp_path}", **masters)
    got = sorted((r.app_id, r.account_number, r.switch_code, r.size_ticket, r.transaction_scheme_fee_cost, r.estimated_scheme_fee_cost) for r in month.detail.collect())
    group = 1.5  # rows 1, 2 and 1 again share a group
    assert got == [
        (1, "1500", "s0", 7, group, 0.0), (1, "1500", "s0", 7, group, 0.0), (2, "1500", "s0", 7, group, 0.0), (3, "1501", "s1", 8, 0.5, 0.0),
        (4, "9999999999999999", "", 0, 0.5, 0.0), (5, "1500", "", 7, 0.5, 0.0),
    ]
    assert [tuple(r) for r in month.summary.collect()] == [("e", "199801", 6, 4, 6, 6)]
    assert month.legacy.count() == 4 and {r.tkt_siz_id for r in month.legacy.collect()} == {0, 7, 8}
    assert len(glob.glob(f"{tmp_path}/*/detail-with-costs/*.parquet")) > 0


@pytest.mark.parametrize("hot", [1, 2, 1000])
def test_hot_groups_take_the_broadcast_way(spark, masters, hot):
    rows = [(i, "1500" if i % 3 else str(i), 1.0 * i, "C1") for i in range(300)]
    detail = schememonth.month_detail([frame(spark, rows)], masters["ranges"], masters["tickets"], masters["rates"])
    report = schememonth.month_report(detail, "1998-01-01", "h").withColumn("transaction_scheme_fee_cost", F.col("app_id") * 1.0)
    back = schememonth.with_group_costs(detail, report, 300, hot)
    assert back.count() == 300 and back.filter("_group IS NULL").count() == 0
    number = {r.account_number + str(r.size_ticket): r.app_id for r in report.collect()}
    assert all(r.transaction_scheme_fee_cost == number[r.account_number + str(r.size_ticket)] for r in back.collect())


def test_group_id_tells_nulls_apart(spark):
    rows = spark.createDataFrame([(None, "a"), ("a", None), ("a", "a"), (None, None), ("", "a")], "x string, y string")
    assert rows.select(*schememonth.group_id([F.col("x"), F.col("y")])).distinct().count() == 5


def test_refusals(spark, masters, tmp_path):
    frames = [frame(spark, ROWS)]
    twice = lambda report: half(report).unionByName(half(report))
    with pytest.raises(schememonth.CountMismatch, match="groups"):
        schememonth.run_month(frames, returned=twice, execution="e", month="m", first_day="1998-01-01", folder=f"file://{tmp_path}", **masters)
    double = masters | {"products": masters["products"].unionByName(masters["products"])}
    with pytest.raises(schememonth.CountMismatch, match="older_format"):
        schememonth.run_month(frames, returned=half, execution="e", month="m", first_day="1998-01-01", folder=f"file://{tmp_path}", **double)
    counted = [frame(spark, ROWS).withColumn("transaction_count", F.lit(2))]
    with pytest.raises(schememonth.CountMismatch, match="report against detail"):
        schememonth.run_month(counted, returned=half, execution="e", month="m", first_day="1998-01-01", folder=f"file://{tmp_path}", **masters)


@pytest.mark.parametrize("steps", [2, 8])
def test_steps_give_the_same_month(spark, masters, tmp_path, steps):
    rows = [(i % 40, str(1400 + i % 23) if i % 7 else None, 1.5 * (i % 11), "C1" if i % 3 else None) for i in range(200)]
    run = lambda n: schememonth.run_month([frame(spark, rows)], returned=half, execution="e", month="199801", first_day="1998-01-01", folder=f"file://{tmp_path}/{n}", steps=n, **masters)
    one, cut = run(1), run(steps)
    for name in ("detail", "report", "legacy", "summary"):
        assert sorted(map(str, getattr(cut, name).collect())) == sorted(map(str, getattr(one, name).collect())), name
    left = [p for p in glob.glob(f"{tmp_path}/{steps}/*/**/*.parquet", recursive=True) if "/groups/" in p or "/numbered/" in p or "/detail/" in p]
    assert not left


def test_small_segments_do_not_shuffle_the_detail(spark, masters):
    rows = schememonth.with_switch_codes(frame(spark, ROWS), masters["ranges"])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
