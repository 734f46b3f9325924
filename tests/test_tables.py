"""Tables, sheets, reports and ledgers written and read back; refused files; repeated keys."""

import hashlib

from pyspark.sql import functions as F

from clearspan.operators import ranges, rules
from clearspan.plans import schemefee
from clearspan.sources import ledger, lines, messages, tables
from clearspan.streaming import jobs


def test_sheet_with_skipped_rows(spark, tmp_path):
    (tmp_path / "sheet.csv").write_text('title\n\nnotes\nRule ,Fee\nR1,"a, b"\nR2,\n')
    got = [tuple(r) for r in tables.read_rule_sheet(spark, str(tmp_path / "sheet.csv"), skip=3).collect()]
    assert got == [("R1", "a, b"), ("R2", None)]
    (tmp_path / "plain.csv").write_text("Rule,Fee\nR1,2\n")
    plain = tables.read_rule_sheet(spark, str(tmp_path / "plain.csv"))
    assert plain.columns == ["rule", "fee"] and plain.count() == 1
    assert rules.same_columns(plain, plain.select("fee", "rule")) and not rules.same_columns(plain, plain.select("fee"))


def test_history_replaces_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "history")
    rows = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), ("b", 1, 30)], "c string, d int, v int")
    tables.write_history(rows, path, ["c", "d"])
    tables.write_history(spark.createDataFrame([("a", 1, 11)], "c string, d int, v int"), path, ["c", "d"])
    assert sorted(r.v for r in tables.read_table(spark, path, ["v"]).collect()) == [11, 20, 30]
    tables.append(rows.limit(0).union(spark.createDataFrame([("b", 1, 31)], "c string, d int, v int")), path, ["c", "d"])
    assert tables.read_table(spark, path, where=F.col("c") == "b").count() == 2


def test_columns_evolve_and_tables_unite(spark):
    one = spark.createDataFrame([(1,)], "a int")
    wide = tables.add_missing_columns(one, {"a": "int", "b": "string"})
    assert wide.columns == ["a", "b"]
    both = tables.union_all([one, spark.createDataFrame([("x", 2)], "b string, a int")])
    assert sorted(tuple(r) for r in both.select("a", "b").collect()) == [(1, None), (2, "x")]
    assert tables.limited(both, 1).count() == 1 and tables.limited(both, None).count() == 2


def test_report_round_trip(spark, tmp_path):
    path = str(tmp_path / "report")
    rows = spark.createDataFrame([("m", None, 4, "2.0", "1.0")], "mct_cd string, swt_cd string, txn_cnt long, txn_sfc string, est_sch_fee_amt string")
    tables.write_report(rows, path)
    back = tables.read_returned_report(spark, path).first()
    assert float(back["unt_sfc"]) == 0.5 and float(back["unt_est_sch_fee_amt"]) == 0.25


def test_fingerprints_and_patterns(spark, tmp_path):
    (tmp_path / "f.bin").write_bytes(b"abc")
    got = ledger.fingerprints(spark, str(tmp_path)).first()
    assert got["app_hash_file"] == hashlib.sha256(b"abc").hexdigest() and got["length"] == 3
    assert messages.read_files(spark, str(tmp_path)).first()["content"] == b"abc"
    patterns = spark.createDataFrame([("ALL", "t", "x"), ("c1", "u", "y"), ("c2", "v", "z")], "customer_code string, file_type string, file_format string")
    assert sorted(ledger.customer_patterns(patterns, "c1")) == [("t", "x"), ("u", "y")]


def test_damaged_message_files_are_reported():
    record = (3).to_bytes(4, "big") + b"abc"
    assert list(messages._walk(record + bytes(4) + record)) == [b"abc"]
    try:
        list(messages._walk(record + b"\xff\xff\xff\xff" + record))
    except ValueError as error:
        assert "damaged" in str(error)
    else:
        raise AssertionError("a negative length must be an error")


def test_files_with_a_bad_header_are_refused(spark):
    good, bad = "90" + " " * (lines.SHORT_LINE - 2), "90 too short"
    rows = spark.createDataFrame([("a", good), ("a", "05 x"), ("b", bad), ("b", "05 y")], "file string, line string")
    assert [r.file for r in lines.refused_files(rows).collect()] == ["b"]
    assert {r.file for r in lines.accepted_lines(rows).collect()} == {"a"}


def test_summary_of_an_execution(spark):
    detail = spark.createDataFrame([(1,), (2,), (3,)], "x int")
    report = spark.createDataFrame([(2,), (1,)], "transaction_count long")
    row = schemefee.summary_row(schemefee.detail_of_all([detail.limit(1), detail.filter("x > 1")]), report, "e", "m", "c", "r").first()
    assert row["number_of_groups"] == 2 and row["number_of_inserted_rows"] == 3


def test_period_filter(spark):
    days = spark.sql("SELECT explode(sequence(date'2024-01-01', date'2024-01-05')) AS app_processing_date")
    assert schemefee.of_period(days, "2024-01-02", "2024-01-03").count() == 2


def test_more_than_a_thousand_pairs_have_their_own_switch_codes(spark):
    pairs = spark.range(1500).select(
        F.lit("V").alias("brand"), F.concat(F.lit("c"), "id").alias("customer_code"), F.lit(100).alias("start_value"),
        F.when(F.col("id") % 3 > 0, 200).alias("end_value"), F.concat(F.lit("s"), "id").alias("switch_code"),
    )
    detail = spark.range(1500).select(
        F.col("id"), F.lit("V").alias("transaction_brand"), F.concat(F.lit("c"), "id").alias("app_customer_code"),
        F.when(F.col("id") % 2 == 0, "100").otherwise("150").alias("account_number"), F.lit("").alias("switch_code"),
    )
    got = {r.id: r.switch_code for r in schemefee.with_switch_codes(detail, pairs).collect()}
    assert got == {k: f"s{k}" if k % 2 == 0 or k % 3 > 0 else "" for k in range(1500)}


def test_segments_of_a_key(spark):
    segments = spark.createDataFrame([("a", 1, 5, "x"), ("a", 6, 900, "y"), ("b", 3, 4, "z")], "k string, seg_low long, seg_high long, v string")
    points = spark.createDataFrame([("a", 5), ("a", 6), ("b", 5), ("b", 3), (None, 3), ("a", None)], "mine string, p long")
    got = [r.v for r in ranges.lookup_segments(points, segments, F.col("p"), {"mine": "k"}, "v").collect()]
    assert got == ["x", "y", None, "z", None, None]


def test_new_files_are_handled_once(spark, tmp_path):
    folder, seen = tmp_path / "in", []
    folder.mkdir()

    def handle(batch, _):
        seen.extend(r.path.rsplit("/", 1)[1] for r in batch.select("path").collect())

    for name in ("a", "b"):
        (folder / name).write_bytes(b"x")
        jobs.process_new_files(jobs.arriving_files(spark, str(folder)), handle, str(tmp_path / "state")).awaitTermination(60)
    assert seen == ["a", "b"]
